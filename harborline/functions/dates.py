"""Calendar, time-zone and tolerant timestamp parsing expressions.

No expression reads the clock: every "now" is an ``as_of`` argument, so a job
gives the same answer when it is run again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text layouts, tried in this order. Single letters
# accept one or two digits.
TIMESTAMP_LAYOUTS = [
    "yyyy-M-d H:m:s",
    "yyyy-M-d H:m",
    "yyyy-M-d",
    "d/M/yyyy H:m:s",
    "d/M/yyyy H:m",
    "d/M/yyyy",
    "M/d/yyyy H:m:s",
    "M/d/yyyy H:m",
    "M/d/yyyy",
    "d-M-yyyy H:m:s",
    "d-M-yyyy H:m",
    "d-M-yyyy",
    "yyyy/M/d H:m:s",
    "yyyy/M/d H:m",
    "yyyy/M/d",
]
# Layouts the engagement-file check accepts.
CHECKED_LAYOUTS = [
    "yyyy-M-d H:m:s",
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d'T'H:m:s.[SSSSSS][SSSSS][SSSS][SSS][SS][S]",
    "M/d/yyyy H:m:s",
    "M/d/yyyy",
    "yyyy-M-d",
]
# Numeric ranges and epochs of spreadsheet and unix times.
SPREADSHEET_EPOCH = "1899-12-30"
SPREADSHEET_MAX = 100000
UNIX_SECONDS_MIN = 1_000_000_000
UNIX_MILLIS_MIN = 1_000_000_000_000


def on_day(ts: Column, day: str) -> Column:
    """``ts`` falls on ``day``, written as a range so that scans can skip."""
    start = F.lit(day).cast("date")
    return (ts >= start.cast("timestamp_ntz")) & (ts < F.date_add(start, 1).cast("timestamp_ntz"))


def within(ts: Column, as_of: Column, interval: str) -> Column:
    """``ts`` is not older than ``interval`` before ``as_of``."""
    return ts >= as_of - F.expr(f"INTERVAL {interval}")


def local_time(utc: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` for a zone-less UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def hours_crossed(start: Column, end: Column) -> Column:
    """Hour boundaries between two times (not elapsed hours)."""
    seconds = _epoch_seconds(F.date_trunc("hour", end)) - _epoch_seconds(F.date_trunc("hour", start))
    return (seconds / 3600).cast("long")


def _epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp"))


def minutes_between(start: Column, end: Column) -> Column:
    return (_epoch_seconds(end) - _epoch_seconds(start)) / 60


def five_minute_floor(ts: Column) -> Column:
    seconds = _epoch_seconds(ts)
    return F.timestamp_seconds(seconds - seconds % 300).cast("timestamp_ntz")


def delay_band(minutes: Column) -> Column:
    """Arrival punctuality; an unknown delay counts as the worst band."""
    return (
        F.when(minutes < 15, "on_time").when(minutes < 30, "slightly_delayed").otherwise("too_late")
    )


def calendar_columns(day: Column) -> dict[str, Column]:
    """Attributes of a calendar dimension row."""
    return {
        "start_day_of_week": F.date_trunc("week", day).cast("date"),
        "start_day_of_month": F.trunc(day, "month"),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "is_weekend": F.weekday(day).isin(5, 6).cast("int"),
        "day_name": F.date_format(day, "EEEE"),
        "month_name": F.date_format(day, "MMMM"),
    }


def age_years(birth: Column, birth_year: Column, as_of: Column, min_year: int = 1900) -> Column:
    """Completed years; the birth year is the fallback, the future is null."""
    by_date = F.year(as_of) - F.year(birth) - (
        F.date_format(as_of, "MMdd") < F.date_format(birth, "MMdd")
    ).cast("int")
    known_year = birth_year.between(F.lit(min_year), F.year(as_of))
    return F.when(birth <= as_of, by_date).when(known_year, F.year(as_of) - birth_year)


def birth_date(full: Column, day: Column, month: Column, year: Column) -> Column:
    """A date of birth from one text or from its three parts."""
    parts = F.when(
        day.isNotNull() & month.isNotNull() & year.isNotNull(), F.concat_ws("-", year, month, day)
    )
    return F.coalesce(first_layout(full, ["yyyy-M-d", "d/M/yyyy"]), first_layout(parts, ["yyyy-M-d"])).cast("date")


def _shape(layout: str) -> str:
    """Regular expression of the texts a layout can read at all."""
    plain = re.sub(r"\[.*\]", "S", layout.replace("'", ""))
    digits = {"yyyy": r"\d{4}", "S": r"\d{1,6}", **dict.fromkeys("MdHms", r"\d{1,2}")}
    return "^" + "".join(digits.get(p, re.escape(p)) for p in re.findall("yyyy|.", plain)) + "$"


def first_layout(text: Column, layouts: list[str]) -> Column:
    """Timestamp by the first layout that fits, else null.

    Each layout is only tried on texts of its shape, since a failing parse
    costs far more than a pattern test.
    """
    attempts = [
        F.when(text.rlike(_shape(layout)), F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz"))
        for layout in layouts
    ]
    return F.coalesce(*attempts)


def any_timestamp(value: Column) -> Column:
    """Timestamp from spreadsheet serials, unix times, ISO or common layouts; numbers beyond year 9999 and NaN give null."""
    text = F.trim(value)
    number = text.try_cast("double")
    days = F.when(number.between(-719162, 2932896), number)  # years 1 to 9999
    serial = F.timestamp_add(
        "SECOND", (days * 86400).cast("long"), F.lit(SPREADSHEET_EPOCH).cast("timestamp_ntz")
    )
    day_count = F.timestamp_add(
        "SECOND", (days * 86400).cast("long"), F.lit("1970-01-01").cast("timestamp_ntz")
    )
    numeric = (
        F.when(number.between(1, SPREADSHEET_MAX), serial)
        .when(number > UNIX_MILLIS_MIN, F.timestamp_seconds(F.floor(F.when(number < 253402300800000, number) / 1000)).cast("timestamp_ntz"))
        .when(number > UNIX_SECONDS_MIN, F.timestamp_seconds(F.floor(F.when(number < 253402300800, number))).cast("timestamp_ntz"))
        .otherwise(day_count)
    )
    iso = F.when(
        text.contains("T"), F.regexp_replace(text, r"(Z|\+00:00)$", "").try_cast("timestamp_ntz")
    )
    stated_utc = F.regexp_replace(text, " UTC$", "")
    layouts = [first_layout(stated_utc, TIMESTAMP_LAYOUTS[:1]), first_layout(text, TIMESTAMP_LAYOUTS)]
    return F.when(number.isNotNull(), numeric).otherwise(F.coalesce(iso, *layouts))


def utc_text(value: Column) -> Column:
    """Canonical ``yyyy-MM-dd HH:mm:ss UTC`` text; unreadable text is kept."""
    parsed = any_timestamp(value)
    return F.coalesce(
        F.concat(F.date_format(parsed, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")),
        F.nullif(F.trim(value), F.lit("")),
    )
