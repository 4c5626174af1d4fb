"""As-of joins: the version of a dimension that was valid at a point in time.

An equi-join with a range condition compares every fact with every version of
its key, which is quadratic for a key with many facts *and* many versions. So
both ways here split time into buckets that are part of the key:

* ``version_at`` for day-grained dimensions with validity ranges: a version is
  repeated for every bucket that it spans, a fact has one bucket, and they join
  by key and bucket. The bucket's width comes from the versions' average span.
* ``asof_join`` for event times, where a key may have any number of rows on
  both sides, lays facts and versions on one time line per (key, time bucket);
  each fact takes the last version before it. Only one short summary row per
  key and bucket crosses bucket borders, so a busy key is spread over its
  buckets and no pair is ever formed.

Facts without a key or a time match nothing and go past the joins and windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: An end date from here on means no end.
FAR = "9000-01-01"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_time: str,
    right_time: str,
    values: list[str],
    bucket: str = "month",
    keep_unmatched: bool = True,
) -> DataFrame:
    """Attach ``values`` of the last right row with ``right_time <= left_time``.

    Right rows must be unique per key and time. Null keys and null times match
    nothing. ``bucket`` is any unit that ``date_trunc`` knows; smaller buckets
    spread a busy key further.
    """
    known = F.col(left_time).isNotNull()
    for key in on:
        known = known & F.col(key).isNotNull()
    unknown, left = left.where(~known), left.where(known)
    right = right.where(F.col(right_time).isNotNull()).dropna(subset=on)
    slot = lambda c: F.date_trunc(bucket, F.col(c).cast("timestamp_ntz"))
    payload = F.struct(*[F.col(v) for v in values])
    facts = left.select(
        *on,
        slot(left_time).alias("_slot"),
        F.col(left_time).cast("timestamp_ntz").alias("_time"),
        F.lit(1).alias("_side"),
        F.struct(*left.columns).alias("_left"),
        F.lit(None).cast(right.select(payload.alias("p")).schema["p"].dataType).alias("_right"),
    )
    versions = right.select(
        *on,
        slot(right_time).alias("_slot"),
        F.col(right_time).cast("timestamp_ntz").alias("_time"),
        payload.alias("_right"),
    )

    # last version of every (key, slot), handed on to the later slots
    closing = versions.groupBy(*on, "_slot").agg(F.max_by("_right", "_time").alias("_right"))
    wanted = facts.select(*on, "_slot").distinct()
    summary = (
        closing.withColumn("_asked", F.lit(0))
        .unionByName(wanted.withColumn("_asked", F.lit(1)), allowMissingColumns=True)
        .groupBy(*on, "_slot")
        .agg(F.max_by("_right", F.when(F.col("_right").isNotNull(), 0)).alias("_right"), F.max("_asked").alias("_asked"))
    )
    before = Window.partitionBy(*on).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        summary.withColumn("_carried", F.last("_right", ignorenulls=True).over(before))
        .where((F.col("_asked") == 1) & F.col("_carried").isNotNull())
        .select(*on, "_slot", F.col("_slot").alias("_time"), F.lit(-1).alias("_side"), F.col("_carried").alias("_right"))
    )

    line = (
        facts.unionByName(versions.withColumn("_side", F.lit(0)), allowMissingColumns=True)
        .unionByName(opening, allowMissingColumns=True)
    )
    upto = (
        Window.partitionBy(*on, "_slot")
        .orderBy("_time", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = line.withColumn("_match", F.last("_right", ignorenulls=True).over(upto)).where(
        F.col("_side") == 1
    )
    if not keep_unmatched:
        matched = matched.where(F.col("_match").isNotNull())
    found = matched.select("_left.*", *[F.col(f"_match.{v}").alias(v) for v in values])
    if not keep_unmatched:
        return found
    kinds = {f.name: f.dataType for f in found.schema.fields}
    return found.unionByName(unknown.withColumns({v: F.lit(None).cast(kinds[v]) for v in values}))


def version_at(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    at: str,
    values: list[str],
    keep_unmatched: bool = True,
    together: int = 16,
) -> DataFrame:
    """Look up the dimension version valid at ``facts[at]`` (closed-open).

    Versions have ``start_date``, ``end_date`` and ``is_current``; a current one
    has no end, nor one without an end date or with an end from year 9000 on.
    A bucket is as long as ``together`` average versions, so repeating versions
    per bucket adds few rows. Days after the last start count as that day, since
    nothing changes there. A fact is compared with the versions of its key that
    touch its bucket; a frequent key is spread over its buckets.
    """
    line = _time_line(dim, together)
    day = F.to_date(at)
    # what can't match is spread under buckets that no version has
    spread = -1 - F.pmod(F.xxhash64(key, at), F.lit(1024))
    left = facts.withColumn("_bucket", F.when(F.col(key).isNotNull() & day.isNotNull(), line(day)).otherwise(spread)).alias("f")
    last = F.when(~_open_ended(), F.date_sub("end_date", 1))
    start, through = line(F.col("start_date")), line(F.coalesce(last, F.lit(FAR).cast("date")))
    spans = (
        dim.where(F.col(key).isNotNull() & F.col("start_date").isNotNull() & (_open_ended() | (F.col("end_date") > F.col("start_date"))))
        .select(F.col(key).alias("_key"), F.col("start_date").alias("_first"), last.alias("_last"), *values, F.explode(F.sequence(start, through)).alias("_bucket"))
        .alias("d")
    )
    at_day = F.col(f"f.{at}").cast("date")
    valid = (
        (F.col(f"f.{key}") == F.col("d._key")) & (F.col("f._bucket") == F.col("d._bucket"))
        & (F.col("d._first") <= at_day) & (F.col("d._last").isNull() | (F.col("d._last") >= at_day))
    )
    joined = left.join(spans, valid, "left" if keep_unmatched else "inner")
    return joined.select(*[F.col(f"f.{c}") for c in facts.columns], *[F.col(f"d.{v}") for v in values])


def _open_ended() -> Column:
    return (F.col("is_current") == 1) | F.col("end_date").isNull() | (F.col("end_date") >= F.lit(FAR).cast("date"))


def _time_line(dim: DataFrame, together: int):
    """Day -> bucket number, from 0 to the last start's; the width is that of so many average versions one after the other.

    One pass over the dimension, as a scalar subquery: open versions span from their start to the last start.
    """
    start, closed = F.unix_date("start_date"), F.greatest(F.lit(1), F.datediff("end_date", "start_date"))
    opened = _open_ended()
    last = F.max(start)
    total = F.coalesce(F.sum(F.when(~opened, closed)), F.lit(0)) + F.coalesce(F.sum(F.when(opened, -start)), F.lit(0)) + F.count_if(opened) * last
    width = F.greatest(F.lit(1), F.ceil(total / F.greatest(F.lit(1), F.count("start_date")) * together))
    line = dim.agg(F.struct(F.min(start).alias("first"), last.alias("last"), width.cast("int").alias("width")).alias("line")).scalar()
    return lambda day: F.floor(F.greatest(F.lit(0), F.least(F.unix_date(day), line["last"]) - line["first"]) / line["width"])


def versions_on(dim: DataFrame, day: Column) -> DataFrame:
    """The dimension as it stood on one day: at most one row per key.

    With a single date for all facts this turns the range join into a plain
    equi-join.
    """
    return dim.where(
        (F.col("start_date") <= day) & ((F.col("end_date") > day) | (F.col("is_current") == 1))
    )
