"""Flight telemetry: nested JSON batches to positions and landed-flight facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.functions.dates import delay_band, minutes_between
from harborline.functions.geo import completion_pct, great_circle_km

# Wire schema of a telemetry batch and the columns of a landing.
TELEMETRY_SCHEMA = """
flights array<struct<
  actual_departure_time string, actual_arrival_time string, airline string,
  arrival_airport string, arrival_city string, current_altitude_m double,
  current_location struct<latitude double, longitude double>,
  current_speed_km_h double, departure_airport string, departure_city string,
  dest_lat double, dest_lon double, direction double, distance_travelled double,
  distance_travelled_km double, flight_status string, flight_id int, lat double,
  lon double, scheduled_arrival_time string, scheduled_departure_time string,
  speed double, start_time string>>
"""
LANDED = "Landed"
LANDED_COLUMNS = [
    "flight_id", "airline", "flight_status", "departure_city", "departure_airport",
    "arrival_city", "arrival_airport", "scheduled_departure_time", "actual_departure_time",
    "scheduled_arrival_time", "actual_arrival_time",
]


LOCATION = ["latitude", "longitude"]
#: What each result reads of a report.
POSITION_INPUT = ["latitude", "longitude", "dest_lat", "dest_lon", "distance_travelled_km"]


def wire_schema(columns: list[str] | None = None) -> T.StructType:
    """The batch schema with only the fields behind these flat columns: what isn't asked for isn't read."""
    whole = T.StructType.fromDDL(TELEMETRY_SCHEMA)
    if columns is None:
        return whole
    report = whole["flights"].dataType.elementType
    unknown = sorted(set(columns) - {f.name for f in report.fields if f.name != "current_location"} - set(LOCATION))
    if unknown:
        raise ValueError(f"reports have no {unknown}")
    place = T.StructType([f for f in report["current_location"].dataType.fields if f.name in columns])
    fields = [T.StructField(f.name, place) if f.name == "current_location" else f for f in report.fields if f.name in columns or (f.name == "current_location" and place.fields)]
    return T.StructType([T.StructField("flights", T.ArrayType(T.StructType(fields)))])


def flights(raw: DataFrame, value: str = "data", columns: list[str] | None = None) -> DataFrame:
    """One flat row per flight of each JSON batch, with all columns or only these.

    A consumer that names its columns has the parser skip the other fields.
    """
    schema = wire_schema(columns)
    parsed = raw.select(F.from_json(F.col(value).cast("string"), schema).alias("batch"))
    # the outer form keeps the engine from adding a filter that parses again
    exploded = parsed.select(F.explode_outer("batch.flights").alias("f"))
    flight = exploded.where(F.col("f").isNotNull()).select("f.*")
    return flight.select(
        *[c for c in flight.columns if c != "current_location"],
        *[F.col(f"current_location.{c}").alias(c) for c in LOCATION if columns is None or c in columns],
    )


def positions(flat: DataFrame) -> DataFrame:
    """Remaining distance and completion of every position report."""
    remaining = great_circle_km(
        F.col("latitude"), F.col("longitude"), F.col("dest_lat"), F.col("dest_lon")
    )
    return flat.withColumn("remaining_distance_km", remaining).withColumn(
        "completion_pct", completion_pct(F.col("distance_travelled_km"), F.col("remaining_distance_km"))
    )


def landings(flat: DataFrame) -> DataFrame:
    """Delays of landed flights, dated by the arrival of each flight."""
    time = lambda c: F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd HH:mm:ss"))
    landed = flat.where(F.col("flight_status") == LANDED).select(*LANDED_COLUMNS)
    return landed.withColumns(
        {
            "departure_delay_min": minutes_between(time("scheduled_departure_time"), time("actual_departure_time")),
            "arrival_delay_min": minutes_between(time("scheduled_arrival_time"), time("actual_arrival_time")),
            "flight_date": time("actual_arrival_time").cast("date"),
        }
    ).withColumn("delayed_status", delay_band(F.col("arrival_delay_min")))
