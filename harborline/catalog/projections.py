"""Cleaning, renaming, conforming, payload and flattening projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog import shapes as S
from harborline.catalog.registry import query
from harborline.functions import dates, text
from harborline.operators import conform as C
from harborline.streaming import flights


@query(
    "p01_cleaner",
    r"""SELECT doc_id, ltrim(regexp_replace(text, '[^A-Za-z0-9\s,.";:!?()_&%$#@]', '', 'g')) AS text,
          ltrim(regexp_replace(lang, '[^A-Za-z0-9\s,.";:!?()_&%$#@]', '', 'g')) AS lang,
          upper(source[1]) || lower(source[2:]) AS source_name, CAST(n_chars AS DOUBLE) AS size_amount, TIMESTAMP '2024-01-01' AS created_time
        FROM documents""",
)
def p01(t):
    raw = t.documents.select(
        "doc_id", "text", "lang", F.col("source").alias("source_name"), F.md5("text").alias("password_hash"),
        F.col("n_chars").cast("decimal(12,2)").alias("size"), F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"),
    )
    return S.doubles(raw.select(*C.cleaning_columns(raw)), "size_amount")


@query(
    "p02_day_filter",
    "SELECT event_id, ts, user_id FROM events WHERE event_type = 'purchase' AND CAST(ts AS DATE) = DATE '2024-01-15'",
)
def p02(t):
    return t.events.where((F.col("event_type") == "purchase") & dates.on_day(F.col("ts"), "2024-01-15")).select("event_id", "ts", "user_id")


@query(
    "p03_recent_minutes",
    "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 15 MINUTE",
)
def p03(t):
    as_of = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    return t.events.where(dates.within(F.col("ts"), as_of, "15 MINUTES")).select("event_id", "user_id")


@query(
    "p05_filled_keys",
    "SELECT event_id FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL AND trim(json_extract_string(props, '$.k')) <> ''",
)
def p05(t):
    return t.events.where(text.blank_to_null(F.get_json_object("props", "$.k")).isNotNull()).select("event_id")


@query("p06_all_but_one", "SELECT * EXCLUDE (props, value) FROM events")
def p06(t):
    return t.events.drop("props", "value")


@query(
    "p07_range_or_null",
    """SELECT c_custkey, age FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(floor(c_acctbal / 100) AS BIGINT) END AS age FROM customer)
       WHERE age BETWEEN 18 AND 60 OR age IS NULL""",
)
def p07(t):
    age = F.when(F.col("c_mktsegment") != "BUILDING", F.floor(F.col("c_acctbal") / 100))
    return t.customer.select("c_custkey", age.alias("age")).where(F.col("age").between(18, 60) | F.col("age").isNull())


_MAPPING = {"c_custkey": "id", "c_name": "full_name", "customer_name": "full_name", "c_phone": "phone", "c_mktsegment": "segment"}


@query("p08_rename_by_map", "SELECT c_custkey AS id, c_name AS full_name, c_nationkey, c_acctbal, c_mktsegment AS segment FROM customer")
def p08(t):
    return C.rename_columns(t.customer, _MAPPING)


@query(
    "p09_received_columns",
    """SELECT count(*) AS customers, 'full_name,id,segment' AS received, 'phone' AS missing FROM customer""",
)
def p09(t):
    received, missing, _ = C.received_columns(t.customer, _MAPPING)
    return t.customer.agg(
        F.count(F.lit(1)).alias("customers"), F.lit(",".join(sorted(received))).alias("received"), F.lit(",".join(sorted(missing))).alias("missing")
    )


@query("p10_conform", "SELECT c_mktsegment, CAST(NULL AS VARCHAR) AS phone, c_custkey FROM customer")
def p10(t):
    return C.conform(t.customer, ["c_mktsegment", "phone", "c_custkey"])


@query(
    "p11_payload_with_extras",
    """SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","segment":' ||
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'null' ELSE '"' || c_mktsegment || '"' END || ',"phone":null}' AS payload FROM customer""",
)
def p11(t):
    rows = t.customer.select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return rows.select("c_custkey", C.payload(rows, rows.columns, ["phone"]).alias("payload"))


@query(
    "p12_id_payload_file",
    """SELECT o_orderkey AS id, '{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS payload, 'orders.parquet' AS file_name FROM orders""",
)
def p12(t):
    return t.orders.select(
        F.col("o_orderkey").alias("id"), C.payload(t.orders, ["o_custkey", "o_orderstatus"]).alias("payload"), F.col("_metadata.file_name").alias("file_name")
    )


@query("p13_distinct_values", "SELECT DISTINCT trim(role) AS value FROM conversations WHERE trim(role) <> ''")
def p13(t):
    values = t.conversations.select(text.blank_to_null(F.col("role")).alias("value"))
    return values.where(F.col("value").isNotNull()).distinct()


@query("p14_constant_from_path", "SELECT part_folder, count(*) AS n FROM (SELECT 'part' AS part_folder FROM part) GROUP BY 1")
def p14(t):
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.parquet$", 1)
    return t.part.select(stem.alias("part_folder")).groupBy("part_folder").agg(F.count(F.lit(1)).alias("n"))


def telemetry(t):
    """Order lines as flight reports, one JSON batch per line.

    Every flight is reported on its way, and again in the same batch once it
    has landed. Ship date against order date is the delay, in minutes;
    supplier and part numbers place the aircraft.
    """
    lines = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    minute = F.datediff(F.col("l_shipdate"), F.col("o_orderdate"))
    arrival = F.timestamp_add("MINUTE", minute.cast("long"), F.col("o_orderdate"))

    def report(status):
        return F.struct(
            stamp(F.col("o_orderdate")).alias("actual_departure_time"),
            F.when(F.col("l_returnflag") != "N", stamp(arrival)).alias("actual_arrival_time"),
            F.concat(F.lit("air"), F.col("l_suppkey").cast("string")).alias("airline"),
            F.struct((F.col("l_suppkey") % 90).cast("double").alias("latitude"), (F.col("l_partkey") % 180).cast("double").alias("longitude")).alias("current_location"),
            (F.col("l_quantity") - 25).alias("dest_lat"), (F.col("l_discount") * 100).alias("dest_lon"),
            F.col("l_extendedprice").alias("distance_travelled_km"),
            F.lit(status).alias("flight_status"),
            F.col("l_orderkey").cast("int").alias("flight_id"),
            stamp(F.col("o_orderdate")).alias("scheduled_arrival_time"), stamp(F.col("o_orderdate")).alias("scheduled_departure_time"),
        )

    reports = F.array_compact(F.array(report("Flying"), F.when(F.col("l_linestatus") == "F", report("Landed"))))
    return lines.select(F.to_json(F.struct(reports.alias("flights"))).alias("data"))


TELEMETRY = """
telemetry AS (
  SELECT CAST(l_orderkey AS INTEGER) AS flight_id, 'air' || l_suppkey AS airline, s.flight_status,
         CAST(l_suppkey % 90 AS DOUBLE) AS latitude, CAST(l_partkey % 180 AS DOUBLE) AS longitude, l_quantity - 25 AS dest_lat, l_discount * 100 AS dest_lon,
         l_extendedprice AS distance_travelled_km, o_orderdate AS scheduled,
         CASE WHEN l_returnflag <> 'N' THEN o_orderdate + to_minutes(date_diff('day', o_orderdate, l_shipdate)) END AS arrival
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN (VALUES ('F', 'Landed'), ('F', 'Flying'), ('O', 'Flying')) s(l, flight_status) ON s.l = l_linestatus)
"""


@query(
    "p15_flatten_struct",
    f"WITH {TELEMETRY} SELECT flight_id, airline, flight_status, latitude, longitude, dest_lat FROM telemetry",
)
def p15(t):
    return flights.flights(telemetry(t)).select("flight_id", "airline", "flight_status", "latitude", "longitude", "dest_lat")


@query(
    "p16_flatten_export",
    """SELECT CAST(o_orderkey AS VARCHAR) AS _id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created, o_orderstatus AS status,
              '{"code":' || o_custkey || '}' AS meta, '' AS absent FROM orders""",
)
def p16(t):
    wrapped = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("$oid")))
    plain = F.to_json(F.array(F.col("o_orderkey").cast("string")))
    identifier = F.when(F.col("o_orderstatus") == "F", wrapped).otherwise(F.regexp_replace(plain, r"[\[\]]", ""))
    document = F.concat(
        F.lit('{"_id":'), identifier, F.lit(',"created":{"$date":"'), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit('"},"status":"'), "o_orderstatus", F.lit('","meta":{"code":'), F.col("o_custkey").cast("string"), F.lit("}}"),
    )
    return t.orders.select(document.alias("d")).select(*C.flatten_export(F.col("d"), ["_id"], ["created"], ["status", "meta", "absent"]))


@query(
    "p17_typed_null_padding",
    """SELECT c_custkey AS id, c_name AS name, CAST(NULL AS VARCHAR) AS props, c_acctbal AS amount FROM customer
       UNION ALL SELECT event_id, NULL, props, NULL FROM events""",
)
def p17(t):
    return C.aligned_union(
        [
            t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount")),
            t.events.select(F.col("event_id").alias("id"), "props"),
        ]
    )


@query(
    "q04_unexpected_columns",
    """SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'nick' ELSE '' END || CASE WHEN c_acctbal > 5000 AND c_mktsegment = 'BUILDING' THEN ',' ELSE '' END
         || CASE WHEN c_mktsegment = 'BUILDING' THEN 'extra' ELSE '' END AS unexpected,
         NOT (c_acctbal > 5000 OR c_mktsegment = 'BUILDING') AS valid FROM customer""",
)
def q04(t):
    rows = t.customer.select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") > 5000, F.col("c_name")).otherwise(" ").alias("nick"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(1)).alias("extra"),
    )
    routed = C.route_unexpected(rows, ["c_custkey", "c_name"])
    return routed.select("c_custkey", F.array_join("unexpected", ",").alias("unexpected"), (F.size("unexpected") == 0).alias("valid"))
