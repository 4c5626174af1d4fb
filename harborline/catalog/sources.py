"""Reading change records, vendor files and landed partitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from harborline.catalog import shapes as S
from harborline.catalog.registry import query
from harborline.functions.text import number_text
from harborline.settings import work_path
from harborline.sources import cdc, files
from harborline.streaming import jobs


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def order_records(t):
    """Orders as change records; pending ones are deletes without a row."""
    row = F.struct(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("order_status"),
        S.money("o_totalprice").alias("total_amount"), _micros(F.col("o_orderdate")).alias("created_at"),
        F.when(F.col("o_orderpriority") != "5-LOW", _micros(F.col("o_orderdate")) + 1234).alias("updated_at"),
    )
    after = F.when(F.col("o_orderstatus") != "P", row)
    return t.orders.select(F.to_json(F.struct(after.alias("after")), {"ignoreNullFields": "false"}).alias("value"))


_ORDER_ROWS = """
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS order_status, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS total_amount,
       o_orderdate AS created_at, CASE WHEN o_orderpriority = '5-LOW' THEN TIMESTAMP '1970-01-01' ELSE o_orderdate + INTERVAL 1 MILLISECOND END AS updated_at
FROM orders WHERE o_orderstatus <> 'P'
"""


@query("s01_topic_stream", _ORDER_ROWS)
def s01(t):
    topic, out = work_path(t.spark, "topic"), work_path(t.spark, "bronze-orders")
    order_records(t).write.parquet(topic)
    stream = cdc.topic_stream(t.spark, "parquet", {"path": topic}, "value string")
    jobs.append_to(cdc.after_images(stream, "orders"), out, out + "-checkpoint").awaitTermination()
    return S.doubles(t.spark.read.parquet(out), "total_amount")


@query("s02_envelope_decode", _ORDER_ROWS)
def s02(t):
    return S.doubles(cdc.after_images(order_records(t), "orders"), "total_amount")


def broken_records(t):
    """Order messages of which four in ten are wrong: a key that is no number, cut text, an amount that is a word, an amount too long."""
    n = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 10
    key = F.when(kind == 0, F.concat(F.lit('"x'), n, F.lit('"'))).otherwise(n)
    amount = F.when(kind == 2, F.lit('"ten"')).when(kind == 3, F.concat(n, F.lit("0000000000000000000.5"))).otherwise(F.concat(n, F.lit(".25")))
    whole = F.concat(F.lit('{"after":{"order_id":'), key, F.lit(',"user_id":'), F.col("o_custkey").cast("string"), F.lit(',"total_amount":'), amount, F.lit("}}"))
    made = t.orders.select(whole.alias("whole"), kind.alias("kind"))
    return made.select(F.expr("CASE WHEN kind = 1 THEN left(whole, length(whole) - 5) ELSE whole END").alias("value"))


_BROKEN = """
WITH made AS (
  SELECT o_orderkey, o_custkey, o_orderkey % 10 AS kind, CAST(o_orderkey AS VARCHAR) AS n,
    CASE o_orderkey % 10 WHEN 2 THEN 'ten' WHEN 3 THEN n || '0000000000000000000.5' ELSE n || '.25' END AS amount,
    '{"after":{"order_id":' || CASE WHEN kind = 0 THEN '"x' || n || '"' ELSE n END || ',"user_id":' || o_custkey || ',"total_amount":' || CASE WHEN kind = 2 THEN '"ten"' ELSE amount END || '}}' AS whole
  FROM orders)
"""


@query(
    "s02_rejected_records",
    _BROKEN + """
SELECT CASE WHEN kind = 1 THEN left(whole, length(whole) - 5) ELSE whole END AS value,
  CASE kind WHEN 0 THEN 'order_id: x' || n WHEN 1 THEN 'not a change record' ELSE 'total_amount: ' || amount END AS error
FROM made WHERE kind < 4""",
)
def s02_rejected(t):
    return cdc.split_records(broken_records(t), "orders")[1]


@query(
    "s02_accepted_records",
    _BROKEN + """
SELECT o_orderkey AS order_id, o_custkey AS user_id, '' AS order_status, o_orderkey + 0.25::DOUBLE AS total_amount, TIMESTAMP '1970-01-01' AS created_at, TIMESTAMP '1970-01-01' AS updated_at
FROM made WHERE kind >= 4""",
)
def s02_accepted(t):
    return S.doubles(cdc.split_records(broken_records(t), "orders")[0], "total_amount")


@query(
    "s03_wide_decimals",
    """
WITH wide AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN -1 - l_orderkey ELSE l_orderkey END::HUGEINT * 18446744073709551616 + l_partkey AS v,
    CASE WHEN l_returnflag = 'R' THEN -1 - l_partkey ELSE l_partkey END AS u FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN v < 0 THEN '-' ELSE '' END || (abs(v) // 100) || '.' || lpad(CAST(abs(v) % 100 AS VARCHAR), 2, '0') AS amount,
  CASE WHEN u < 0 THEN '-' ELSE '' END || (abs(u) // 100) || '.' || lpad(CAST(abs(u) % 100 AS VARCHAR), 2, '0') AS small, CAST(NULL AS VARCHAR) AS beyond
FROM wide""",
)
def s03_wide(t):
    """Amounts of 16 bytes and of 8, and one that has more digits than its type."""
    negative = F.col("l_returnflag") == "R"
    signed = lambda c: F.lpad(F.hex(F.when(negative, -1 - F.col(c)).otherwise(F.col(c))), 16, "0")
    wide = F.unhex(F.concat(signed("l_orderkey"), F.lpad(F.hex("l_partkey"), 16, "0")))
    amount = lambda raw, precision: cdc.bytes_to_decimal(raw, 2, precision).cast("string")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", amount(wide, 38).alias("amount"), amount(F.unhex(signed("l_partkey")), 38).alias("small"),
        amount(F.unhex(F.concat(F.lit("7F"), F.hex(wide))), 38).alias("beyond"),
    )


@query("s04_payments_bytes", "SELECT o_orderkey AS payment_id, o_orderkey AS order_id, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount, o_orderpriority AS payment_method, o_orderdate AS payment_date, o_orderstatus AS status FROM orders")
def s04_bytes(t):
    """Payments whose amounts are base64 of unscaled bytes, as a producer in precise mode writes them."""
    cents = F.unhex(F.lpad(F.hex((S.money("o_totalprice") * 100).cast("long")), 16, "0"))
    row = F.struct(
        F.col("o_orderkey").alias("payment_id"), F.col("o_orderkey").alias("order_id"), F.base64(cents).alias("amount"),
        F.col("o_orderpriority").alias("payment_method"), _micros(F.col("o_orderdate")).alias("payment_date"), F.col("o_orderstatus").alias("status"),
    )
    records = t.orders.select(F.to_json(F.struct(row.alias("after"))).alias("value"))
    return S.doubles(cdc.after_images(records, "payments", decimals="bytes").drop("created_at", "updated_at"), "amount")


@query(
    "s03_typed_getters",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS price,
         CASE WHEN l_linestatus = 'O' THEN 0 ELSE l_suppkey END AS supplier, CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_suppkey END AS optional_supplier,
         CASE WHEN l_linestatus = 'O' THEN '' ELSE l_returnflag END AS flag, CASE WHEN l_linestatus = 'O' THEN 0.0 ELSE l_tax END AS tax,
         l_shipdate AS shipped FROM lineitem""",
)
def s03(t):
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    raw = F.unhex(F.lpad(F.hex(F.when(F.col("l_returnflag") == "R", -cents).otherwise(cents)), 16, "0"))
    known = F.col("l_linestatus") != "O"
    get = lambda kind, value, optional=False: cdc.decode(cdc.Field("x", kind, optional), value)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        get("bytes_decimal", raw).cast("double").alias("price"),
        get("long", F.when(known, F.col("l_suppkey"))).alias("supplier"),
        get("long", F.when(known, F.col("l_suppkey")), True).alias("optional_supplier"),
        get("text", F.when(known, F.col("l_returnflag"))).alias("flag"),
        get("double", F.when(known, F.col("l_tax"))).alias("tax"),
        get("micros", _micros(F.col("l_shipdate")) + 999).alias("shipped"),
    )


# wire form of every other table: field -> (Spark expression, SQL expression)
_EPOCH = "TIMESTAMP '1970-01-01'"
_TABLES: dict[str, tuple[str, dict[str, tuple[Column | None, str]]]] = {}


def _wire(name: str, table: str, fields: dict[str, tuple]) -> None:
    """Register the projection query of one change-record table."""
    exact = [f.name for f in cdc.TABLES[name].fields if f.kind == "decimal"]
    columns = []
    for f in cdc.TABLES[name].fields:
        sql = fields[f.name][1] if f.name in fields else (
            "NULL" if f.optional else {"micros": _EPOCH, "text": "''"}.get(f.kind, "0")
        )
        kind = {"long": "BIGINT", "int": "INTEGER", "micros": "TIMESTAMP", "text": "VARCHAR", "decimal": "DOUBLE"}[f.kind]
        columns.append(f"CAST({sql} AS {kind}) AS {f.name}")

    @query(f"s04_{name}", f"SELECT {', '.join(columns)} FROM {table}")
    def job(t):
        row = F.struct(*[F.expr(spark).alias(field) for field, (spark, _) in fields.items()])
        records = getattr(t, table).select(F.to_json(F.struct(row.alias("after"))).alias("value"))
        return S.doubles(cdc.after_images(records, name), *exact)


def _time(column: str) -> tuple[str, str]:
    return f"unix_micros(cast({column} as timestamp))", f"date_trunc('millisecond', {column})"


_wire("users", "customer", {"user_id": ("c_custkey", "c_custkey"), "name": ("c_name", "c_name"), "phone": ("nullif(c_mktsegment, 'BUILDING')", "nullif(c_mktsegment, 'BUILDING')")})
_wire("categories", "part", {"category_id": ("p_partkey", "p_partkey"), "name": ("p_type", "p_type"), "parent_id": ("nullif(p_size, 1)", "nullif(p_size, 1)")})
_wire("products", "part", {"product_id": ("p_partkey", "p_partkey"), "name": ("p_name", "p_name"), "description": ("p_brand", "p_brand"), "price": ("cast(p_retailprice as decimal(12,2))", "CAST(p_retailprice AS DECIMAL(12,2))"), "stock_quantity": ("p_size", "p_size")})
_wire("order_items", "lineitem", {"order_item_id": ("l_orderkey * 8 + l_linenumber", "l_orderkey * 8 + l_linenumber"), "order_id": ("l_orderkey", "l_orderkey"), "product_id": ("l_partkey", "l_partkey"), "quantity": ("cast(l_quantity as int)", "l_quantity"), "price": ("cast(l_extendedprice as decimal(12,2))", "CAST(l_extendedprice AS DECIMAL(12,2))"), "created_at": _time("l_shipdate")})
_wire("payments", "orders", {"payment_id": ("o_orderkey", "o_orderkey"), "order_id": ("o_orderkey", "o_orderkey"), "amount": ("cast(o_totalprice as decimal(12,2))", "CAST(o_totalprice AS DECIMAL(12,2))"), "payment_method": ("o_orderpriority", "o_orderpriority"), "payment_date": _time("o_orderdate"), "status": ("o_orderstatus", "o_orderstatus")})
_wire("shipping", "lineitem", {"shipping_id": ("l_orderkey * 8 + l_linenumber", "l_orderkey * 8 + l_linenumber"), "order_id": ("l_orderkey", "l_orderkey"), "city": ("l_returnflag", "l_returnflag"), "shipping_date": _time("l_shipdate"), "tracking_number": ("nullif(l_linestatus, 'O')", "nullif(l_linestatus, 'O')")})
_wire("product_reviews", "events", {"review_id": ("event_id", "event_id"), "product_id": ("user_id", "user_id"), "user_id": ("user_id", "user_id"), "rating": ("cast(floor(value) as int)", "floor(value)"), "comment": ("nullif(event_type, 'view')", "nullif(event_type, 'view')"), "created_at": _time("ts")})


@query(
    "s05_shard_stream",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def s05(t):
    out = work_path(t.spark, "shards")
    stream = jobs.file_stream(t.spark, t.folder, t.events.schema, glob="events.parquet", maxFilesPerTrigger="1")
    jobs.append_to(stream.select("event_id", "user_id", "event_type", "value"), out, out + "-checkpoint").awaitTermination()
    return t.spark.read.parquet(out)


@query(
    "s06_newer_files",
    """SELECT doc_id AS generation, source || '/' || doc_id || CASE lang WHEN 'en' THEN '.CSV' WHEN 'fr' THEN '.json' ELSE '.txt' END AS path
       FROM documents WHERE lang IN ('en','fr') AND doc_id > (SELECT max(doc_id) FROM labels WHERE toxic = 1) - 100""",
)
def s06(t):
    suffix = F.when(F.col("lang") == "en", ".CSV").when(F.col("lang") == "fr", ".json").otherwise(".txt")
    listing = t.documents.select(F.col("doc_id").alias("generation"), F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), suffix).alias("path"))
    mark = t.labels.where("toxic = 1").agg((F.max("doc_id") - 100).alias("m")).scalar()
    return files.newer_files(listing, mark)


@query(
    "s07_csv_typed_load",
    "SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS text_length, lang, CAST(NULL AS BIGINT) AS absent FROM documents",
)
def s07(t):
    path = work_path(t.spark, "documents-csv")
    (
        t.documents.select("doc_id", "source", "text", "lang", "n_chars")
        .write.option("header", "true").option("escape", '"').option("quoteAll", "true")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    )
    loaded = files.load_csv(t.spark, path, "doc_id long, text string, lang string, absent long")
    return loaded.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("text_length"), "lang", "absent")


@query(
    "s08_identifiers_as_text",
    """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity, l_returnflag FROM lineitem""",
)
def s08(t):
    path = work_path(t.spark, "lines-csv")
    t.lineitem.select(F.col("l_orderkey").cast("double").alias("l_orderkey"), "l_quantity", "l_returnflag").withColumn(
        "l_orderkey", F.col("l_orderkey").cast("decimal(20,1)").cast("string")
    ).write.option("header", "true").csv(path)
    rows = files.read_vendor_csv(t.spark, path)
    return rows.select(number_text(F.col("l_orderkey")).alias("l_orderkey"), number_text(F.col("l_quantity")).alias("quantity"), "l_returnflag")


@query("s10_json_lines", "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'")
def s10(t):
    path = work_path(t.spark, "events-json")
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("{"), line)).otherwise(line)
    t.events.select(broken.alias("value")).write.text(path)
    return files.read_json(t.spark, path, "event_id long, user_id long, event_type string, value double")


@query(
    "s10_json_arrays",
    "SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderstatus = 'F'",
)
def s10_arrays(t):
    path = work_path(t.spark, "orders-json")
    key = F.col("o_orderkey")
    order = F.struct(key.alias("o_orderkey"), F.col("o_custkey").alias("o_custkey"))
    second = F.when(F.col("o_orderstatus") == "F", F.struct(key.alias("o_orderkey"), F.lit(None).cast("long").alias("o_custkey")))
    t.orders.select(F.to_json(F.array_compact(F.array(order, second))).alias("value")).write.text(path)
    return files.read_json(t.spark, path, "o_orderkey long, o_custkey long")


@query("s11_seed_landing", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def s11(t):
    seed, landing = work_path(t.spark, "seed"), work_path(t.spark, "landing")
    t.customer.select("c_custkey", "c_name", "c_acctbal").write.option("header", "true").csv(seed)
    files.load_csv(t.spark, seed, "c_custkey long, c_name string, c_acctbal double", splittable=True).write.mode("overwrite").parquet(landing)
    return t.spark.read.parquet(landing)


@query("s12_partition_dedup", "SELECT DISTINCT event_id, user_id, event_type FROM events")
def s12(t):
    path = work_path(t.spark, "landed")
    rows = t.events.select("event_id", "user_id", "event_type", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    rows.drop("copy").write.parquet(path)
    return files.read_partition(t.spark, path)


@query(
    "s14_unit_prefixes",
    """SELECT DISTINCT s_suppkey AS unit, unnest(['in/' || s_suppkey || '/daily/', 'in/' || s_suppkey || '/']) AS prefix FROM supplier""",
)
def s14(t):
    units = t.supplier.select(F.col("s_suppkey").alias("unit"))
    return files.unit_prefixes(units, ["in/{unit}/daily/", "in/{unit}/", "in/{unit}/"], "unit")


@query(
    "s15_active_units",
    "SELECT l_suppkey, count(*) AS lines FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) GROUP BY 1",
)
def s15(t):
    lookup = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.when(F.col("s_acctbal") > 5000, "production").otherwise("test").alias("env_name"))
    active = files.active_units(lookup, "production", "l_suppkey")
    return t.lineitem.join(active, "l_suppkey", "left_semi").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lines"))
