"""Data tests over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog import shapes as S
from harborline.catalog.registry import query
from harborline.operators import quality as Q
from harborline.sources.files import TypedField, parse_lines


@query(
    "q01_not_null",
    """SELECT 'event_id' AS column_name, count(*) FILTER (event_id IS NULL) AS failures FROM events
       UNION ALL SELECT 'flag', count(*) FILTER (event_type = 'view') FROM events UNION ALL SELECT 'user_id', count(*) FILTER (user_id IS NULL) FROM events""",
)
def q01(t):
    rows = t.events.select("event_id", "user_id", F.nullif("event_type", F.lit("view")).alias("flag"))
    return Q.null_counts(rows, ["event_id", "user_id", "flag"])


@query("q01_unique", "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q01_unique(t):
    return Q.duplicate_keys(t.lineitem.select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query(
    "q02_datetime_validity",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'opened' ELSE 'opened,clicked' END AS problems FROM orders WHERE o_orderstatus IN ('F','P')""",
)
def q02(t):
    status = F.col("o_orderstatus")
    rows = t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss").alias("delivered"),
        F.when(status == "O", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise(F.concat(F.lit("on "), "o_orderpriority")).alias("opened"),
        F.when(status == "P", "31.12.2020").otherwise(" ").alias("clicked"),
    )
    found = Q.invalid_datetimes(rows, ["delivered", "opened", "clicked"])
    return found.select("o_orderkey", F.array_join("problems", ",").alias("problems"))


@query(
    "q02_header_check",
    "SELECT count(*) AS rows_checked, 'phone' AS missing, 'c_acctbal,c_nationkey' AS unexpected FROM customer",
)
def q02_header(t):
    missing, unexpected = Q.header_check(t.customer, ["c_custkey", "c_name", "c_mktsegment", "phone"])
    return t.customer.agg(F.count(F.lit(1)).alias("rows_checked"), F.lit(",".join(missing)).alias("missing"), F.lit(",".join(sorted(unexpected))).alias("unexpected"))


@query(
    "q03_domain",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT (l_quantity BETWEEN 5 AND 45)",
)
def q03(t):
    return Q.out_of_range(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", 5, 45)


@query("q03_orphans", "SELECT d.doc_id, d.lang FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id")
def q03_orphans(t):
    return Q.orphans(t.documents.select("doc_id", "lang"), t.labels, "doc_id", "doc_id")


# --- typed text lines ------------------------------------------------------

FIELDS = [TypedField("key", "int"), TypedField("name", "text"), TypedField("flag", "bool"), TypedField("born", "date"), TypedField("stamp", "timestamp")]


def _lines(t):
    """Parts as CSV lines: large sizes have a surplus cell, small ones lack
    one, and some types carry unreadable values."""
    kind = F.col("p_type")
    cells = [
        F.when(kind == "PROMO", "x12").otherwise(F.col("p_partkey").cast("string")),
        F.concat(F.lit('"'), F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit('"')),
        F.when(kind == "LARGE", "Yes").when(kind == "SMALL", "0").otherwise(""),
        F.when(kind == "MEDIUM", "2020-02-30").otherwise("2020-02-28"),
        F.when(kind == "STANDARD", "28/02/2020").otherwise("2020-02-28 10:11:12 UTC"),
    ]
    line = F.when(F.col("p_size") > 40, F.concat_ws(",", *cells, F.lit("surplus"))).when(
        F.col("p_size") < 5, F.concat_ws(",", *cells[:4])
    ).otherwise(F.concat_ws(",", *cells))
    return t.part.select(F.col("p_partkey").alias("row_id"), line.alias("value"))


@query(
    "s13_typed_parse",
    """SELECT p_partkey AS row_id, CASE WHEN p_type <> 'PROMO' THEN CAST(p_partkey AS INTEGER) END AS key, replace(p_name, ' ', ', ') AS name,
         CASE p_type WHEN 'LARGE' THEN TRUE WHEN 'SMALL' THEN FALSE END AS flag, CASE WHEN p_type <> 'MEDIUM' THEN '2020-02-28' END AS born,
         CASE WHEN p_type <> 'STANDARD' THEN TIMESTAMP '2020-02-28 10:11:12' END AS stamp FROM part WHERE p_size BETWEEN 5 AND 40""",
)
def s13(t):
    records, _ = parse_lines(_lines(t), FIELDS)
    return S.day_texts(records, "born")


@query(
    "s13_quoted_cells",
    """SELECT p_partkey AS row_id, 'say "' || p_name || '", twice' AS name, 'plain "' || p_brand || '" cell' AS note FROM part WHERE p_size % 3 <> 0""",
)
def s13_quoted(t):
    """Doubled quotes inside quoted cells, quotes inside plain ones; in every third part a comma makes them three."""
    quoted = F.concat(F.lit('"say ""'), "p_name", F.lit('"", twice"'))
    plain = F.concat(F.lit('plain "'), F.when(F.col("p_size") % 3 == 0, "x, y").otherwise(F.col("p_brand")), F.lit('" cell'))
    lines = t.part.select(F.col("p_partkey").alias("row_id"), F.concat_ws(",", quoted, plain).alias("value"))
    return parse_lines(lines, [TypedField("name", "text"), TypedField("note", "text")])[0]


@query("q05_column_count_reject", "SELECT p_partkey AS row_id FROM part WHERE NOT (p_size BETWEEN 5 AND 40)")
def q05(t):
    _, rejected = parse_lines(_lines(t), FIELDS)
    return rejected.select("row_id")


@query(
    "q06_split_balance",
    "SELECT count(*) AS total, count(*) FILTER (p_size BETWEEN 5 AND 40) AS accepted, count(*) FILTER (NOT (p_size BETWEEN 5 AND 40)) AS rejected, TRUE AS balanced FROM part",
)
def q06(t):
    records, rejected = parse_lines(_lines(t), FIELDS)
    tagged = records.select(F.lit(True).alias("ok")).unionByName(rejected.select(F.lit(False).alias("ok")))
    counts = tagged.agg(F.count_if("ok").alias("accepted"), F.count_if(~F.col("ok")).alias("rejected"))
    total = t.part.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.select(total.alias("total"), "accepted", "rejected").withColumn("balanced", F.col("total") == F.col("accepted") + F.col("rejected"))
