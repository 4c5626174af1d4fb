"""Latest-version, priority and survivorship queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog.registry import query
from harborline.operators import latest as L
from harborline.operators.aggregates import joined_distinct

EVENT_COLUMNS = ["user_id", "event_id", "ts", "event_type", "value", "props"]


@query(
    "w01_latest_event_per_user",
    """SELECT user_id, event_id, ts, event_type, value, props FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def w01(t):
    return L.latest_by_key(t.events.select(*EVENT_COLUMNS), ["user_id"], ["ts", "event_id"])


@query(
    "w02_latest_with_priority",
    """SELECT user_id, day, event_id, event_type FROM (
         SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, event_type, row_number() OVER (
           PARTITION BY user_id, CAST(ts AS DATE)
           ORDER BY date_trunc('hour', ts) DESC, CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 3 END, event_id) AS rn
         FROM events) WHERE rn = 1""",
)
def w02(t):
    priority = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "signup", 2).otherwise(3)
    rows = t.events.select(
        "user_id", F.to_date("ts").cast("string").alias("day"), "event_id", "event_type",
        F.date_trunc("hour", "ts").alias("hour"), priority.alias("priority"),
    )
    newest = L.latest_by_key(rows, ["user_id", "day"], ["hour", -F.col("priority"), -F.col("event_id")])
    return newest.drop("hour", "priority")


@query(
    "w03_two_stage_dedup",
    """SELECT user_id, event_type, day, event_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day, event_id, value ORDER BY event_id) AS r2 FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY ts DESC, event_id DESC) AS r1 FROM (
             SELECT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, value, ts FROM events
             UNION ALL SELECT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR), event_id, value, ts FROM events)) WHERE r1 = 1) WHERE r2 = 1""",
)
def w03(t):
    rows = t.events.select("user_id", "event_type", F.to_date("ts").cast("string").alias("day"), "event_id", "value", "ts")
    doubled = rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return L.two_stage_dedup(doubled, ["user_id", "event_type", "day"], ["ts", "event_id"]).drop("ts")


@query(
    "w04_latest_sender",
    """SELECT o_custkey AS contact_id, l_suppkey AS bot_id, l_partkey AS part_id FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, l_shipdate DESC, o_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE rn = 1""",
)
def w04(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("contact_id"), F.col("l_suppkey").alias("bot_id"), F.col("l_partkey").alias("part_id"),
        "o_orderdate", "l_shipdate", "o_orderkey", "l_linenumber",
    )
    order = ["o_orderdate", "l_shipdate", "o_orderkey", "l_linenumber", "part_id", "bot_id"]
    return L.latest_by_key(lines, ["contact_id"], order).select("contact_id", "bot_id", "part_id")


@query(
    "w05_first_brand",
    """SELECT l_orderkey AS order_key, p_brand AS brand FROM (
         SELECT l_orderkey, p_brand, row_number() OVER (PARTITION BY l_orderkey ORDER BY p_brand) AS rn
         FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE rn = 1""",
)
def w05(t):
    brands = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("order_key"), F.col("p_brand").alias("brand")
    )
    return L.first_per_group(brands, ["order_key"], "brand")


_SPARSE = """
sparse AS (SELECT user_id, ts, event_id,
  CASE WHEN event_type = 'purchase' THEN value END AS purchase_value,
  CASE WHEN event_type <> 'view' THEN event_type END AS last_action,
  CASE WHEN event_type = 'error' THEN props END AS error_props FROM events)
"""


def _sparse(t):
    kind = F.col("event_type")
    return t.events.select(
        "user_id", "ts", "event_id",
        F.when(kind == "purchase", F.col("value")).alias("purchase_value"),
        F.when(kind != "view", kind).alias("last_action"),
        F.when(kind == "error", F.col("props")).alias("error_props"),
    )


@query(
    "w06_first_nonnull_survivorship",
    f"""WITH {_SPARSE}
        SELECT DISTINCT user_id,
          first_value(purchase_value IGNORE NULLS) OVER w AS purchase_value,
          first_value(last_action IGNORE NULLS) OVER w AS last_action,
          first_value(error_props IGNORE NULLS) OVER w AS error_props
        FROM sparse
        WINDOW w AS (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def w06(t):
    return L.latest_values(_sparse(t), ["user_id"], ["purchase_value", "last_action", "error_props"], ["ts", "event_id"])


@query(
    "w06_earliest_nonnull",
    f"""WITH {_SPARSE}
        SELECT DISTINCT user_id,
          first_value(purchase_value IGNORE NULLS) OVER w AS purchase_value,
          first_value(last_action IGNORE NULLS) OVER w AS last_action
        FROM sparse
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def w06_earliest(t):
    return L.earliest_values(_sparse(t), ["user_id"], ["purchase_value", "last_action"], ["ts", "event_id"])


@query(
    "w07_cross_source_survivorship",
    """WITH rows AS (
         SELECT o_custkey AS id, o_orderdate AS happened, o_orderkey AS seq, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS priority, NULL AS flag FROM orders
         UNION ALL SELECT o_custkey, l_shipdate, l_orderkey * 8 + l_linenumber, NULL, CASE WHEN l_linestatus = 'O' THEN l_returnflag END FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
       SELECT id, arg_max(priority, (happened, seq, priority)) FILTER (priority IS NOT NULL) AS priority,
              arg_max(flag, (happened, seq, flag)) FILTER (flag IS NOT NULL) AS flag FROM rows GROUP BY id""",
)
def w07(t):
    orders = t.orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("priority"),
    )
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("id"), F.col("l_shipdate").alias("at"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
        F.when(F.col("l_linestatus") == "O", F.col("l_returnflag")).alias("flag"),
    )
    rows = orders.unionByName(lines, allowMissingColumns=True)
    return L.latest_values(rows, ["id"], ["priority", "flag"], ["at", "seq", "priority", "flag"])


@query(
    "a10_ordered_array",
    """SELECT user_id, array_to_string(list(event_type ORDER BY newest DESC, event_type DESC), ',') AS types FROM (
         SELECT user_id, event_type, max(ts) AS newest FROM events GROUP BY 1, 2) GROUP BY 1""",
)
def a10(t):
    arrays = L.ordered_array(t.events, ["user_id"], "event_type", ["ts"], "types")
    return arrays.select("user_id", F.array_join("types", ",").alias("types"))


@query(
    "a11_distinct_arrays",
    """SELECT p_brand, array_to_string(list(DISTINCT p_type ORDER BY p_type), ',') AS types, CAST(count(*) AS BIGINT) AS parts FROM part GROUP BY 1""",
)
def a11(t):
    counted = t.part.groupBy("p_brand", "p_type").count()
    return counted.groupBy("p_brand").agg(
        F.array_join(F.array_sort(F.collect_list("p_type")), ",").alias("types"), F.sum("count").alias("parts")
    )


@query(
    "a12_survivorship_extremes",
    """SELECT o_custkey AS user_id, max(o_orderdate) AS newest, min(o_orderdate) AS oldest, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority
       FROM orders GROUP BY 1""",
)
def a12(t):
    return t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.max("o_orderdate").alias("newest"), F.min("o_orderdate").alias("oldest"),
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("priority"),
    )


@query(
    "a09_optout_list",
    """SELECT user_id, '{"optOut_types": [' || string_agg(DISTINCT '"' || event_type || '"', ', ' ORDER BY '"' || event_type || '"') || ']}' AS opt_out
       FROM events WHERE value > 30 GROUP BY 1""",
)
def a09(t):
    listed = joined_distinct(
        t.events.where("value > 30").select("user_id", F.concat(F.lit('"'), "event_type", F.lit('"')).alias("quoted")),
        ["user_id"], "quoted", "items", ", ",
    )
    return listed.select("user_id", F.concat(F.lit('{"optOut_types": ['), "items", F.lit("]}")).alias("opt_out"))


@query(
    "a17_first_row_per_flight",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey) AS rn FROM lineitem) WHERE rn = 1""",
)
def a17(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_shipdate", "l_partkey")).alias("m")).select(
        "l_orderkey", "l_linenumber", "m.l_partkey", "m.l_shipdate"
    )
