"""Grouped, distinct and conditional aggregates, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog import shapes as S
from harborline.catalog.registry import query
from harborline.functions import documents as D
from harborline.operators import aggregates as A
from harborline.operators.conform import aligned_union
from harborline.operators.validation import VERDICTS
from harborline.plans import marts, messaging, warehouse
from harborline.settings import work_path
from harborline.sinks.tables import materialise

_SHOP = f"{S.BRONZE_ORDERS}, {S.BRONZE_ITEMS}"
_COMPLETED = f"""{_SHOP},
completed AS (
  SELECT o.order_id, o.user_id, o.created_at, CAST(o.updated_at AS DATE) AS day, i.product_id, i.quantity,
         CAST(i.price * i.quantity AS DECIMAL(22,2)) AS value
  FROM latest_orders o JOIN latest_items i ON o.order_id = i.order_id WHERE o.order_status = 'completed')"""


@query(
    "a01_hourly_revenue",
    f"""WITH {_COMPLETED}
        SELECT CAST(day AS VARCHAR) AS day, CAST(hour(created_at) AS INTEGER) AS hour, count(DISTINCT order_id) AS order_count,
               CAST(sum(quantity) AS BIGINT) AS items_sold, CAST(sum(value) AS DOUBLE) AS revenue FROM completed GROUP BY 1, 2""",
)
def a01(t):
    result = marts.order_revenue(S.bronze_orders(t), S.bronze_items(t))
    return S.day_texts(S.doubles(result, "revenue"), "day")


@query(
    "a02_unique_users",
    f"""WITH {S.BRONZE_ORDERS}
        SELECT CAST(CAST(updated_at AS DATE) AS VARCHAR) AS day, count(DISTINCT user_id) AS active_users, count(*) AS total_orders
        FROM latest_orders GROUP BY 1""",
)
def a02(t):
    return S.day_texts(marts.unique_users(S.bronze_orders(t)), "day")


_PAYMENTS = f"""{S.BRONZE_PAYMENTS},
last_payment AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, status DESC, amount DESC, payment_id DESC) AS rn FROM bronze_payments) WHERE rn = 1)"""


@query(
    "a03_payment_failure_rate",
    f"""WITH {_PAYMENTS}
        SELECT CAST(CAST(payment_date AS DATE) AS VARCHAR) AS day, count(*) FILTER (status = 'failed') AS failed, count(*) AS total,
               round(100.0 * count(*) FILTER (status = 'failed') / count(*), 2) AS failed_rate FROM last_payment GROUP BY 1""",
)
def a03(t):
    return S.day_texts(marts.payment_failures(S.bronze_payments(t)), "day")


@query(
    "a04_abnormal_spend",
    f"""WITH {_SHOP}
        SELECT user_id, CAST(sum(price * quantity) AS DOUBLE) AS total_order_value FROM latest_orders o JOIN latest_items i ON o.order_id = i.order_id
        WHERE created_at >= TIMESTAMP '2001-08-01' - INTERVAL 3650 DAY GROUP BY 1 HAVING sum(price * quantity) > 400""",
)
def a04(t):
    as_of = F.lit("2001-08-01").cast("timestamp_ntz")
    result = marts.abnormal_orders(S.bronze_orders(t), S.bronze_items(t), as_of, "3650 DAYS")
    return S.doubles(result, "total_order_value")


_STAR = f"{S.BRONZE_ORDERS}, {S.USER_VERSIONS}, {S.SILVER}, {S.SILVER_ITEMS}, {S.DIM_PRODUCT}, {S.DIM_CATEGORY}"
_DETAIL = """
detail AS (
  SELECT i.order_id, CAST(i.created_time AS DATE) AS date_key, p.product_key, c.category_key, i.quantity, i.price_amount
  FROM silver_items i
  LEFT JOIN dim_product p ON p.product_id = i.product_id AND p.start_date <= CAST(i.created_time AS DATE) AND (p.end_date > CAST(i.created_time AS DATE) OR p.is_current = 1)
  LEFT JOIN dim_category c ON c.category_id = p.category_id AND c.start_date <= CAST(i.created_time AS DATE) AND (c.end_date > CAST(i.created_time AS DATE) OR c.is_current = 1))
"""


def star_facts(t, day=None):
    fact = warehouse.fact_order(S.silver_orders(t), S.dim_user(t), S.silver_shipping(t), S.silver_payments(t), day)
    detail = warehouse.fact_order_detail_history(S.silver_items(t), S.dim_product(t), stored_categories(t))
    return fact, detail


def stored_categories(t):
    """The category dimension, written once: its size is known then, so the engine can spare the items a shuffle."""
    return materialise(S.dim_category(t), work_path(t.spark, "categories"))


@query(
    "a05_daily_transaction",
    f"""WITH {_STAR}, {_DETAIL}
        SELECT CAST(fo.date_key AS VARCHAR) AS date_key, fo.order_status, fo.payment_method, dc.name AS category, fo.country, fo.city,
               count(DISTINCT fo.order_id) AS total_order, count(DISTINCT fo.user_key) AS total_user,
               CAST(sum(fd.quantity) FILTER (fo.order_status = 'completed') AS BIGINT) AS items_sold,
               CAST(sum(fd.price_amount) FILTER (fo.order_status = 'completed') AS DOUBLE) AS total_revenue
        FROM fact_order fo LEFT JOIN detail fd ON fo.order_id = fd.order_id LEFT JOIN dim_category dc ON fd.category_key = dc.category_key
        GROUP BY 1, 2, 3, 4, 5, 6""",
)
def a05(t):
    fact, detail = star_facts(t)
    result = warehouse.daily_transaction(fact, detail, S.dim_category(t))
    return S.day_texts(S.doubles(result, "total_revenue"), "date_key")


@query(
    "a06_daily_new_users",
    """WITH f AS (SELECT user_id, min(CAST(ts AS DATE)) AS first_day FROM events GROUP BY 1)
       SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(DISTINCT e.user_id) AS active_user,
              count(DISTINCT CASE WHEN first_day = CAST(ts AS DATE) THEN e.user_id END) AS new_user
       FROM events e JOIN f USING (user_id) GROUP BY 1""",
)
def a06(t):
    first = t.events.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("first_day"))
    days = t.events.select("user_id", F.to_date("ts").alias("day")).distinct().join(first, "user_id")
    result = days.groupBy("day").agg(
        F.count_distinct("user_id").alias("active_user"),
        A.count_distinct_if(F.col("user_id"), F.col("first_day") == F.col("day")).alias("new_user"),
    )
    return S.day_texts(result, "day")


_BRAND_COUNTS = """
brand_counts AS (
  SELECT contact_id, brand_name, count(sent_at) AS sent, count(delivered_at) AS delivered, count(read_at) AS read, count(replied_at) AS replied,
         CASE WHEN count(clicked_at) > 0 THEN count(clicked_at) ELSE count(*) FILTER (status = 'URL_CLICKED') END AS clicked
  FROM message_report r JOIN senders s ON r.bot_id = s.bot_id AND r.sender_id = s.sender_id WHERE sent_at IS NOT NULL GROUP BY 1, 2)
"""


@query(
    "a07_brand_stage_counts",
    f"WITH {S.MESSAGE_REPORT}, {S.SENDERS}, {_BRAND_COUNTS} SELECT * FROM brand_counts",
)
def a07(t):
    return messaging.brand_counts(S.message_report(t), S.senders(t))


BRAND_METRICS = """
brand_metrics AS (
  SELECT contact_id, '{' || string_agg(fragment, ', ' ORDER BY fragment) || '}' AS brand_metrics FROM (
    SELECT contact_id, '"' || brand_name || '":{"sent":' || sent || ',"delivered":' || delivered || ',"read":' || read || ',"replied":' || replied || ',"clicked":' || clicked || '}' AS fragment
    FROM brand_counts) GROUP BY 1)
"""


@query(
    "a08_brand_metrics_json",
    f"WITH {S.MESSAGE_REPORT}, {S.SENDERS}, {_BRAND_COUNTS}, {BRAND_METRICS} SELECT * FROM brand_metrics",
)
def a08(t):
    return messaging.brand_metrics(S.message_report(t), S.senders(t))


@query(
    "a13_distinct_dimension",
    "SELECT DISTINCT upper(md5(p_brand)) AS brand_key, p_brand, p_type FROM part",
)
def a13(t):
    from harborline.functions.security import md5_key

    return t.part.select(md5_key(F.col("p_brand")).alias("brand_key"), "p_brand", "p_type").distinct()


@query(
    "a14_high_water_mark",
    "SELECT source, lang, COALESCE(max(CASE WHEN n_chars > 500 THEN doc_id END), 0) AS generation FROM documents GROUP BY 1, 2",
)
def a14(t):
    audit = t.documents.select("source", "lang", F.when(F.col("n_chars") > 500, F.col("doc_id")).alias("generation"))
    return A.high_water_mark(audit, ["source", "lang"], "generation")


@query(
    "a15_verdict_tally",
    """SELECT count(*) FILTER (v = 'valid') AS valid_count, count(*) FILTER (v = 'invalid') AS invalid_count, count(*) FILTER (v = 'catchall') AS catchall_count,
              count(*) FILTER (v = 'unknown') AS unknown_count, count(*) FILTER (v = 'disposable') AS disposable_count
       FROM (SELECT CASE event_type WHEN 'view' THEN 'valid' WHEN 'click' THEN 'invalid' WHEN 'purchase' THEN 'catchall' WHEN 'signup' THEN 'unknown' ELSE 'disposable' END AS v FROM events)""",
)
def a15(t):
    verdict = F.col("event_type")
    for word, verdict_name in zip(["view", "click", "purchase", "signup", "error"], VERDICTS):
        verdict = F.when(F.col("event_type") == word, verdict_name).otherwise(verdict)
    return A.verdict_counts(t.events.select(verdict.alias("verdict")), "verdict", VERDICTS)


@query(
    "t01_ordered_report",
    "SELECT o_orderpriority, o_orderstatus, count(*) AS orders FROM orders GROUP BY 1, 2 ORDER BY 1, 2",
)
def t01(t):
    return t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("orders")).orderBy("o_orderpriority", "o_orderstatus")


@query(
    "t02_top_products",
    f"""WITH {_COMPLETED}
        SELECT p_name AS name, CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(value) AS DOUBLE) AS revenue
        FROM completed JOIN part ON product_id = p_partkey GROUP BY 1 ORDER BY sum(value) DESC, p_name LIMIT 10""",
)
def t02(t):
    result = marts.top_products(S.bronze_orders(t), S.bronze_items(t), S.bronze_products(t))
    return S.doubles(result, "revenue")


@query("t03_head_sample", "SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 4000")
def t03(t):
    return t.documents.select("doc_id", "source", "n_chars").orderBy("doc_id").limit(4000)


@query(
    "o01_status_branches",
    """SELECT o_orderkey AS order_id, 'created' AS status, o_orderdate AS since FROM orders
       UNION ALL SELECT o_orderkey, 'completed', o_orderdate + INTERVAL 1 DAY FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, 'cancelled', o_orderdate + INTERVAL 2 DAY FROM orders WHERE o_orderstatus = 'P'""",
)
def o01(t):
    status = F.col("o_orderstatus")
    branch = lambda name, days: F.struct(F.lit(name).alias("status"), F.date_add("o_orderdate", days).cast("timestamp_ntz").alias("since"))
    branches = F.array_compact(
        F.array(branch("created", 0), F.when(status == "F", branch("completed", 1)), F.when(status == "P", branch("cancelled", 2)))
    )
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.explode(branches).alias("b")).select("order_id", "b.status", "b.since")


@query(
    "o03_aligned_union",
    """SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS value, NULL::BIGINT AS size FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal, NULL FROM supplier
       UNION ALL SELECT p_partkey, p_name, NULL, NULL, CAST(p_size AS BIGINT) FROM part
       UNION ALL SELECT user_id, NULL, event_type, value, NULL FROM events""",
)
def o03(t):
    return aligned_union(
        [
            t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
            t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("value")),
            t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").cast("long").alias("size")),
            t.events.select(F.col("user_id").alias("id"), F.col("event_type").alias("segment"), "value"),
        ]
    )


@query(
    "u08_values_across_sources",
    """SELECT id, string_agg(DISTINCT v, ',' ORDER BY v) AS combined FROM (
         SELECT o_custkey AS id, o_orderstatus AS v FROM orders UNION ALL SELECT o_custkey, o_orderpriority FROM orders) GROUP BY 1""",
)
def u08(t):
    rows = t.orders.select(F.col("o_custkey").alias("id"), F.explode(F.array("o_orderstatus", "o_orderpriority")).alias("v"))
    once = rows.distinct().groupBy("id").agg(F.array_sort(F.collect_list("v")).alias("vs"))
    return once.select("id", D.distinct_values(F.col("vs")).alias("combined"))
