"""The sample tables in the shapes the jobs expect, as DataFrame and as SQL.

The samples carry dates without a time of day; where a job needs one it is
derived from the key, so that both engines see the same value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.catalog.registry import Tables

CUTOFF = "1999-01-01"  # separates the stored snapshot from the new batch
DAY = "1998-08-21"  # the day of single-day jobs


def money(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(12,2)")


def doubles(df: DataFrame, *names: str) -> DataFrame:
    """Exact decimals become doubles at the very end."""
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def day_texts(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("date").cast("string") for n in names})


def plus_seconds(ts: str, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("long"), F.col(ts))


# --- shop ------------------------------------------------------------------

def bronze_orders(t: Tables) -> DataFrame:
    """Order versions: every order is created, F completes and P cancels it."""
    created = plus_seconds("o_orderdate", F.col("o_orderkey") * 37 % 86400)
    base = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        money("o_totalprice").alias("total_amount"), created.alias("created_at"), "o_orderstatus",
    )
    later = F.timestamp_add("SECOND", (F.col("user_id") % 5) * 86400 + 10800, F.col("created_at"))
    final = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "cancelled")
    versions = F.array_compact(
        F.array(
            F.struct(F.lit("created").alias("s"), F.col("created_at").alias("u")),
            F.when(final.isNotNull(), F.struct(final.alias("s"), later.alias("u"))),
        )
    )
    return base.withColumn("v", F.explode(versions)).select(
        "order_id", "user_id", F.col("v.s").alias("order_status"), "total_amount", "created_at", F.col("v.u").alias("updated_at")
    )


BRONZE_ORDERS = """
base_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
         o_orderdate + to_seconds((o_orderkey * 37) % 86400) AS created_at, o_orderstatus FROM orders),
bronze_orders AS (
  SELECT order_id, user_id, 'created' AS order_status, total_amount, created_at, created_at AS updated_at FROM base_orders
  UNION ALL
  SELECT order_id, user_id, CASE o_orderstatus WHEN 'F' THEN 'completed' ELSE 'cancelled' END, total_amount, created_at,
         created_at + to_seconds((user_id % 5) * 86400 + 10800) FROM base_orders WHERE o_orderstatus IN ('F','P')),
latest_orders AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, order_status DESC) AS rn FROM bronze_orders) WHERE rn = 1)
"""


def bronze_items(t: Tables) -> DataFrame:
    """Order items; a line number that occurs again is a later version."""
    return t.lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"), money("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("updated_at"),
    )


BRONZE_ITEMS = """
bronze_items AS (
  SELECT l_orderkey * 8 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, l_shipdate AS updated_at FROM lineitem),
latest_items AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY updated_at DESC, product_id DESC, quantity DESC, price DESC) AS rn FROM bronze_items) WHERE rn = 1)
"""


def bronze_payments(t: Tables) -> DataFrame:
    """One payment attempt per order line; returned lines failed."""
    start = F.timestamp_add(
        "SECOND", (F.col("l_orderkey") % 2000) * 86400 + F.col("l_linenumber") * 60, F.lit("1995-01-01").cast("timestamp_ntz")
    )
    return t.lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("payment_id"), F.col("l_orderkey").alias("order_id"),
        money("l_extendedprice").alias("amount"),
        F.when(F.col("l_linestatus") == "O", "card").otherwise("cash").alias("payment_method"),
        start.alias("payment_date"),
        F.when(F.col("l_returnflag") == "R", "failed").otherwise("completed").alias("status"),
        F.col("l_shipdate").alias("updated_at"),
    )


BRONZE_PAYMENTS = """
bronze_payments AS (
  SELECT l_orderkey * 8 + l_linenumber AS payment_id, l_orderkey AS order_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
         CASE WHEN l_linestatus = 'O' THEN 'card' ELSE 'cash' END AS payment_method,
         TIMESTAMP '1995-01-01' + to_seconds((l_orderkey % 2000) * 86400 + l_linenumber * 60) AS payment_date,
         CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'completed' END AS status, l_shipdate AS updated_at FROM lineitem)
"""


def bronze_products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), money("p_retailprice").alias("price"),
        F.col("p_size").alias("category_id"), F.lit("1995-01-01").cast("timestamp_ntz").alias("updated_at"),
    )


# --- dimensions ------------------------------------------------------------

def user_versions(t: Tables) -> DataFrame:
    """Users by the day of their orders; the day's last priority counts."""
    from harborline.operators.latest import latest_by_key

    daily = t.orders.select(
        F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("day"),
        F.col("o_orderpriority").alias("segment"), F.col("o_orderkey").alias("seq"),
    )
    return latest_by_key(daily, ["user_id", "day"], ["seq"]).drop("seq")


USER_VERSIONS = """
user_versions AS (
  SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS day, arg_max(o_orderpriority, o_orderkey) AS segment
  FROM orders GROUP BY 1, 2),
dim_user AS (
  SELECT md5(user_id || '|' || day) AS user_key, user_id, segment, day AS start_date,
         lead(day) OVER (PARTITION BY user_id ORDER BY day) AS end_date,
         CASE WHEN lead(day) OVER (PARTITION BY user_id ORDER BY day) IS NULL THEN 1 ELSE 0 END AS is_current
  FROM user_versions)
"""


def dim_user(t: Tables) -> DataFrame:
    from harborline.operators.scd import history

    return history(user_versions(t), "user_id", "user_key", "day")


def dim_product(t: Tables) -> DataFrame:
    """Product versions by ship day, with the day's highest unit price."""
    from harborline.operators.scd import history

    daily = t.lineitem.groupBy(F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("day")).agg(
        F.max(money("l_extendedprice")).alias("price")
    )
    with_category = daily.join(
        t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_size").alias("category_id")), "product_id", "left"
    )
    return history(with_category, "product_id", "product_key", "day")


DIM_PRODUCT = """
product_days AS (
  SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS day, max(CAST(l_extendedprice AS DECIMAL(12,2))) AS price
  FROM lineitem GROUP BY 1, 2),
dim_product AS (
  SELECT md5(d.product_id || '|' || day) AS product_key, d.product_id, price, p_size AS category_id, day AS start_date,
         lead(day) OVER (PARTITION BY d.product_id ORDER BY day) AS end_date,
         CASE WHEN lead(day) OVER (PARTITION BY d.product_id ORDER BY day) IS NULL THEN 1 ELSE 0 END AS is_current
  FROM product_days d LEFT JOIN part ON p_partkey = d.product_id)
"""


def dim_category(t: Tables) -> DataFrame:
    """Categories (sizes), renamed at the cutoff by the types sold in them."""
    from harborline.operators.scd import history

    first = t.part.groupBy(F.col("p_size").alias("category_id")).agg(F.min("p_type").alias("a"), F.max("p_type").alias("b"))
    versions = F.array(
        F.struct(F.lit("1995-01-01").cast("date").alias("day"), F.col("a").alias("name")),
        F.struct(F.lit(CUTOFF).cast("date").alias("day"), F.col("b").alias("name")),
    )
    rows = first.select("category_id", F.explode(versions).alias("v")).select("category_id", "v.name", "v.day")
    return history(rows, "category_id", "category_key", "day")


DIM_CATEGORY = """
category_days AS (
  SELECT p_size AS category_id, min(p_type) AS name, DATE '1995-01-01' AS day FROM part GROUP BY 1
  UNION ALL SELECT p_size, max(p_type), DATE '1999-01-01' FROM part GROUP BY 1),
dim_category AS (
  SELECT md5(category_id || '|' || day) AS category_key, category_id, name, day AS start_date,
         lead(day) OVER (PARTITION BY category_id ORDER BY day) AS end_date,
         CASE WHEN lead(day) OVER (PARTITION BY category_id ORDER BY day) IS NULL THEN 1 ELSE 0 END AS is_current
  FROM category_days)
"""


# --- silver tables of the star schema ---------------------------------------

def silver_orders(t: Tables) -> DataFrame:
    from harborline.plans.marts import latest_orders

    return latest_orders(bronze_orders(t)).withColumnsRenamed({"created_at": "created_time", "updated_at": "updated_time"})


def silver_shipping(t: Tables) -> DataFrame:
    """Place of delivery of an order: the nation and region of its customer."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    customers = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("order_id"), F.col("c_mktsegment").alias("postal_code"),
        F.col("r_name").alias("country"), F.col("n_name").alias("city"),
    )


def silver_payments(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("payment_method"))


SILVER = """
silver_orders AS (SELECT order_id, user_id, order_status, total_amount, created_at AS created_time, updated_at AS updated_time FROM latest_orders),
silver_shipping AS (
  SELECT o_orderkey AS order_id, c_mktsegment AS postal_code, r_name AS country, n_name AS city FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
silver_payments AS (SELECT o_orderkey AS order_id, o_orderpriority AS payment_method FROM orders),
fact_order AS (
  SELECT o.order_id, u.user_key, b.date_key, b.status AS order_status, o.created_time AS order_created_time, b.done AS order_completed_time,
         p.payment_method, s.postal_code, s.country, s.city, o.total_amount
  FROM (
    SELECT order_id, CAST(created_time AS DATE) AS date_key, 'created' AS status, CAST(NULL AS TIMESTAMP) AS done FROM silver_orders
    UNION ALL SELECT order_id, CAST(updated_time AS DATE), 'completed', updated_time FROM silver_orders WHERE order_status = 'completed'
    UNION ALL SELECT order_id, CAST(updated_time AS DATE), 'cancelled', NULL FROM silver_orders WHERE order_status = 'cancelled') b
  JOIN silver_orders o USING (order_id)
  JOIN dim_user u ON u.user_id = o.user_id AND u.start_date <= CAST(o.created_time AS DATE)
       AND (u.end_date > CAST(o.created_time AS DATE) OR u.is_current = 1)
  LEFT JOIN silver_shipping s ON s.order_id = o.order_id
  LEFT JOIN silver_payments p ON p.order_id = o.order_id)
"""


def silver_items(t: Tables) -> DataFrame:
    """Items as of their order: created when the order was placed."""
    orders = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("created_time"))
    items = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"), money("l_extendedprice").alias("price_amount"),
    )
    return items.join(orders, "order_id")


SILVER_ITEMS = """
silver_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price_amount, o_orderdate AS created_time
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
"""


# --- messaging -------------------------------------------------------------

def message_report(t: Tables) -> DataFrame:
    """Order lines as messages: the customer is the contact, the supplier the
    bot; flags, status and discount tell how far a message got."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    later = lambda cond, days: F.when(cond, F.date_add(F.col("l_shipdate"), days).cast("timestamp_ntz"))
    return lines.select(
        F.col("o_custkey").alias("contact_id"),
        F.col("l_orderkey").alias("report_id"),
        F.col("l_linenumber").alias("message_id"),
        F.col("l_suppkey").alias("bot_id"),
        F.col("l_returnflag").alias("sender_id"),
        F.concat_ws("_", "o_orderpriority", "l_linestatus").alias("template_id"),
        F.when(F.col("l_returnflag") == "R", "URL_CLICKED").otherwise("SENT").alias("status"),
        F.col("o_orderpriority").alias("name"),
        F.concat(F.lit("+91"), F.col("o_custkey").cast("string")).alias("phone"),
        F.col("l_shipdate").alias("sent_at"),
        later(F.col("l_tax") > 0, 1).alias("delivered_at"),
        later(F.col("l_discount") > 0.02, 2).alias("read_at"),
        later(F.col("l_discount") > 0.05, 3).alias("replied_at"),
        later(F.col("l_discount") > 0.09, 4).alias("clicked_at"),
        F.col("l_shipdate").alias("ingested_at"),
        F.col("l_partkey").alias("part_id"),
    )


MESSAGE_REPORT = """
message_report AS (
  SELECT o_custkey AS contact_id, l_orderkey AS report_id, l_linenumber AS message_id, l_suppkey AS bot_id, l_returnflag AS sender_id,
         o_orderpriority || '_' || l_linestatus AS template_id,
         CASE WHEN l_returnflag = 'R' THEN 'URL_CLICKED' ELSE 'SENT' END AS status, o_orderpriority AS name,
         '+91' || o_custkey AS phone, l_shipdate AS sent_at,
         CASE WHEN l_tax > 0 THEN l_shipdate + INTERVAL 1 DAY END AS delivered_at,
         CASE WHEN l_discount > 0.02 THEN l_shipdate + INTERVAL 2 DAY END AS read_at,
         CASE WHEN l_discount > 0.05 THEN l_shipdate + INTERVAL 3 DAY END AS replied_at,
         CASE WHEN l_discount > 0.09 THEN l_shipdate + INTERVAL 4 DAY END AS clicked_at,
         l_shipdate AS ingested_at, l_partkey AS part_id
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
"""


def senders(t: Tables) -> DataFrame:
    """Which brand (nation) a bot sends for; suppliers in debt are no bots."""
    return (
        t.supplier.where("s_acctbal > 0")
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("bot_id"), F.lit("R").alias("sender_id"), F.col("n_name").alias("brand_name"))
    )


SENDERS = """
senders AS (SELECT s_suppkey AS bot_id, 'R' AS sender_id, n_name AS brand_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0)
"""


def unsubscribes(t: Tables) -> DataFrame:
    """Returned open lines as unsubscribe requests."""
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("contact_id"), F.col("l_suppkey").alias("bot_id"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), "stop").alias("user_request"),
    )


UNSUBSCRIBES = """
unsubscribes AS (
  SELECT o_custkey AS contact_id, l_suppkey AS bot_id,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'stop' END AS user_request
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
"""


# --- contacts --------------------------------------------------------------

def contact_rows(t: Tables) -> DataFrame:
    """Orders as vendor records of their customer, as JSON documents."""
    o = t.orders
    email = F.concat(F.lit("user."), F.col("o_custkey").cast("string"), F.lit("+"), F.lower(F.substring("o_orderpriority", 1, 1)), F.lit("@example.org"))
    document = F.to_json(
        F.struct(
            F.when(F.col("o_orderstatus") != "P", email).alias("email"),
            F.when(F.col("o_orderstatus") != "O", F.concat(F.lit("+91"), F.col("o_custkey").cast("string"))).alias("normalized_phone"),
            F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Name"), F.col("o_custkey").cast("string"))).alias("first_name"),
            F.when(F.col("o_totalprice") > 400000, F.col("o_orderpriority")).otherwise(F.lit(" ")).alias("city_name"),
            F.when(F.col("o_totalprice") > 100000, F.concat_ws(",", "o_orderpriority", "o_orderstatus")).alias("brands"),
            F.when(F.col("o_totalprice") > 250000, "yes").when(F.col("o_totalprice") > 50000, "no").alias("is_parent"),
            F.year("o_orderdate").cast("string").alias("gr_source"),
            F.date_format(F.col("o_orderdate"), "yyyy-MM-dd").alias("first_seen"),
        )
    )
    return o.select(
        F.col("o_custkey").cast("string").alias("contact_id"), document.alias("document"),
        plus_seconds("o_orderdate", F.col("o_orderkey") * 37 % 86400).alias("ingested_at"), F.col("o_orderkey").alias("row_id"),
    )


CONTACT_ROWS = """
contact_rows AS (
  SELECT CAST(o_custkey AS VARCHAR) AS contact_id,
         CASE WHEN o_orderstatus <> 'P' THEN 'user.' || o_custkey || '+' || lower(substr(o_orderpriority,1,1)) || '@example.org' END AS email,
         CASE WHEN o_orderstatus <> 'O' THEN '+91' || o_custkey END AS normalized_phone,
         CASE WHEN o_orderstatus = 'F' THEN 'Name' || o_custkey END AS first_name,
         CASE WHEN o_totalprice > 400000 THEN o_orderpriority END AS city,
         CASE WHEN o_totalprice > 100000 THEN o_orderpriority || ',' || o_orderstatus END AS brands,
         CASE WHEN o_totalprice > 250000 THEN TRUE WHEN o_totalprice > 50000 THEN FALSE END AS parent_flag,
         CAST(year(o_orderdate) AS VARCHAR) AS gr_source, strftime(o_orderdate, '%Y-%m-%d') AS first_seen,
         o_orderdate + to_seconds((o_orderkey * 37) % 86400) AS ingested_at, o_orderkey AS row_id
  FROM orders)
"""


def attribute_map(t: Tables) -> DataFrame:
    """Attribute lookup: which document keys feed which attribute.

    The four fixed groups stand next to one group per product type, taken from
    the part table.
    """
    fixed = F.explode(
        F.array(
            *[
                F.struct(F.lit(g).alias("attribute_group"), F.lit(k).alias("attribute_name"))
                for g, k in (("city", "city_name"), ("city", "town"), ("source", "gr_source"), ("source", "first_seen"),
                             ("brands", "brands"), ("parent_flag", "is_parent"))
            ]
        )
    )
    from_groups = t.part.select(F.col("p_type").alias("attribute_group"), F.col("p_brand").alias("attribute_name")).distinct()
    constants = t.region.agg(F.count(F.lit(1)).alias("n")).select(fixed.alias("g")).select("g.*")
    return constants.unionByName(from_groups).withColumn("hmz_object", F.lit("contact"))
