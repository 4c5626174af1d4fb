"""Equi, as-of, existence and identity joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog import shapes as S
from harborline.catalog.registry import query
from harborline.operators import asof, scd
from harborline.operators.aggregates import recent_or_all
from harborline.operators.identity import attach_identity, balance, identity_table, triage
from harborline.operators.joins import lookup_join, salted_join
from harborline.plans import contacts
from harborline.plans.profile import require_engagement


@query(
    "j01_item_order_product",
    """SELECT o_orderkey, l_linenumber, p_name, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
       WHERE o_orderstatus = 'F'""",
)
def j01(t):
    done = t.orders.where("o_orderstatus = 'F'").select("o_orderkey")
    items = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return (
        done.join(items, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.part.select("p_partkey", "p_name"), F.col("p_partkey") == F.col("l_partkey"))
        .select("o_orderkey", "l_linenumber", "p_name", "l_quantity")
    )


@query(
    "j02_left_lookup",
    """SELECT e.event_id, c_name, n_name FROM events e LEFT JOIN customer ON c_custkey = user_id AND c_acctbal > 5000
       LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def j02(t):
    rich = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey")
    return (
        t.events.select("event_id", "user_id").join(rich, "user_id", "left")
        .join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey", "left")
        .select("event_id", "c_name", "n_name")
    )


@query(
    "j02_salted_lookup",
    """SELECT l_returnflag, n_name, count(*) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
       FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 0 LEFT JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2""",
)
def j02_salted(t):
    lines = t.lineitem.select("l_suppkey", "l_returnflag", "l_quantity", "l_orderkey", "l_linenumber")
    suppliers = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    joined = salted_join(lines, suppliers, ["l_suppkey"], ["l_orderkey", "l_linenumber"], "left", share=0.02)
    counted = joined.groupBy("l_returnflag", "s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("q")
    )
    named = counted.join(t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey", "left")
    return named.groupBy("l_returnflag", "n_name").agg(F.sum("n").alias("lines"), F.sum("q").alias("quantity"))


@query(
    "j03_composite_lookup",
    f"""WITH {S.MESSAGE_REPORT}, {S.SENDERS}
        SELECT report_id, message_id, part_id, brand_name FROM message_report r LEFT JOIN senders s ON r.bot_id = s.bot_id AND r.sender_id = s.sender_id
        WHERE brand_name IS NOT NULL""",
)
def j03(t):
    joined = S.message_report(t).join(S.senders(t), ["bot_id", "sender_id"], "left")
    return joined.where(F.col("brand_name").isNotNull()).select("report_id", "message_id", "part_id", "brand_name")


_ITEM_AT = f"{S.SILVER_ITEMS}, {S.DIM_PRODUCT}"
_VALID = "p.start_date <= CAST(i.created_time AS DATE) AND (p.end_date > CAST(i.created_time AS DATE) OR p.is_current = 1)"


@query(
    "j04_asof_inner",
    f"""WITH {_ITEM_AT}
        SELECT i.order_id, i.product_id, i.quantity, p.product_key, CAST(p.price AS DOUBLE) AS price
        FROM silver_items i LEFT JOIN dim_product p ON p.product_id = i.product_id WHERE {_VALID}""",
)
def j04(t):
    result = asof.version_at(S.silver_items(t), S.dim_product(t), "product_id", "created_time", ["product_key", "price"], keep_unmatched=False)
    return S.doubles(result.select("order_id", "product_id", "quantity", "product_key", "price"), "price")


@query(
    "j05_asof_left_chain",
    f"""WITH {_ITEM_AT}, {S.DIM_CATEGORY}
        SELECT i.order_id, i.product_id, i.quantity, p.product_key, c.category_key, c.name AS category
        FROM silver_items i LEFT JOIN dim_product p ON p.product_id = i.product_id AND {_VALID}
        LEFT JOIN dim_category c ON c.category_id = p.category_id AND c.start_date <= CAST(i.created_time AS DATE)
             AND (c.end_date > CAST(i.created_time AS DATE) OR c.is_current = 1)""",
)
def j05(t):
    products = asof.version_at(S.silver_items(t), S.dim_product(t), "product_id", "created_time", ["product_key", "category_id"])
    result = asof.version_at(products, S.dim_category(t), "category_id", "created_time", ["category_key", "name"])
    return result.select("order_id", "product_id", "quantity", "product_key", "category_key", F.col("name").alias("category"))


@query(
    "j05_asof_event_times",
    """SELECT e.event_id, p.event_id AS purchase_id, p.value AS purchase_value FROM events e
       ASOF LEFT JOIN (SELECT user_id, ts, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) p
       ON e.user_id = p.user_id AND e.ts >= p.ts""",
)
def j05_events(t):
    purchases = (
        t.events.where("event_type = 'purchase'").groupBy("user_id", "ts")
        .agg(F.max(F.struct("event_id", "value")).alias("m"))
        .select("user_id", F.col("ts").alias("at"), F.col("m.event_id").alias("purchase_id"), F.col("m.value").alias("purchase_value"))
    )
    joined = asof.asof_join(
        t.events.select("event_id", "user_id", "ts"), purchases, ["user_id"], "ts", "at", ["purchase_id", "purchase_value"], bucket="day"
    )
    return joined.select("event_id", "purchase_id", "purchase_value")


@query(
    "j06_expire_current",
    f"""WITH {S.USER_VERSIONS}
        SELECT o.user_key, o.user_id, o.segment, CAST(o.start_date AS VARCHAR) AS start_date, '2001-09-01' AS end_date, 0 AS is_current
        FROM dim_user o RIGHT JOIN (SELECT DISTINCT o_custkey AS user_id FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01') n ON n.user_id = o.user_id
        WHERE o.is_current = 1""",
)
def j06(t):
    changed = t.orders.where("o_orderdate >= timestamp_ntz'2001-01-01'").select(F.col("o_custkey").alias("user_id"))
    return S.day_texts(scd.expired_versions(S.dim_user(t), changed, "user_id", "2001-09-01"), "start_date", "end_date")


@query(
    "p04_recent_or_all",
    """SELECT 'recent' AS run, event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-29' GROUP BY 1, 2
       UNION ALL SELECT 'fallback', event_type, count(*) FROM events GROUP BY 1, 2""",
)
def p04(t):
    def count(run, since):
        rows = recent_or_all(t.events, F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
        return rows.groupBy(F.lit(run).alias("run"), "event_type").agg(F.count(F.lit(1)).alias("n"))

    return count("recent", "2024-01-29").unionByName(count("fallback", "2025-01-01"))


@query(
    "j07_not_exists",
    """SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01'
       OR NOT EXISTS (SELECT 1 FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01') GROUP BY 1""",
)
def j07(t):
    rows = recent_or_all(t.orders, F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp_ntz"))
    return rows.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "j08_scalar_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE list_contains((SELECT list(DISTINCT p_brand) FROM part WHERE p_type = 'PROMO' AND p_size > 45), p_brand)""",
)
def j08(t):
    brands = t.part.where("p_type = 'PROMO' AND p_size > 45").agg(F.collect_set("p_brand").alias("b")).scalar()
    wanted = t.part.where(F.array_contains(brands, F.col("p_brand"))).select(F.col("p_partkey").alias("l_partkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(wanted, "l_partkey")


@query(
    "j08_attribute_groups",
    """SELECT p_type AS attribute_group, array_to_string(list(DISTINCT p_brand ORDER BY p_brand), ',') AS names FROM part GROUP BY 1""",
)
def j08_groups(t):
    kinds = t.part.select(F.col("p_type").alias("attribute_group")).distinct()
    mapping = S.attribute_map(t).where(F.col("hmz_object") == "contact")
    names = mapping.groupBy("attribute_group").agg(F.array_join(F.array_sort(F.collect_set("attribute_name")), ",").alias("names"))
    return kinds.join(names, "attribute_group")


@query(
    "j09_require_engagement",
    """SELECT c_custkey, c_name, n FROM customer JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) ON user_id = c_custkey""",
)
def j09(t):
    engagement = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return require_engagement(t.customer.select("c_custkey", "c_name"), engagement, "c_custkey")


@query(
    "j10_unnest_elements",
    """SELECT o_orderkey, unnest(string_split(o_orderpriority || '-' || o_orderstatus, '-')) AS part FROM orders""",
)
def j10(t):
    pieces = F.to_json(F.split(F.concat_ws("-", "o_orderpriority", "o_orderstatus"), "-"))
    from harborline.functions.documents import elements

    return t.orders.select("o_orderkey", F.explode(elements(pieces)).alias("part"))


@query(
    "j11_join_key_aggregates",
    """SELECT user_id, n_orders, n_events, last_event FROM (SELECT o_custkey AS user_id, count(*) AS n_orders FROM orders GROUP BY 1)
       LEFT JOIN (SELECT user_id, count(*) AS n_events, max(ts) AS last_event FROM events GROUP BY 1) USING (user_id)""",
)
def j11(t):
    orders = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.count(F.lit(1)).alias("n_orders"))
    events = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.max("ts").alias("last_event"))
    return orders.join(events, "user_id", "left")


def _records(t):
    """Orders with an identifier each: by status a phone, a mail or neither."""
    name = F.concat(F.lit("+91"), F.col("o_custkey").cast("string"))
    mail = F.concat(F.lit("u"), F.col("o_custkey").cast("string"), F.lit("@example.org"))
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", name).alias("phone"),
        F.when(F.col("o_totalprice") > 150000, mail).alias("email"),
        F.when(F.col("o_totalprice") > 100000, F.md5("o_orderpriority")).alias("phone_hashed"),
        F.lit(None).cast("string").alias("email_hashed"),
    )


def _identities(t):
    """Known phones and mail addresses, from two overlapping customer groups."""
    people = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") > 3000, F.concat(F.lit("+91"), F.col("c_custkey").cast("string"))).alias("phone"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("u"), F.col("c_custkey").cast("string"), F.lit("@example.org"))).alias("email"),
    )
    return identity_table(people, "phone", "phone", "id"), identity_table(people, "email", "email", "id")


_IDENTIFIED = """
records AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN '+91' || o_custkey END AS phone,
  CASE WHEN o_totalprice > 150000 THEN 'u' || o_custkey || '@example.org' END AS email,
  o_totalprice > 100000 AS hashed FROM orders),
identified AS (
  SELECT r.*, COALESCE(p.c_custkey, m.c_custkey) AS identity FROM records r
  LEFT JOIN customer p ON p.c_acctbal > 3000 AND r.phone = '+91' || p.c_custkey
  LEFT JOIN customer m ON m.c_mktsegment <> 'BUILDING' AND r.email = 'u' || m.c_custkey || '@example.org'),
triaged AS (
  SELECT *, CASE WHEN identity IS NOT NULL THEN 'matched' WHEN phone IS NOT NULL OR email IS NOT NULL THEN 'error'
                 WHEN hashed THEN 'hash_only' ELSE 'error' END AS outcome FROM identified)
"""


def identified(t):
    by_phone, by_email = _identities(t)
    return attach_identity(_records(t), by_phone, by_email, ["o_orderkey"])


@query("j12_identity_enrichment", f"WITH {_IDENTIFIED} SELECT o_orderkey, phone, email, identity FROM identified")
def j12(t):
    return identified(t).select("o_orderkey", "phone", "email", "identity")


@query(
    "c18_identity_triage",
    f"""WITH {_IDENTIFIED}
        SELECT o_orderkey, identity, outcome, CASE WHEN outcome = 'error' THEN
          CASE WHEN phone IS NOT NULL AND email IS NOT NULL THEN 'Both phone ' || phone || ' and email ' || email || ' failed.'
               WHEN phone IS NOT NULL THEN 'Phone ' || phone || ' failed: no identity found.'
               WHEN email IS NOT NULL THEN 'Email ' || email || ' failed: no identity found.'
               ELSE 'No phone or email available for identity lookup.' END
          || CASE WHEN hashed THEN ' Record has hashed identifiers but phone/email lookup failed.' ELSE '' END END AS error_detail
        FROM triaged""",
)
def c18(t):
    return triage(identified(t)).select("o_orderkey", "identity", "outcome", "error_detail")


@query(
    "a16_row_balance",
    f"""WITH {_IDENTIFIED}
        SELECT count(*) AS total, count(*) FILTER (outcome = 'matched') AS matched, count(*) FILTER (outcome = 'hash_only') AS hash_only,
               count(*) FILTER (outcome = 'error') AS error, TRUE AS balanced FROM triaged""",
)
def a16(t):
    return balance(triage(identified(t)))


@query(
    "j12_missing_keys_spread",
    """SELECT d.doc_id, l.quality FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN doc_id END AS k FROM documents) d LEFT JOIN labels l ON l.doc_id = d.k""",
)
def j12_missing(t):
    docs = t.documents.select("doc_id", F.when(F.col("lang") == "en", F.col("doc_id")).alias("k"))
    labels = t.labels.select(F.col("doc_id").alias("k"), "quality")
    return lookup_join(docs, labels, ["k"], ["doc_id"]).select("doc_id", "quality")


@query(
    "j08_group_keys_in_documents",
    f"""WITH {S.CONTACT_ROWS} SELECT row_id, city FROM contact_rows""",
)
def j08_documents(t):
    from harborline.functions.documents import as_map, first_value

    rows = S.contact_rows(t).withColumn("keys", contacts.group_keys(S.attribute_map(t), "city"))
    return rows.select("row_id", first_value(as_map(F.col("document")), F.col("keys")).alias("city"))
