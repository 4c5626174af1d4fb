"""Whole jobs: silver and star schema, retail, flights, contacts, messaging,
golden profile, file ingestion, admission, validation and protection."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog import shapes as S
from harborline.catalog.aggregates import _DETAIL, _STAR, BRAND_METRICS, _BRAND_COUNTS, star_facts
from harborline.catalog.documents import _ADDRESSES, crm_raw
from harborline.catalog.projections import TELEMETRY, telemetry
from harborline.catalog.registry import query
from harborline.operators import scd
from harborline.operators.admission import admission, recover
from harborline.operators.latest import latest_by_key
from harborline.functions.documents import as_map
from harborline.operators.once import once
from harborline.operators.validation import validation_cycle
from harborline.plans import contacts, ingest, marts, messaging, profile, retail, warehouse
from harborline.settings import work_path
from harborline.sinks.tables import materialise
from harborline.streaming import flights

NOW = "2002-01-01 00:00:00"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


# --- shop ------------------------------------------------------------------

@query(
    "c01_latest_orders",
    f"WITH {S.BRONZE_ORDERS} SELECT order_id, user_id, order_status, CAST(total_amount AS DOUBLE) AS total_amount, created_at, updated_at FROM latest_orders",
)
def c01(t):
    return S.doubles(marts.latest_orders(S.bronze_orders(t)), "total_amount")


@query(
    "c02_bronze_to_silver",
    f"WITH {S.BRONZE_ORDERS} SELECT order_id, user_id, order_status, CAST(total_amount AS DOUBLE) AS total_amount, created_at AS created_time, updated_at AS updated_time FROM bronze_orders",
)
def c02(t):
    return S.doubles(warehouse.bronze_to_silver(S.bronze_orders(t)), "total_amount")


@query(
    "c02_bronze_to_silver_day",
    f"WITH {S.BRONZE_ORDERS} SELECT order_id, order_status, updated_at AS updated_time FROM bronze_orders WHERE CAST(updated_at AS DATE) = DATE '{S.DAY}'",
)
def c02_day(t):
    return warehouse.bronze_to_silver(S.bronze_orders(t), S.DAY).select("order_id", "order_status", "updated_time")


_SCD = """
before_days AS (SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS day, arg_max(o_orderpriority, o_orderkey) AS segment FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY 1, 2),
dim AS (SELECT md5(user_id || '|' || day) AS user_key, user_id, segment, day AS start_date, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS end_date,
        CASE WHEN lead(day) OVER (PARTITION BY user_id ORDER BY day) IS NULL THEN 1 ELSE 0 END AS is_current FROM before_days),
changes AS (SELECT o_custkey AS user_id, arg_max(o_orderpriority, o_orderkey) AS segment FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY 1),
fresh AS (SELECT md5(user_id || '|2002-01-01') AS user_key, user_id, segment, DATE '2002-01-01' AS start_date, CAST(NULL AS DATE) AS end_date, 1 AS is_current FROM changes)
"""


def _scd_inputs(t):
    early = F.col("o_orderdate") < F.lit(S.CUTOFF).cast("timestamp_ntz")
    daily = t.orders.where(early).groupBy(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("day")).agg(
        F.max_by("o_orderpriority", "o_orderkey").alias("segment")
    )
    changes = t.orders.where(~early).groupBy(F.col("o_custkey").alias("user_id")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("segment"))
    return scd.history(daily, "user_id", "user_key", "day"), changes


@query(
    "c03_scd2_apply",
    f"""WITH {_SCD}
        SELECT user_key, user_id, segment, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, is_current FROM (
          SELECT d.user_key, d.user_id, d.segment, d.start_date, CASE WHEN d.is_current = 1 AND c.user_id IS NOT NULL THEN DATE '2002-01-01' ELSE d.end_date END AS end_date,
                 CASE WHEN c.user_id IS NOT NULL THEN 0 ELSE d.is_current END AS is_current FROM dim d LEFT JOIN changes c USING (user_id)
          UNION ALL SELECT * FROM fresh)""",
)
def c03(t):
    dim, changes = _scd_inputs(t)
    return S.day_texts(scd.scd2_apply(dim, changes, "user_id", "user_key", "2002-01-01"), "start_date", "end_date")


@query(
    "c03_scd2_insert_only",
    f"""WITH {_SCD}
        SELECT user_key, user_id, segment, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, is_current FROM (
          SELECT * FROM fresh UNION ALL
          SELECT user_key, d.user_id, d.segment, start_date, DATE '2002-01-01', 0 FROM dim d JOIN changes c USING (user_id) WHERE is_current = 1)""",
)
def c03_changes(t):
    dim, changes = _scd_inputs(t)
    return S.day_texts(scd.scd2_changes(dim, changes, "user_id", "user_key", "2002-01-01"), "start_date", "end_date")


@query(
    "o02_new_and_expired",
    f"""WITH {_SCD} SELECT is_current, count(*) AS versions FROM (
          SELECT is_current FROM fresh UNION ALL SELECT 0 FROM dim d JOIN changes c USING (user_id) WHERE is_current = 1) GROUP BY 1""",
)
def o02(t):
    dim, changes = _scd_inputs(t)
    added = scd.scd2_changes(dim, changes, "user_id", "user_key", "2002-01-01")
    return added.groupBy("is_current").agg(F.count(F.lit(1)).alias("versions"))


_FACT_COLUMNS = """order_id, user_key, CAST(date_key AS VARCHAR) AS date_key, order_status, order_created_time, order_completed_time, payment_method, postal_code, country, city, CAST(total_amount AS DOUBLE) AS total_amount"""


def _fact(t, day=None):
    fact = warehouse.fact_order(S.silver_orders(t), S.dim_user(t), S.silver_shipping(t), S.silver_payments(t), day)
    return S.day_texts(S.doubles(fact, "total_amount"), "date_key")


@query("c04_fact_order", f"WITH {S.BRONZE_ORDERS}, {S.USER_VERSIONS}, {S.SILVER} SELECT {_FACT_COLUMNS} FROM fact_order")
def c04(t):
    return _fact(t)


@query(
    "c04_fact_order_day",
    f"WITH {S.BRONZE_ORDERS}, {S.USER_VERSIONS}, {S.SILVER} SELECT {_FACT_COLUMNS} FROM fact_order WHERE date_key = DATE '{S.DAY}'",
)
def c04_day(t):
    return _fact(t, S.DAY)


_DETAIL_COLUMNS = "order_id, CAST(date_key AS VARCHAR) AS date_key, product_key, category_key, quantity, CAST(price_amount AS DOUBLE) AS price_amount"


@query("c05_fact_order_detail", f"WITH {_STAR}, {_DETAIL} SELECT {_DETAIL_COLUMNS} FROM detail")
def c05(t):
    detail = warehouse.fact_order_detail_history(S.silver_items(t), S.dim_product(t), S.dim_category(t))
    return S.day_texts(S.doubles(detail, "price_amount"), "date_key")


@query("c05_fact_order_detail_day", f"WITH {_STAR}, {_DETAIL} SELECT {_DETAIL_COLUMNS} FROM detail WHERE date_key = DATE '{S.DAY}'")
def c05_day(t):
    detail = warehouse.fact_order_detail(S.silver_items(t), S.dim_product(t), S.dim_category(t), S.DAY)
    return S.day_texts(S.doubles(detail, "price_amount"), "date_key")


@query(
    "c06_daily_user",
    f"""WITH {S.BRONZE_ORDERS}, {S.USER_VERSIONS}, {S.SILVER}, born AS (SELECT user_id, min(day) AS created FROM user_versions GROUP BY 1)
        SELECT CAST(fo.date_key AS VARCHAR) AS date_key, count(DISTINCT du.user_id) AS active_user, count(DISTINCT CASE WHEN b.created = fo.date_key THEN du.user_id END) AS new_user
        FROM fact_order fo JOIN dim_user du ON fo.user_key = du.user_key JOIN born b ON b.user_id = du.user_id GROUP BY 1""",
)
def c06(t):
    fact = warehouse.fact_order(S.silver_orders(t), S.dim_user(t), S.silver_shipping(t), S.silver_payments(t))
    born = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.min("o_orderdate").alias("created_time"))
    users = S.dim_user(t).select("user_key", "user_id").join(born, "user_id")
    return S.day_texts(warehouse.daily_user(fact, users), "date_key")


@query(
    "c06_daily_transaction_day",
    f"""WITH {_STAR}, {_DETAIL}
        SELECT fo.order_status, fo.payment_method, dc.name AS category, fo.country, fo.city, count(DISTINCT fo.order_id) AS total_order, count(DISTINCT fo.user_key) AS total_user,
               CAST(sum(fd.quantity) FILTER (fo.order_status = 'completed') AS BIGINT) AS items_sold, CAST(sum(fd.price_amount) FILTER (fo.order_status = 'completed') AS DOUBLE) AS total_revenue
        FROM fact_order fo LEFT JOIN detail fd ON fo.order_id = fd.order_id LEFT JOIN dim_category dc ON fd.category_key = dc.category_key
        WHERE fo.date_key = DATE '{S.DAY}' GROUP BY 1, 2, 3, 4, 5""",
)
def c06_day(t):
    fact, detail = star_facts(t, S.DAY)
    fact = materialise(fact, work_path(t.spark, "day-facts"))  # read twice: for its orders' items, and beside them
    result = warehouse.daily_transaction(fact, detail, S.dim_category(t), S.DAY)
    return S.doubles(result.drop("date_key"), "total_revenue")


@query(
    "c07_dim_date",
    """WITH days AS (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM orders),
       n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1)
       SELECT CAST(d AS VARCHAR) AS date_key, CAST(date_trunc('week', d) AS VARCHAR)[:10] AS start_day_of_week, CAST(date_trunc('month', d) AS VARCHAR)[:10] AS start_day_of_month,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend, dayname(d) AS day_name, monthname(d) AS month_name,
         COALESCE(orders, 0) AS orders FROM days LEFT JOIN n USING (d)""",
)
def c07(t):
    day = F.to_date("o_orderdate")
    bounds = t.orders.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    counts = t.orders.groupBy(day.alias("date_key")).agg(F.count(F.lit(1)).alias("orders"))
    days = warehouse.calendar(warehouse.day_range(bounds, "lo", "hi")).join(counts, "date_key", "left").fillna(0, ["orders"])
    return S.day_texts(days, "date_key", "start_day_of_week", "start_day_of_month")


@query(
    "c08_stale_orders",
    f"""WITH {S.BRONZE_ORDERS}
        SELECT order_id, created_at, TIMESTAMP '2001-08-02 10:30:00' AS as_of, date_diff('hour', created_at, TIMESTAMP '2001-08-02 10:30:00') AS hours_since_order
        FROM latest_orders WHERE order_status = 'created' AND date_diff('hour', created_at, TIMESTAMP '2001-08-02 10:30:00') > 1""",
)
def c08_stale(t):
    return marts.stale_orders(S.bronze_orders(t), F.lit("2001-08-02 10:30:00").cast("timestamp_ntz"))


@query(
    "c08_revenue_today",
    f"""WITH {S.BRONZE_ORDERS}, {S.BRONZE_ITEMS}
        SELECT CAST(hour(o.created_at) AS INTEGER) AS hour, count(DISTINCT o.order_id) AS order_count, CAST(sum(quantity) AS BIGINT) AS items_sold, CAST(sum(price * quantity) AS DOUBLE) AS revenue
        FROM latest_orders o JOIN latest_items i ON o.order_id = i.order_id WHERE CAST(o.updated_at AS DATE) = DATE '{S.DAY}' AND order_status = 'completed' GROUP BY 1""",
)
def c08_revenue(t):
    return S.doubles(marts.order_revenue(S.bronze_orders(t), S.bronze_items(t), S.DAY).drop("day"), "revenue")


@query(
    "k07_replay_guard",
    f"""WITH {S.USER_VERSIONS} SELECT count(*) AS versions, TRUE AS same_day_refused, FALSE AS next_day_refused FROM dim_user""",
)
def k07(t):
    dim = S.dim_user(t)
    last = dim.agg(F.max("start_date").cast("string").alias("d")).first()["d"]

    def refused(day):
        try:
            scd.guard_dimension(dim, day)
        except ValueError:
            return True
        return False

    return dim.agg(F.count(F.lit(1)).alias("versions")).select(
        "versions", F.lit(refused(last)).alias("same_day_refused"), F.lit(refused("2099-01-01")).alias("next_day_refused")
    )


# --- retail ----------------------------------------------------------------

def _sales(t):
    day = lambda c: F.date_format(c, "MM/dd/yyyy")
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("territory_key")), "l_suppkey"
    )
    return lines.select(
        day("o_orderdate").alias("order_date"), day("l_shipdate").alias("stock_date"), F.col("l_orderkey").alias("order_number"), F.col("l_partkey").alias("product_key"),
        F.col("o_custkey").alias("customer_key"), "territory_key", F.col("l_quantity").cast("int").alias("order_quantity"),
    )


def _products(t):
    return t.part.select(
        F.col("p_partkey").alias("product_key"), F.col("p_size").alias("product_subcategory_key"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("product_sku"),
        F.col("p_type").alias("product_color"), S.money("p_retailprice").alias("product_price"), F.col("p_size").cast("decimal(12,2)").alias("product_cost"),
    )


def _territories(t):
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("sales_territory_key"), F.col("n_name").alias("country"), F.col("r_name").alias("continent")
    )


@query(
    "c09_dim_product",
    """SELECT upper(md5(CAST(p_partkey AS VARCHAR))) AS product_key, p_name AS product_name, p_brand AS product_sku, p_type AS product_color, sub AS subcategory_name, n_name AS category_name
       FROM part LEFT JOIN (SELECT p_size AS k, min(p_type) AS sub, CASE WHEN p_size <= 25 THEN p_size END AS nk FROM part GROUP BY 1) ON k = p_size LEFT JOIN nation ON n_nationkey = nk""",
)
def c09_product(t):
    subcategories = t.part.groupBy(F.col("p_size").alias("product_subcategory_key")).agg(F.min("p_type").alias("subcategory_name")).withColumn(
        "product_category_key", F.when(F.col("product_subcategory_key") <= 25, F.col("product_subcategory_key"))
    )
    categories = t.nation.select(F.col("n_nationkey").alias("product_category_key"), F.col("n_name").alias("category_name"))
    return retail.dim_product(_products(t), subcategories, categories)


@query("c09_dim_country", "SELECT DISTINCT upper(md5(n_name)) AS country_key, n_name AS country, r_name AS continent FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def c09_country(t):
    served = _territories(t).join(t.customer.select(F.col("c_nationkey").alias("sales_territory_key")), "sales_territory_key")
    return retail.dim_country(served)


@query(
    "c09_fact_sale",
    """SELECT o_orderdate AS order_date, l_orderkey AS order_number, upper(md5(CAST(l_partkey AS VARCHAR))) AS product_key, upper(md5(n_name)) AS country_key,
         CAST(q * p AS DOUBLE) AS revenue, CAST(q * c AS DOUBLE) AS cost, CAST(q * p - q * c AS DOUBLE) AS profit FROM (
         SELECT o_orderdate, l_orderkey, l_partkey, n_name, CAST(l_quantity AS INTEGER) AS q, CAST(p_retailprice AS DECIMAL(12,2)) AS p, CAST(p_size AS DECIMAL(12,2)) AS c
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey LEFT JOIN part ON p_partkey = l_partkey)""",
)
def c09_sale(t):
    fact = retail.fact_sale(retail.stage_sales(_sales(t)), _products(t), _territories(t))
    return S.doubles(fact, "revenue", "cost", "profit")


# --- flights ---------------------------------------------------------------

@query(
    "c10_flight_positions",
    f"""WITH {TELEMETRY}
        SELECT flight_id, airline, round(km, 3) AS remaining_distance_km, round(distance_travelled_km / (distance_travelled_km + km) * 100, 5) AS completion_pct FROM (
          SELECT *, 2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a)) AS km FROM (
            SELECT *, pow(sin(radians(dest_lat - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(dest_lat)) * pow(sin(radians(dest_lon - longitude) / 2), 2) AS a FROM telemetry))""",
)
def c10_positions(t):
    reports = flights.flights(telemetry(t), columns=["flight_id", "airline", *flights.POSITION_INPUT])
    return flights.positions(reports).select(
        "flight_id", "airline", F.round("remaining_distance_km", 3).alias("remaining_distance_km"), F.round("completion_pct", 5).alias("completion_pct")
    )


@query(
    "c10_landed_flights",
    f"""WITH {TELEMETRY}
        SELECT flight_id, airline, 0.0::DOUBLE AS departure_delay_min, delay AS arrival_delay_min, CASE WHEN delay < 15 THEN 'on_time' WHEN delay < 30 THEN 'slightly_delayed' ELSE 'too_late' END AS delayed_status,
               CAST(CAST(arrival AS DATE) AS VARCHAR) AS flight_date
        FROM (SELECT *, CAST(date_diff('minute', scheduled, arrival) AS DOUBLE) AS delay FROM telemetry) WHERE flight_status = 'Landed'""",
)
def c10_landed(t):
    landed = flights.landings(flights.flights(telemetry(t), columns=flights.LANDED_COLUMNS))
    return S.day_texts(landed.select("flight_id", "airline", "departure_delay_min", "arrival_delay_min", "delayed_status", "flight_date"), "flight_date")


# --- contacts --------------------------------------------------------------

_EARLY = "ingested_at < TIMESTAMP '1999-01-01'"
_LATE = "ingested_at >= TIMESTAMP '1999-01-01'"


def _survivor_sql(name: str, condition: str) -> str:
    last = lambda c: f"arg_max({c}, (ingested_at, email, normalized_phone)) FILTER ({c} IS NOT NULL) AS {c}"
    return f"""{name} AS (SELECT contact_id, {last('first_name')}, {last('city')}, {last('brands')}, {last('parent_flag')},
      arg_max(gr_source, ingested_at) AS gr_source, arg_max(first_seen, ingested_at) AS first_seen,
      arg_max(CASE WHEN normalized_phone IS NOT NULL THEN sha256(normalized_phone) END, (ingested_at, email, normalized_phone)) FILTER (normalized_phone IS NOT NULL) AS phone_hashed
      FROM contact_rows WHERE {condition} GROUP BY 1)"""


def _survivors(t, late: bool):
    mark = F.lit(S.CUTOFF).cast("timestamp_ntz")
    rows = S.contact_rows(t).where(F.col("ingested_at") >= mark if late else F.col("ingested_at") < mark)
    parsed = contacts.vendor_contacts(rows, F.lit("2002-01-01").cast("date"), S.attribute_map(t))
    return contacts.survivors(materialise(parsed, work_path(t.spark, "parsed-contacts")))


_PICKED = ["contact_id", "email", "first_name", "city", "brands", "parent_flag", "gr_source", "first_seen", "phone_hashed"]


def _flat(df):
    return df.withColumns({k: F.try_element_at("source", F.lit(k)) for k in ("gr_source", "first_seen")})


@query(
    "c12_vendor_survivors",
    f"""WITH {S.CONTACT_ROWS}, {_survivor_sql('s', _LATE)}, emails AS (
          SELECT contact_id, string_agg(email, ',' ORDER BY seen DESC, email DESC) AS email FROM (
            SELECT contact_id, email, max(ingested_at) AS seen FROM contact_rows WHERE email IS NOT NULL AND {_LATE} GROUP BY 1, 2) GROUP BY 1)
        SELECT contact_id, e.email, first_name, city, brands, parent_flag, gr_source, first_seen, phone_hashed FROM s LEFT JOIN emails e USING (contact_id)""",
)
def c12_survivors(t):
    flat = _flat(_survivors(t, True))
    return flat.withColumn("email", F.array_join("email.values", ",")).select(*_PICKED)


@query(
    "c12_contact_merge",
    f"""WITH {S.CONTACT_ROWS}, {_ADDRESSES}, {_survivor_sql('o', _EARLY)}, {_survivor_sql('n', _LATE)},
        merged AS (
          SELECT contact_id, COALESCE(n.first_name, o.first_name) AS first_name, COALESCE(n.city, o.city) AS city,
            CASE WHEN n.brands IS NULL THEN o.brands WHEN o.brands IS NULL THEN n.brands
                 ELSE array_to_string(list_concat(string_split(o.brands, ','), list_filter(string_split(n.brands, ','), lambda x: NOT list_contains(string_split(o.brands, ','), x))), ',') END AS brands,
            COALESCE(n.parent_flag, o.parent_flag) AS parent_flag, COALESCE(o.gr_source, n.gr_source) AS gr_source, COALESCE(n.first_seen, o.first_seen) AS first_seen,
            COALESCE(n.phone_hashed, o.phone_hashed) AS phone_hashed
          FROM o FULL JOIN n USING (contact_id))
        SELECT contact_id, f.email, first_name, city, brands, parent_flag, gr_source, first_seen, phone_hashed FROM merged LEFT JOIN folded f USING (contact_id)""",
)
def c12_merge(t):
    now = _now()
    first = _survivors(t, False)
    stamps = {c: F.lit(None).cast("timestamp_ntz") for c in ("personalised_at", "created_at", "updated_at")}
    empty = first.where(F.lit(False)).withColumn("email", F.lit(None).cast("string")).withColumns(stamps)
    snapshot = contacts.merge_contacts(empty, first, now)
    merged = contacts.merge_contacts(materialise(snapshot, work_path(t.spark, "contacts")), _survivors(t, True), now)
    return _flat(merged).select(*_PICKED)


_CRM = """
crm AS (SELECT CAST(o_custkey AS VARCHAR) AS contact_id, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE o_orderstatus END AS phone,
  CASE WHEN o_orderstatus <> 'P' THEN 'c' || o_orderpriority || '@example.org' END AS email, o_orderstatus AS status, o_orderpriority AS priority, o_orderdate AS modified_at, o_orderkey AS object_id, o_orderdate >= TIMESTAMP '1999-01-01' AS late FROM orders)
"""


def _crm_side(name: str, late: str) -> str:
    return f"""{name} AS (SELECT contact_id, arg_max(phone, (modified_at, CAST(object_id AS VARCHAR))) AS phone, list_sort(list_distinct(flatten(list([priority, status])))) AS brands FROM crm WHERE {late} GROUP BY 1)"""


@query(
    "c11_crm_merge",
    f"""WITH {_CRM}, {_crm_side('o', 'NOT late')}, {_crm_side('n', 'late')},
        ids AS (SELECT contact_id, count(DISTINCT (email, object_id)) AS id_count, count(DISTINCT email) AS address_count FROM crm WHERE email IS NOT NULL GROUP BY 1),
        relations AS (SELECT contact_id, count(DISTINCT (priority, status)) AS relation_count FROM crm GROUP BY 1),
        valid AS (SELECT contact_id, count(*) FILTER (state = 'invalid') AS invalid_count FROM (
          SELECT contact_id, email, arg_max(CASE status WHEN 'F' THEN 'invalid' ELSE 'valid' END, (modified_at, CAST(object_id AS VARCHAR))) AS state FROM crm WHERE email IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
        SELECT contact_id, COALESCE(n.phone, o.phone) AS phone,
          array_to_string(list_concat(COALESCE(o.brands, []), list_filter(COALESCE(n.brands, []), lambda x: NOT list_contains(COALESCE(o.brands, []), x))), ',') AS brands,
          COALESCE(CAST(id_count AS INTEGER), 0) AS id_count, COALESCE(CAST(address_count AS INTEGER), 0) AS address_count, CAST(relation_count AS INTEGER) AS relation_count, COALESCE(CAST(invalid_count AS INTEGER), 0) AS invalid_count
        FROM o FULL JOIN n USING (contact_id) LEFT JOIN ids USING (contact_id) LEFT JOIN relations USING (contact_id) LEFT JOIN valid USING (contact_id)""",
)
def c11_merge(t):
    crm = materialise(contacts.crm_contacts(crm_raw(t)), work_path(t.spark, "crm"))
    late = F.col("modified_at") >= F.lit(S.CUTOFF).cast("timestamp_ntz")
    first, second = contacts.crm_survivors(crm.where(~late)), contacts.crm_survivors(crm.where(late))
    stamps = {c: F.lit(None).cast("timestamp_ntz") for c in ("personalised_at", "created_at", "updated_at")}
    merged = contacts.merge_crm(first.withColumns(stamps), second, _now())
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    ids = F.aggregate(F.coalesce(F.map_values("crm_ids"), F.array().cast("array<array<string>>")), F.lit(0), lambda n, l: n + F.size(l))
    invalid = F.size(F.filter(F.coalesce(F.map_values("validity"), F.array().cast("array<string>")), lambda v: v == "invalid"))
    return merged.select(
        "contact_id", "phone", "brands", ids.alias("id_count"), F.greatest(size(F.map_keys("crm_ids")), F.lit(0)).alias("address_count"),
        size("relations").alias("relation_count"), invalid.alias("invalid_count"),
    )


# --- messaging -------------------------------------------------------------

_MESSAGES = f"{S.MESSAGE_REPORT}, {S.SENDERS}, {S.UNSUBSCRIBES}, {_BRAND_COUNTS}, {BRAND_METRICS}"
_ATTRIBUTES = """
attributes AS (
  SELECT l.contact_id, l.bot_id, l.sender_id, l.template_id, CASE WHEN strpos(l.template_id, '_') > 0 THEN substr(l.template_id, strpos(l.template_id, '_') + 1) ELSE l.template_id END AS campaign_name,
         l.sent_at, l.delivered_at, l.read_at, l.replied_at, l.clicked_at, l.phone, b.brand_name, m.brand_metrics, u.opt_out_brands
  FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY ingested_at DESC, sent_at DESC, message_id DESC, report_id DESC, bot_id DESC, sender_id DESC, template_id DESC) AS rn FROM message_report) WHERE rn = 1) l
  LEFT JOIN (SELECT bot_id, min(brand_name) AS brand_name FROM senders GROUP BY 1) b ON b.bot_id = l.bot_id
  LEFT JOIN brand_metrics m ON m.contact_id = l.contact_id
  LEFT JOIN (SELECT contact_id, '{"optOut_brands": [' || string_agg(DISTINCT '"' || brand_name || '"', ', ' ORDER BY '"' || brand_name || '"') || ']}' AS opt_out_brands
             FROM unsubscribes JOIN senders USING (bot_id) WHERE user_request IS NOT NULL GROUP BY 1) u ON u.contact_id = l.contact_id)
"""


def _attributes(t):
    recent = F.col("ingested_at") >= F.lit("1990-01-01").cast("timestamp_ntz")
    return messaging.contact_attributes(S.message_report(t), S.unsubscribes(t), S.senders(t), recent)


@query("c13_contact_attributes", f"WITH {_MESSAGES}, {_ATTRIBUTES} SELECT * FROM attributes")
def c13(t):
    return _attributes(t)


@query(
    "c13_merge_attributes",
    f"""WITH {_MESSAGES}, {_ATTRIBUTES}
        SELECT COALESCE(a.contact_id, c_custkey) AS contact_id, a.bot_id, a.campaign_name, a.brand_metrics,
               CASE WHEN c_custkey IS NULL THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '1999-01-01' END AS created_at,
               CASE WHEN a.contact_id IS NULL THEN TIMESTAMP '1999-01-01' ELSE TIMESTAMP '{NOW}' END AS updated_at
        FROM (SELECT * FROM customer WHERE c_acctbal > 5000) FULL JOIN attributes a ON a.contact_id = c_custkey""",
)
def c13_merge(t):
    source = _attributes(t)
    known = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("contact_id"))
    others = {f.name: F.lit(None).cast(f.dataType) for f in source.schema.fields if f.name != "contact_id"}
    stamp = F.lit("1999-01-01").cast("timestamp_ntz")
    target = known.withColumns({**others, "created_at": stamp, "updated_at": stamp})
    merged = messaging.merge_attributes(target, source, _now())
    return merged.select("contact_id", "bot_id", "campaign_name", "brand_metrics", "created_at", "updated_at")


_NOTIFIED = """
notified AS (SELECT contact_id, report_id, message_id, status, brand_name, phone, CASE WHEN strpos(template_id, '_') > 0 THEN substr(template_id, strpos(template_id, '_') + 1) ELSE name END AS campaign_name FROM (
  SELECT r.*, b.brand_name, row_number() OVER (PARTITION BY contact_id, report_id, message_id ORDER BY ingested_at DESC, status DESC, r.bot_id DESC, sender_id DESC, template_id DESC) AS rn
  FROM message_report r LEFT JOIN (SELECT bot_id, min(brand_name) AS brand_name FROM senders GROUP BY 1) b ON b.bot_id = r.bot_id) WHERE rn = 1)
"""


def _notified(t):
    recent = F.col("ingested_at") >= F.lit("1990-01-01").cast("timestamp_ntz")
    return messaging.notifications(S.message_report(t), S.senders(t), recent)


@query(
    "c14_notifications",
    f"""WITH {S.MESSAGE_REPORT}, {S.SENDERS}, {_NOTIFIED} SELECT contact_id, report_id, message_id, status, campaign_name FROM notified""",
)
def c14(t):
    return _notified(t).select("contact_id", "report_id", "message_id", "status", "campaign_name")


@query(
    "c14_merge_notifications",
    f"""WITH {S.MESSAGE_REPORT}, {S.SENDERS}, {_NOTIFIED},
        known AS (SELECT o_custkey AS contact_id, o_orderkey AS report_id, 1 AS message_id FROM orders WHERE o_orderstatus = 'F')
        SELECT contact_id, report_id, message_id, n.status, CASE WHEN k.contact_id IS NOT NULL THEN 'old phone' ELSE n.phone END AS phone
        FROM (SELECT *, TRUE AS is_known FROM known) k FULL JOIN notified n USING (contact_id, report_id, message_id)""".replace("k.contact_id IS NOT NULL", "is_known"),
)
def c14_merge(t):
    source = _notified(t).select("contact_id", "report_id", "message_id", "status", "phone", "campaign_name")
    target = t.orders.where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("contact_id"), F.col("o_orderkey").alias("report_id"), F.lit(1).alias("message_id"), F.lit(None).cast("string").alias("status"),
        F.lit("old phone").alias("phone"), F.lit(None).cast("string").alias("campaign_name"), _now().alias("created_at"), _now().alias("updated_at"),
    )
    merged = messaging.merge_notifications(target, source, _now())
    return merged.select("contact_id", "report_id", "message_id", "status", "phone")


@query(
    "c15_activity_view",
    f"""WITH {_MESSAGES}, {_ATTRIBUTES}, {_NOTIFIED}
        SELECT n.contact_id, n.report_id, n.phone AS phone_number, a.bot_id AS wa_bot_id, a.campaign_name, a.opt_out_brands FROM notified n JOIN attributes a ON a.contact_id = n.contact_id""",
)
def c15(t):
    view = messaging.activity_view(_notified(t), _attributes(t))
    return view.select("contact_id", "report_id", "phone_number", "wa_bot_id", "campaign_name", "opt_out_brands")


# --- golden profile --------------------------------------------------------

def _profile_sources(t):
    """Four sources with different columns: customers, orders, order lines,
    events."""
    customers = t.customer.select(
        F.col("c_custkey").alias("contact_id"), F.col("c_name").alias("first_name"), F.lit("crm").alias("source_system"), F.col("c_mktsegment").alias("source_campaign"),
        F.lit("1994-01-01").cast("timestamp_ntz").alias("updated_at"), F.lit("1994-01-01").cast("timestamp_ntz").alias("created_at"),
    )
    orders = t.orders.select(
        F.col("o_custkey").alias("contact_id"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("city"), F.lit("shop").alias("source_system"),
        F.col("o_orderstatus").alias("brand_platform"), F.col("o_orderdate").alias("updated_at"), F.col("o_orderdate").alias("created_at"),
        F.create_map(F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("brand_frequency"),
    )
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("contact_id"), F.lit("vendor").alias("source_system"), F.col("l_linestatus").alias("brand_platform"),
        F.when(F.col("l_quantity") > 25, F.col("l_quantity").cast("int")).alias("age"), F.col("l_shipdate").alias("updated_at"), F.col("o_orderdate").alias("created_at"),
    )
    events = t.events.select(
        F.col("user_id").alias("contact_id"), F.lit("chat").alias("source_system"), F.col("event_type").alias("source_campaign"), F.lit("ON").alias("state"),
        F.col("ts").alias("updated_at"), F.col("ts").alias("created_at"),
    )
    columns = ["email", "phone", "first_name", "last_name", "city", "state", "gender", "pincode"]
    base = [df.withColumns({c: F.lit(None).cast("string") for c in columns if c not in df.columns}) for df in (customers, orders, lines, events)]
    return base


_PROFILE = """
sources AS (
  SELECT c_custkey AS contact_id, c_name AS first_name, NULL AS city, NULL AS state, CAST(NULL AS INTEGER) AS age, 'crm' AS source_system, c_mktsegment AS source_campaign, NULL AS brand_platform,
         TIMESTAMP '1994-01-01' AS updated_at, TIMESTAMP '1994-01-01' AS created_at FROM customer
  UNION ALL SELECT o_custkey, NULL, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END, NULL, NULL, 'shop', NULL, o_orderstatus, o_orderdate, o_orderdate FROM orders
  UNION ALL SELECT o_custkey, NULL, NULL, NULL, CASE WHEN l_quantity > 25 THEN CAST(l_quantity AS INTEGER) END, 'vendor', NULL, l_linestatus, l_shipdate, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT user_id, NULL, NULL, 'ON', NULL, 'chat', event_type, NULL, ts, ts FROM events)
"""


@query(
    "c16_golden_profile",
    f"""WITH {_PROFILE}
        SELECT contact_id, max(updated_at) AS updated_at, min(created_at) AS source_created_date, arg_max(first_name, (updated_at, created_at)) FILTER (first_name IS NOT NULL) AS first_name,
          max(state) AS state, string_agg(DISTINCT source_system, ',' ORDER BY source_system) AS source_system, string_agg(DISTINCT source_campaign, ',' ORDER BY source_campaign) AS source_campaign,
          string_agg(DISTINCT brand_platform, ',' ORDER BY brand_platform) AS brand_platform FROM sources GROUP BY 1""",
)
def c16(t):
    golden = profile.golden_profiles(_profile_sources(t))
    return golden.select("contact_id", "updated_at", "source_created_date", "first_name", "state", "source_system", "source_campaign", "brand_platform")


@query(
    "c16_merge_profiles",
    f"""WITH {_PROFILE}, s AS (
          SELECT contact_id, min(created_at) AS source_created_date, max(state) AS state, string_agg(DISTINCT source_system, ',' ORDER BY source_system) AS source_system,
                 string_agg(DISTINCT source_campaign, ',' ORDER BY source_campaign) AS source_campaign FROM sources GROUP BY 1),
        known AS (SELECT c_custkey AS contact_id, 'old' AS state, 'seed' AS source_system, c_mktsegment AS source_campaign FROM customer WHERE c_acctbal > 0)
        SELECT contact_id, s.source_created_date, COALESCE(s.state, k.state) AS state,
          CASE WHEN k.contact_id IS NULL THEN s.source_system WHEN s.contact_id IS NULL THEN k.source_system ELSE k.source_system || ',' || s.source_system END AS source_system
        FROM known k FULL JOIN s USING (contact_id)""".replace("k.contact_id IS NULL", "k.source_system IS NULL").replace("s.contact_id IS NULL", "s.source_system IS NULL"),
)
def c16_merge(t):
    golden = profile.golden_profiles(_profile_sources(t))
    known = t.customer.where("c_acctbal > 0").select(
        F.col("c_custkey").alias("contact_id"), F.lit("old").alias("state"), F.lit("seed").alias("source_system"), F.col("c_mktsegment").alias("source_campaign")
    )
    rest = {f.name: F.lit(None).cast(f.dataType) for f in golden.schema.fields if f.name not in known.columns}
    merged = profile.merge_profiles(known.withColumns(rest), golden, _now())
    return merged.select("contact_id", "source_created_date", "state", "source_system")


# --- files -----------------------------------------------------------------

SPEC = ingest.FileSpec(
    mapping={"Phone No": "phone", "E-Mail": "email", "City": "city", "Consent": "consent_timestamp", "Religion": "religion"},
    expected=["phone", "email", "city", "consent_timestamp"],
    reject_unexpected=True,
    static={"vendor": "sample"},
)


def vendor_rows(t):
    """Orders as vendor rows, one file per priority; 'nick_name' is surplus."""
    status, number = F.col("o_orderstatus"), F.col("o_custkey").cast("string")
    return t.orders.select(
        F.when(status == "F", F.concat(number, F.lit(".0"))).when(status == "O", "nan").alias("Phone No"),
        F.when(F.col("o_totalprice") > 150000, F.concat(F.lit("u"), number, F.lit("@example.org"))).alias("E-Mail"),
        F.col("o_orderpriority").alias("City"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("Consent"),
        F.when(F.col("o_totalprice") > 100000, F.md5("o_orderpriority")).alias("phone_hashed"),
        F.when(F.col("o_totalprice") > 450000, "nick").otherwise("").alias("nick_name"),
        F.concat(F.lower(F.regexp_replace("o_orderpriority", "[^A-Za-z0-9]", "")), F.lit(".csv")).alias("file_name"),
        F.col("o_orderkey").alias("row_id"),
    )


def loaded(t):
    people = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") > 3000, F.concat(F.lit("+91"), F.col("c_custkey").cast("string"))).alias("phone"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("u"), F.col("c_custkey").cast("string"), F.lit("@example.org"))).alias("email"),
    )
    from harborline.operators.identity import identity_table

    return ingest.load(
        vendor_rows(t), SPEC, identity_table(people, "phone", "phone", "id"), identity_table(people, "email", "email", "id"),
        execution_id="run-1", process_name="vendor files", target_table="raw_contacts", started=_now(), finished=_now(), spread_by=["row_id"],
    )


# "nick_name" is not among the received mapping, so it only counts as surplus
_CLASSIFIED = """
vendor AS (SELECT o_orderkey, o_orderpriority, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN '+91' || o_custkey END AS phone,
  CASE WHEN o_totalprice > 150000 THEN 'u' || o_custkey || '@example.org' END AS email, lower(regexp_replace(o_orderpriority, '[^A-Za-z0-9]', '', 'g')) || '.csv' AS file_name,
  strftime(o_orderdate, '%Y-%m-%d 00:00:00 UTC') AS consent FROM orders),
known AS (SELECT v.*, COALESCE(p.c_custkey, m.c_custkey) AS identity FROM vendor v
  LEFT JOIN customer p ON p.c_acctbal > 3000 AND v.phone = '+91' || p.c_custkey LEFT JOIN customer m ON m.c_mktsegment <> 'BUILDING' AND v.email = 'u' || m.c_custkey || '@example.org'),
classified AS (SELECT *, CASE WHEN o_totalprice > 450000 THEN 'error' WHEN identity IS NOT NULL THEN 'matched' WHEN phone IS NOT NULL OR email IS NOT NULL THEN 'error'
  WHEN o_totalprice > 100000 THEN 'hash_only' ELSE 'error' END AS outcome FROM known)
"""


@query(
    "c17_ingest_records",
    f"""WITH {_CLASSIFIED} SELECT identity, file_name, email AS normalized_email, phone AS normalized_phone, o_orderpriority AS city, CASE WHEN email IS NOT NULL THEN consent END AS email_ts,
          CASE WHEN phone IS NOT NULL THEN 'true' END AS sms, 'sample' AS vendor FROM classified WHERE outcome <> 'error'""",
)
def c17_records(t):
    records = once(loaded(t).records, {"p": as_map(F.col("payload"))})
    at = lambda key, name=None: F.try_element_at("p", F.lit(key)).alias(name or key)
    return records.select(
        "identity", "file_name", at("normalized_email"), at("normalized_phone"), at("city"), at("email_consent_status_ts", "email_ts"), at("sms_consent_status", "sms"), at("vendor")
    )


@query(
    "c17_ingest_errors",
    f"""WITH {_CLASSIFIED} SELECT CAST(identity AS VARCHAR) AS identity, email, file_name, 0 AS processed_flag, CASE WHEN o_totalprice > 450000 THEN 'Row contains unexpected columns with data: nick_name'
          WHEN phone IS NOT NULL AND email IS NOT NULL THEN 'Both phone ' || phone || ' and email ' || email || ' failed.'
          WHEN phone IS NOT NULL THEN 'Phone ' || phone || ' failed: no identity found.' WHEN email IS NOT NULL THEN 'Email ' || email || ' failed: no identity found.'
          ELSE 'No phone or email available for identity lookup.' END
          || CASE WHEN o_totalprice > 100000 AND o_totalprice <= 450000 THEN ' Record has hashed identifiers but phone/email lookup failed.' ELSE '' END AS error_detail
        FROM classified WHERE outcome = 'error'""",
)
def c17_errors(t):
    return loaded(t).errors.select("identity", "email", "file_name", "processed_flag", "error_detail")


@query(
    "c17_ingest_audit",
    f"""WITH {_CLASSIFIED} SELECT file_name AS source_detail, count(*) FILTER (outcome <> 'error') AS rows_processed, 'SUCCESS' AS process_status FROM classified GROUP BY 1""",
)
def c17_audit(t):
    return loaded(t).audit.select("source_detail", "rows_processed", "process_status")


@query(
    "c19_ack_admission",
    """SELECT source, lang || '_' || d.doc_id || '.v1.csv' AS file_name, CASE WHEN l.doc_id IS NOT NULL THEN 'admitted' ELSE 'held' END AS status
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def c19(t):
    stem = F.concat_ws("_", "lang", F.col("doc_id").cast("string"))
    return admission(_files(t, stem), ["source"])


def _files(t, stem):
    data = t.documents.select("source", F.concat(stem, F.lit(".v1.csv")).alias("file_name"))
    acks = t.documents.join(t.labels.select("doc_id"), "doc_id").select("source", F.concat(stem, F.lit(".v1_ack.csv")).alias("file_name"))
    hidden = t.documents.select("source", F.concat(F.lit("."), stem).alias("file_name"))
    return data.unionByName(acks).unionByName(hidden)


@query(
    "c19_recovered_files",
    """SELECT source, lang || '_' || d.doc_id || '.v1.csv' AS file_name FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE toxic = 1""",
)
def c19_recover(t):
    stem = F.concat_ws("_", "lang", F.col("doc_id").cast("string"))
    held = t.documents.select("source", F.concat(stem, F.lit(".v1.csv")).alias("file_name"))
    acks = t.documents.join(t.labels.where("toxic = 1").select("doc_id"), "doc_id").select("source", F.concat(stem, F.lit(".v1_ack.csv")).alias("file_name"))
    return recover(held, acks, ["source"])


@query(
    "c20_validation_cycle",
    """SELECT e.event_id, 'u' || user_id || '@example.org' AS email, CASE WHEN c_acctbal > 5000 THEN 'valid' WHEN length('u' || user_id || '@example.org') > 14 THEN 'catchall' ELSE 'unknown' END AS verdict
       FROM events e LEFT JOIN customer ON c_custkey = user_id""",
)
def c20(t):
    address = lambda c: F.concat(F.lit("u"), F.col(c).cast("string"), F.lit("@example.org")).alias("email")
    lookup = t.customer.where("c_acctbal > 5000").select(address("c_custkey"), F.lit("valid").alias("verdict"))
    score = lambda df: df.withColumn("verdict", F.when(F.length("email") > 14, "catchall").otherwise("unknown"))
    records, _ = validation_cycle(t.events.select("event_id", address("user_id")), lookup, "email", score)
    return records.select("event_id", "email", "verdict")


@query("c21_protect_columns", "SELECT c_custkey, sha256(c_name) AS c_name_hashed, c_mktsegment AS opened FROM customer")
def c21(t):
    from harborline.functions.security import decrypt

    key = F.lit("0123456789abcdef")  # sample key of the round trip, not a secret
    sealed = ingest.protect(t.customer, ["c_mktsegment"], ["c_name"], key)
    return sealed.select("c_custkey", "c_name_hashed", decrypt(F.col("c_mktsegment"), key).alias("opened"))


@query(
    "w02_vendor_newest_row",
    f"""WITH {S.CONTACT_ROWS} SELECT contact_id, email, first_name FROM (
          SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY ingested_at DESC, CASE WHEN normalized_phone IS NOT NULL THEN 1 ELSE 3 END, email DESC) AS rn FROM contact_rows) WHERE rn = 1""",
)
def w02_vendor(t):
    parsed = contacts.vendor_contacts(S.contact_rows(t), F.lit("2002-01-01").cast("date"), S.attribute_map(t))
    return contacts.newest_vendor_rows(parsed).select("contact_id", "email", "first_name")


@query(
    "c01_daily_status_report",
    f"""WITH {S.BRONZE_ORDERS}
        SELECT CAST(CAST(updated_at AS DATE) AS VARCHAR) AS day, order_status, count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS amount FROM latest_orders GROUP BY 1, 2""",
)
def daily_report(t):
    rows = latest_by_key(S.bronze_orders(t), ["order_id"], ["updated_at", "order_status"])
    result = rows.groupBy(F.to_date("updated_at").alias("day"), "order_status").agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("amount"))
    return S.day_texts(S.doubles(result, "amount"), "day")
