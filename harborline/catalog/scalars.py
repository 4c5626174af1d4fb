"""Text, date, hash and geo functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog import shapes as S
from harborline.catalog.projections import TELEMETRY, telemetry
from harborline.catalog.registry import query
from harborline.functions import dates, geo, security, text
from harborline.operators.conform import channel_consent
from harborline.streaming import flights


@query(
    "f01_plain_characters",
    r"""SELECT page_id, ltrim(regexp_replace(html, '[^A-Za-z0-9\s,.";:!?()_&%$#@]', '', 'g')) AS html FROM pages""",
)
def f01(t):
    return t.pages.select("page_id", text.keep_plain(F.col("html")).alias("html"))


@query(
    "f02_title_words",
    """SELECT p_partkey, upper(p_type) AS shout,
         array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), '-') || '#' || upper(p_type[1]) || lower(p_type[2:]) AS title FROM part""",
)
def f02(t):
    phrase = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("#"), "p_type")
    return t.part.select("p_partkey", F.upper("p_type").alias("shout"), text.title_words(phrase).alias("title"))


@query(
    "f03_blank_to_null",
    "SELECT conv_id, turn, NULLIF(trim(CASE WHEN role = 'system' THEN '  ' ELSE ' ' || role || ' ' END), '') AS role FROM conversations",
)
def f03(t):
    padded = F.when(F.col("role") == "system", "  ").otherwise(F.concat(F.lit(" "), "role", F.lit(" ")))
    return t.conversations.select("conv_id", "turn", text.blank_to_null(padded).alias("role"))


@query(
    "f04_first_filled",
    """SELECT event_id, COALESCE(CASE WHEN event_type = 'view' THEN NULL ELSE NULLIF(event_type, 'click') END, props) AS picked FROM events""",
)
def f04(t):
    first = F.when(F.col("event_type") == "click", " ").when(F.col("event_type") != "view", F.col("event_type"))
    return t.events.select("event_id", text.first_filled(first, F.col("props")).alias("picked"))


@query(
    "f05_after_first",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) ELSE o_orderpriority END AS own_fallback,
              CASE WHEN o_orderstatus = 'F' THEN substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) ELSE o_orderstatus END AS other_fallback FROM orders""",
)
def f05(t):
    template = F.when(F.col("o_orderstatus") == "F", F.replace("o_orderpriority", F.lit("-"), F.lit("_"))).otherwise(F.col("o_orderpriority"))
    rows = t.orders.select("o_orderkey", template.alias("template"), "o_orderstatus")
    return rows.select(
        "o_orderkey", text.after_first(F.col("template"), "_", F.col("template")).alias("own_fallback"),
        text.after_first(F.col("template"), "_", F.col("o_orderstatus")).alias("other_fallback"),
    )


@query(
    "f06_leading_tokens",
    "SELECT p_partkey, lower(replace(p_type, ' ', '_')) || '_' || lower(string_split(p_name, ' ')[1]) AS source_system FROM part",
)
def f06(t):
    long_name = F.concat_ws("_", "p_type", F.replace("p_name", F.lit(" "), F.lit("_")), "p_brand")
    return t.part.select("p_partkey", text.leading_tokens(long_name).alias("source_system"))


@query("f07_unquote_list", """SELECT doc_id, replace(replace(text, '"', ''), ';', ',') AS text FROM documents""")
def f07(t):
    return t.documents.select("doc_id", text.unquote_list(F.col("text")).alias("text"))


@query(
    "f08_email_or_phone",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'u' || o_custkey || '@example.org' END AS email,
              CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS VARCHAR) END AS phone FROM orders""",
)
def f08(t):
    identifier = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("u"), F.col("o_custkey").cast("string"), F.lit("@example.org"))).otherwise(
        F.col("o_custkey").cast("string")
    )
    email, phone = text.email_or_phone(identifier)
    return t.orders.select("o_orderkey", email.alias("email"), phone.alias("phone"))


@query(
    "f09_json_fragment",
    """SELECT c_custkey, '"' || c_name || '":{"segment":"' || c_mktsegment || '","nation":' || c_nationkey || '}' AS fragment FROM customer""",
)
def f09(t):
    from harborline.functions.documents import named_counts

    return t.customer.select("c_custkey", named_counts(F.col("c_name"), {"segment": F.col("c_mktsegment"), "nation": F.col("c_nationkey")}).alias("fragment"))


_PHONE = """CASE o_orderstatus WHEN 'F' THEN ' ' || o_custkey || '.0 ' WHEN 'O' THEN '+91' || o_custkey ELSE CASE WHEN o_orderpriority = '5-LOW' THEN 'NaN' ELSE 'unknown' END END"""


def _phone():
    number = F.col("o_custkey").cast("string")
    return (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), number, F.lit(".0 ")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("+91"), number))
        .when(F.col("o_orderpriority") == "5-LOW", "NaN").otherwise("unknown")
    )


@query(
    "f10_clean_phone",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS VARCHAR) WHEN 'O' THEN '+91' || o_custkey END AS phone FROM orders""",
)
def f10(t):
    return t.orders.select("o_orderkey", text.clean_phone(_phone()).alias("phone"))


@query(
    "f11_clean_email",
    """SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN lang || doc_id || '@example.org' END AS email FROM documents""",
)
def f11(t):
    raw = F.when(F.col("lang") == "de", " None ").when(F.col("lang") == "es", "").otherwise(F.concat(F.lit("  "), "lang", F.col("doc_id").cast("string"), F.lit("@example.org ")))
    return t.documents.select("doc_id", text.clean_email(raw).alias("email"))


@query(
    "f12_normalise_phone",
    """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F','O') THEN '+91' || o_custkey END AS prefixed, '+' || o_custkey AS plus FROM orders""",
)
def f12(t):
    many = F.concat(F.when(F.col("o_orderstatus") == "F", "++").otherwise(""), F.col("o_custkey").cast("string"))
    return t.orders.select(
        "o_orderkey", text.with_country_prefix(text.clean_phone(_phone())).alias("prefixed"), text.with_single_plus(many).alias("plus")
    )


@query(
    "f13_plain_mailbox",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE replace(c_name, '#', '') || lower(c_mktsegment) || '@mail.example.org' END AS email FROM customer""",
)
def f13(t):
    address = F.concat("c_name", F.lit("._"), F.lower("c_mktsegment"), F.lit("@mail.example.org"))
    raw = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(address)
    return t.customer.select("c_custkey", text.plain_mailbox(raw).alias("email"))


@query(
    "f14_hashed_identifier",
    """SELECT doc_id, CASE WHEN lang = 'en' THEN md5(text) WHEN lang = 'de' THEN NULL ELSE sha256(text) END AS hashed FROM documents""",
)
def f14(t):
    given = F.when(F.col("lang") == "en", F.md5("text")).otherwise(" ")
    normalised = F.when(F.col("lang") != "de", F.col("text"))
    return t.documents.select("doc_id", security.hashed_identifier(given, normalised).alias("hashed"))


@query("f15_md5_key", "SELECT p_partkey, upper(md5(CAST(p_partkey AS VARCHAR))) AS product_key FROM part")
def f15(t):
    return t.part.select("p_partkey", security.md5_key(F.col("p_partkey")).alias("product_key"))


@query(
    "f16_version_key",
    "SELECT o_orderkey, md5(o_custkey || '|' || CAST(o_orderdate AS DATE)) AS user_key, 1 AS one_key FROM orders",
)
def f16(t):
    day = F.to_date("o_orderdate")
    fast = security.fast_version_key(F.col("o_custkey"), day)
    return t.orders.select(
        "o_orderkey", security.version_key(F.col("o_custkey"), day).alias("user_key"), F.when(fast.isNotNull(), 1).alias("one_key")
    )


@query(
    "f17_encryption_round_trip",
    "SELECT c_custkey, c_name, TRUE AS hidden FROM customer",
)
def f17(t):
    key = F.lit("0123456789abcdef")  # sample key of the round trip, not a secret
    sealed = t.customer.select("c_custkey", security.encrypt(F.col("c_name"), key).alias("sealed"), "c_name")
    return sealed.select("c_custkey", security.decrypt(F.col("sealed"), key).alias("c_name"), (F.col("sealed") != F.col("c_name")).alias("hidden"))


@query(
    "f18_calendar_parts",
    """SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS VARCHAR)[:10] AS start_day_of_week, CAST(date_trunc('month', o_orderdate) AS VARCHAR)[:10] AS start_day_of_month,
         CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         dayname(o_orderdate) AS day_name, monthname(o_orderdate) AS month_name FROM orders""",
)
def f18(t):
    parts = t.orders.select("o_orderkey", *[c.alias(n) for n, c in dates.calendar_columns(F.to_date("o_orderdate")).items()])
    return S.day_texts(parts, "start_day_of_week", "start_day_of_month")


@query(
    "f19_hours_crossed",
    "SELECT event_id, date_diff('hour', ts, TIMESTAMP '2024-01-31 00:30:00') AS hours FROM events",
)
def f19(t):
    return t.events.select("event_id", dates.hours_crossed(F.col("ts"), F.lit("2024-01-31 00:30:00").cast("timestamp_ntz")).alias("hours"))


@query(
    "f20_five_minute_window",
    """SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end FROM events""",
)
def f20(t):
    start = dates.five_minute_floor(F.col("ts"))
    return t.events.select("event_id", start.alias("window_start"), (start + F.expr("INTERVAL 5 MINUTES")).alias("window_end"))


@query("f21_local_time", "SELECT event_id, ts + INTERVAL 7 HOUR AS local_ts FROM events")
def f21(t):
    return t.events.select("event_id", dates.local_time(F.col("ts"), "Asia/Jakarta").alias("local_ts"))


@query(
    "f22_layout_parsing",
    """SELECT o_orderkey, o_orderdate AS us_date, CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS eu_date FROM orders""",
)
def f22(t):
    us = F.date_format("o_orderdate", "MM/dd/yyyy")
    eu = F.when(F.col("o_orderstatus") == "P", "31/31/2020").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return t.orders.select(
        "o_orderkey", F.try_to_timestamp(us, F.lit("MM/dd/yyyy")).cast("timestamp_ntz").alias("us_date"),
        F.try_to_date(eu, "dd/MM/yyyy").cast("string").alias("eu_date"),
    )


_AT = "date_trunc('second', ts)"


@query(
    "f23_any_timestamp",
    f"""SELECT event_id, CASE event_type
           WHEN 'view' THEN strftime({_AT}, '%Y-%m-%d %H:%M:%S UTC') WHEN 'click' THEN strftime({_AT}, '%Y-%m-%d %H:%M:%S UTC')
           WHEN 'purchase' THEN strftime({_AT}, '%Y-%m-%d %H:%M:%S UTC') WHEN 'signup' THEN strftime(date_trunc('day', ts), '%Y-%m-%d 00:00:00 UTC')
           ELSE CASE WHEN value > 30 THEN strftime({_AT}, '%Y-%m-%d %H:%M:%S UTC') ELSE 'not a date' END END AS stamp FROM events""",
)
def f23(t):
    kind, ts = F.col("event_type"), F.col("ts")
    seconds = F.unix_timestamp(ts.cast("timestamp"))
    raw = (
        F.when(kind == "view", seconds.cast("string"))
        .when(kind == "click", (seconds * 1000 + 7).cast("string"))
        .when(kind == "purchase", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "signup", F.datediff(ts, F.lit("1899-12-30").cast("date")).cast("string"))
        .when(F.col("value") > 60, F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))
        .when(F.col("value") > 30, F.date_format(ts, "yyyy-MM-dd HH:mm:ss 'UTC'"))
        .otherwise(" not a date ")
    )
    return t.events.select("event_id", dates.utc_text(raw).alias("stamp"))


@query(
    "f24_age",
    """SELECT o_orderkey, CAST(CASE WHEN born <= DATE '2000-02-28' THEN 2000 - year(born) - CASE WHEN '0228' < strftime(born, '%m%d') THEN 1 ELSE 0 END
                WHEN birth_year BETWEEN 1900 AND 2000 THEN 2000 - birth_year END AS INTEGER) AS age
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS born, CAST(1890 + o_totalprice / 2500 AS INTEGER) AS birth_year FROM orders)""",
)
def f24(t):
    born = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    year = F.round(1890 + F.col("o_totalprice") / 2500).cast("int")
    return t.orders.select("o_orderkey", dates.age_years(born, year, F.lit("2000-02-28").cast("date")).alias("age"))


@query(
    "f25_delay_bands",
    f"""WITH {TELEMETRY}
        SELECT flight_id, airline, delay, CASE WHEN delay < 15 THEN 'on_time' WHEN delay < 30 THEN 'slightly_delayed' ELSE 'too_late' END AS band
        FROM (SELECT flight_id, airline, CAST(date_diff('minute', scheduled, arrival) AS DOUBLE) AS delay FROM telemetry)""",
)
def f25(t):
    time = lambda c: F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd HH:mm:ss"))
    delay = dates.minutes_between(time("scheduled_arrival_time"), time("actual_arrival_time"))
    return flights.flights(telemetry(t)).select("flight_id", "airline", delay.alias("delay"), dates.delay_band(delay).alias("band"))


@query(
    "f26_great_circle",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a)), 3) AS km FROM (
         SELECT *, pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2) AS a FROM (
           SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_suppkey % 90 AS DOUBLE) AS lat1, CAST(l_partkey % 180 AS DOUBLE) AS lon1, l_quantity - 25 AS lat2, l_discount * 100 AS lon2 FROM lineitem))""",
)
def f26(t):
    km = geo.great_circle_km(
        (F.col("l_suppkey") % 90).cast("double"), (F.col("l_partkey") % 180).cast("double"), F.col("l_quantity") - 25, F.col("l_discount") * 100
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(km, 3).alias("km"))


@query(
    "f27_completion",
    "SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity / nullif(l_quantity + l_discount * 100, 0) * 100, 6) AS pct FROM lineitem",
)
def f27(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(geo.completion_pct(F.col("l_quantity"), F.col("l_discount") * 100), 6).alias("pct")
    )


@query(
    "f28_profit",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(q * p AS DOUBLE) AS revenue, CAST(q * c AS DOUBLE) AS cost, CAST(q * p - q * c AS DOUBLE) AS profit FROM (
         SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS q, CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(p_retailprice AS DECIMAL(12,2)) AS c
         FROM lineitem JOIN part ON l_partkey = p_partkey)""",
)
def f28(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    quantity = F.col("l_quantity").cast("int")
    revenue, cost = quantity * S.money("l_extendedprice"), quantity * S.money("p_retailprice")
    rows = joined.select("l_orderkey", "l_linenumber", "l_partkey", revenue.alias("revenue"), cost.alias("cost"), (revenue - cost).alias("profit"))
    return S.doubles(rows, "revenue", "cost", "profit")


@query(
    "f29_channel_consent",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 150000 THEN 'true' END AS email_consent_status, CASE WHEN o_totalprice > 150000 THEN strftime(o_orderdate, '%Y-%m-%d') END AS email_consent_status_ts,
         CASE WHEN o_orderstatus = 'F' THEN 'true' END AS sms_consent_status, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS sms_consent_status_ts,
         CASE WHEN o_orderstatus = 'F' THEN 'true' END AS whatsapp_consent_status, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS whatsapp_consent_status_ts FROM orders""",
)
def f29(t):
    phone = F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", " ")
    email = F.when(F.col("o_totalprice") > 150000, "a@example.org")
    columns = channel_consent(phone, email, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in columns.items()])


@query(
    "f30_distinct_from",
    """SELECT event_id, CASE WHEN (CASE WHEN event_type = 'view' THEN NULL ELSE event_type END) IS DISTINCT FROM (CASE WHEN value > 30 THEN NULL ELSE 'click' END) THEN ts END AS bumped_at FROM events""",
)
def f30(t):
    left = F.nullif("event_type", F.lit("view"))
    right = F.when(F.col("value") > 30, None).otherwise("click")
    return t.events.select("event_id", F.when(~left.eqNullSafe(right), F.col("ts")).alias("bumped_at"))


@query(
    "f31_flags",
    "SELECT event_id, CASE event_type WHEN 'view' THEN TRUE WHEN 'click' THEN TRUE WHEN 'purchase' THEN FALSE WHEN 'signup' THEN FALSE END AS flag FROM events",
)
def f31(t):
    kind = F.col("event_type")
    word = F.when(kind == "view", "YES").when(kind == "click", "1").when(kind == "purchase", "No").when(kind == "signup", "false").otherwise("maybe")
    return t.events.select("event_id", text.to_flag(word).alias("flag"))


@query(
    "f32_safe_casts",
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, TRY_CAST(event_type AS BIGINT) AS nothing, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS d FROM events""",
)
def f32(t):
    k = F.get_json_object("props", "$.k")
    return t.events.select("event_id", k.try_cast("bigint").alias("k"), F.col("event_type").try_cast("bigint").alias("nothing"), k.try_cast("double").alias("d"))


@query(
    "f33_contains_flag",
    "SELECT doc_id, COALESCE(CASE WHEN lang = 'de' THEN NULL ELSE text END LIKE '%the%', FALSE) AS flag FROM documents",
)
def f33(t):
    return t.documents.select("doc_id", text.contains_flag(F.when(F.col("lang") != "de", F.col("text")), "the").alias("flag"))


@query("f34_ingestion_stamp", "SELECT event_id, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS stamped FROM events")
def f34(t):
    return t.events.select("event_id", F.date_format(dates.local_time(F.col("ts"), "Asia/Kolkata"), "yyyy-MM-dd HH:mm:ss").alias("stamped"))
