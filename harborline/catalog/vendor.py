"""Vendor contacts in full: orders as documents with every attribute, folded and merged."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.catalog import shapes as S
from harborline.catalog.registry import query
from harborline.operators.attributes import Addresses, Entries, Newest
from harborline.plans import vendor
from harborline.settings import work_path
from harborline.sinks.tables import materialise

AS_OF, NOW = "2002-01-01", "2002-01-01 00:00:00"

#: Document key -> SQL text that both engines read; k is the order, c the customer.
DOCUMENT = {
    "email": "CASE WHEN o_orderstatus <> 'P' THEN concat('user.', c, '+', lower(substr(o_orderpriority, 1, 1)), '@example.org') END",
    "normalized_email": "CASE WHEN o_orderstatus <> 'P' THEN concat('user', c, '@example.org') END",
    "email_hashed": "CASE WHEN k % 3 = 0 THEN concat('eh', c, 'x', k % 2) END",
    "phone": "CASE WHEN o_orderstatus <> 'O' THEN concat('0', c) END",
    "normalized_phone": "CASE WHEN k % 4 <> 0 THEN concat('+91', c) END",
    "first_name": "CASE WHEN o_orderstatus = 'F' THEN concat('Name', c) END",
    "last_name": "CASE WHEN k % 4 = 0 THEN concat('Last', k % 7) ELSE ' ' END",
    "google_advertiser_id__gaid_": "CASE WHEN k % 5 = 0 THEN concat('g', k) END",
    "apple_id_for_advertisers__idfa_": "CASE WHEN k % 6 = 0 THEN concat('i', k) END",
    "date_of_birth": "CASE WHEN k % 3 = 1 THEN concat(1950 + k % 50, '-03-15') END",
    "birth_year": "CASE WHEN k % 3 = 2 THEN concat('', 1950 + k % 50) END",
    "zip": "CASE WHEN k % 7 = 0 THEN concat('', 100000 + k % 1000) END",
    "gender": "CASE k % 4 WHEN 1 THEN 'male' WHEN 2 THEN 'female' ELSE ' ' END",
    "town": "CASE WHEN o_totalprice > 400000 THEN o_orderpriority END",
    "state": "CASE WHEN k % 9 = 0 THEN concat('S', k % 10) END",
    "gr_source": "concat('', year(o_orderdate))",
    "first_seen": "CASE WHEN k % 2 = 0 THEN concat('seen', k % 11) END",
    "fav_brand": "CASE WHEN o_totalprice > 100000 THEN concat(o_orderpriority, ';junk') END",
    "brand_one": "o_orderpriority", "brand_two": "'unknown'",
    "is_parent": "CASE WHEN o_totalprice > 250000 THEN 'yes' WHEN o_totalprice > 50000 THEN 'no' END",
    "liked_recipes": "CASE WHEN k % 3 = 0 THEN concat(c % 30, ',', k % 25) END",
    "dessert_mood": "CASE WHEN k % 5 = 1 THEN concat('mood', k % 3) END",
    "scanned": "CASE WHEN k % 6 = 1 THEN 'true' WHEN k % 6 = 2 THEN 'maybe' END",
    "packtype": "CASE WHEN k % 8 = 0 THEN concat('pack', k % 3) END",
    "how_often_do_you_consume_chocolates_": "CASE WHEN k % 4 = 3 THEN o_orderpriority END",
    "date_night": "CASE WHEN k % 2 = 0 THEN concat('night', k % 3) END",
    "gift": "CASE WHEN k % 5 = 0 THEN 'rose' END",
    "team": "CASE WHEN k % 3 = 0 THEN concat('team', k % 4) END",
    "biscuit_consumption_flag": "CASE k % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN '0' END",
    "mithai": "CASE k % 7 WHEN 0 THEN '1' WHEN 1 THEN 'no' END",
    "candy": "CASE k % 11 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END",
    "coupon": "CASE k % 13 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END",
}
GROUPED = {
    "city": ["city_name", "town"], "source": ["gr_source", "first_seen"], "brand_preference": ["fav_brand"], "brand_frequency": ["brand_one", "brand_two"],
    "parent_flag": ["is_parent"], "dessert": ["liked_recipes", "dessert_mood"], "scan_code": ["scanned"], "romance": ["date_night", "gift"],
    "sports": ["team"], "mithai": ["mithai"], "candies": ["candy"], "coupon": ["coupon"],
}

_FLAG = "CASE WHEN lower({0}) IN ('true', '1', 'yes') THEN TRUE WHEN lower({0}) IN ('false', '0', 'no') THEN FALSE END"
_ANY = "CASE WHEN {0} IS NOT NULL THEN coalesce(lower({0}) IN ('true', '1', 'yes'), FALSE) END"
#: Column (of a map: column.key) -> SQL over the document's keys.
PARSED = {
    "email": "email", "email_normalized": "normalized_email",
    "email_hashed": "coalesce(email_hashed, sha256(normalized_email))",
    "first_name": "first_name", "last_name": "nullif(trim(last_name), '')", "phone": "phone",
    "phone_number_normalized": "CASE WHEN phone IS NOT NULL THEN normalized_phone END", "phone_number_hashed": "sha256(normalized_phone)",
    "gaid": "google_advertiser_id__gaid_", "idfa": "apple_id_for_advertisers__idfa_", "birthday": "date_of_birth", "pincode": "zip",
    "gender": "nullif(trim(gender), '')", "city": "town", "state": "state", "source.gr_source": "gr_source", "source.first_seen": "first_seen",
    "consumption_brand_preference": "CASE WHEN fav_brand IS NOT NULL THEN o_orderpriority END",
    "parent_flag": _ANY.format("is_parent"), "dessert_preference.liked_recipes": "CASE WHEN liked_recipes IS NOT NULL THEN concat(coalesce(r.n_name, concat('', c % 30)), ',', coalesce(s.n_name, concat('', k % 25))) END",
    "dessert_preference.dessert_mood": "dessert_mood", "scan_code_flag": _ANY.format("scanned"), "packscan_packtype": "packtype",
    "chocolate_consumption": "CASE WHEN how_often_do_you_consume_chocolates_ IS NOT NULL THEN concat('level ', substr(o_orderpriority, 1, 1)) END",
    "romance.date_night": "date_night", "romance.gift": "gift", "sports.team": "team", "biscuit_consumption_flag": _FLAG.format("biscuit_consumption_flag"),
    "mithai_consumption_flag": _ANY.format("mithai"), "candies_consumption_flag": _ANY.format("candy"),
    "age": "CAST(CASE WHEN date_of_birth IS NOT NULL THEN 2001 - CAST(substr(date_of_birth, 1, 4) AS INTEGER) ELSE 2002 - CAST(birth_year AS INTEGER) END AS INTEGER)", "coupon_flag": _ANY.format("coupon"),
}
_NAME = {name: name.replace(".", "_") for name in PARSED}

_ROWS = f"""
docs AS (SELECT *, {', '.join(f'{sql} AS {key}' for key, sql in DOCUMENT.items())} FROM (SELECT *, o_orderkey AS k, o_custkey AS c FROM orders)),
vendor_rows AS (
  SELECT CAST(c AS VARCHAR) AS contact_id, o_orderdate + to_seconds((k * 37) % 86400) AS ingested_at, k AS row_id, o_orderpriority AS brand,
    {', '.join(f'{sql} AS {_NAME[name]}' for name, sql in PARSED.items() if sql != _NAME[name])}, {', '.join(n for n in _NAME.values() if PARSED.get(n) == n)}
  FROM docs LEFT JOIN nation r ON r.n_nationkey = c % 30 LEFT JOIN nation s ON s.n_nationkey = k % 25)
"""
_ADDRESS = [c for c, rule in vendor.COLUMNS.items() if isinstance(rule, Addresses)]


def _side(name: str, condition: str) -> str:
    """Newest values of every column; maps as one column a key, brands as a sorted list."""
    plain = [n for n in _NAME.values() if n not in _ADDRESS]
    newest = ", ".join(f"arg_max({n}, (ingested_at, row_id)) FILTER ({n} IS NOT NULL) AS {n}" for n in plain)
    return f"{name} AS (SELECT contact_id, {newest}, list_sort(list(DISTINCT brand)) AS brands FROM vendor_rows WHERE {condition} GROUP BY 1)"


def _map_sql(*names: str) -> str:
    entries = ", ".join(f"CASE WHEN {n} IS NOT NULL THEN concat('{n.split('_', k)[k]}=', {n}) END" for n, k in names)
    return f"nullif(concat_ws(';', {entries}), '')"


_MAPS = {
    "source": _map_sql(("source_first_seen", 1), ("source_gr_source", 1)),
    "brand_consumption_frequency": "array_to_string(list_transform(brands, lambda b: concat(b, '=kind ', substr(b, 3))), ';')",
    "dessert_preference": _map_sql(("dessert_preference_dessert_mood", 2), ("dessert_preference_liked_recipes", 2)),
    "romance": _map_sql(("romance_date_night", 1), ("romance_gift", 1)),
    "sports": _map_sql(("sports_team", 1)),
}


def _shown_sql(addresses: dict[str, str]) -> str:
    return ", ".join(f"{addresses.get(c) or _MAPS.get(c) or c} AS {c}" for c in vendor.COLUMNS)


def _shown(df, *more: str):
    """All columns, maps as text."""
    def shown(name, rule):
        entries = F.transform(F.array_sort(F.map_entries(name)), lambda e: F.concat(e["key"], F.lit("="), e["value"])) if isinstance(rule, Entries) else None
        if isinstance(rule, Entries):
            return F.nullif(F.array_join(entries, ";"), F.lit("")).alias(name)
        return F.col(name).cast("string").alias(name) if rule == Newest("date") else F.col(name)

    return df.select("contact_id", *[shown(c, rule) for c, rule in vendor.COLUMNS.items()], *more)


def documents(t):
    """Orders as vendor records: one JSON document each, null keys left out.

    The rows of a customer are brought together while they are small: parsing gets as many tasks as the rows need,
    however few files there are, and the fold combines most of a customer's rows before its shuffle.
    """
    o = t.orders.hint("rebalance", F.col("o_custkey")).withColumns({"k": F.col("o_orderkey"), "c": F.col("o_custkey")})
    document = F.to_json(F.struct(*[F.expr(sql).alias(key) for key, sql in DOCUMENT.items()]))
    return o.select(F.col("c").cast("string").alias("contact_id"), document.alias("document"), S.plus_seconds("o_orderdate", F.col("k") * 37 % 86400).alias("ingested_at"), F.col("k").alias("row_id"))


def parsed(t):
    """The documents with all attributes, written once: both sides of a merge start from it."""
    pairs = [F.struct(F.lit(g).alias("attribute_group"), F.lit(key).alias("attribute_name")) for g, keys in GROUPED.items() for key in keys]
    attribute_map = t.region.agg(F.count(F.lit(1))).select(F.inline(F.array(*pairs))).withColumn("hmz_object", F.lit("contact"))
    names = t.orders.select("o_orderpriority").distinct()
    brands = names.select(F.col("o_orderpriority").alias("brand"), F.expr("concat('kind ', substr(o_orderpriority, 3))").alias("category"))
    frequencies = names.select(F.col("o_orderpriority").alias("frequency"), F.expr("concat('level ', substr(o_orderpriority, 1, 1))").alias("category"))
    recipes = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    rows = vendor.parse(documents(t), F.lit(AS_OF).cast("date"), attribute_map, brands, recipes, frequencies)
    return materialise(rows, work_path(t.spark, "vendor-rows"))


def _seen_sql(column: str) -> str:
    return f"""seen_{column} AS (SELECT contact_id, string_agg({column}, ',' ORDER BY seen DESC, {column} DESC) AS list_{column} FROM (
      SELECT contact_id, {column}, max(ingested_at) AS seen FROM vendor_rows WHERE {column} IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"""


def _folded_sql(column: str) -> str:
    """The labelled history of one address column after two batches, cut at the stored snapshot."""
    batch = lambda sign: f"SELECT contact_id, {column} AS a, max(ingested_at) AS seen FROM vendor_rows WHERE {column} IS NOT NULL AND ingested_at {sign} TIMESTAMP '{S.CUTOFF}' GROUP BY 1, 2"
    return f"""known_{column} AS ({batch('<')}), fresh_{column} AS ({batch('>=')}),
    folded_{column} AS (SELECT contact_id, '{{' || string_agg('"' || CASE rn WHEN 1 THEN 'Primary' WHEN 2 THEN 'Secondary' WHEN 3 THEN 'Tertiary' ELSE 'Email_' || rn END || '":"' || a || '"', ',' ORDER BY rn) || '}}' AS list_{column}
      FROM (SELECT contact_id, a, row_number() OVER (PARTITION BY contact_id ORDER BY grp, seen DESC, a DESC) AS rn FROM (
        SELECT 0 AS grp, f.* FROM fresh_{column} f ANTI JOIN known_{column} n ON f.contact_id = n.contact_id AND f.a = n.a UNION ALL SELECT 1, * FROM known_{column})) GROUP BY 1)"""


_LISTS = {c: f"list_{c}" for c in _ADDRESS}


@query(
    "c12_vendor_columns",
    f"WITH {_ROWS}, {_side('s', 'TRUE')}, {', '.join(map(_seen_sql, _ADDRESS))} SELECT contact_id, {_shown_sql(_LISTS)} FROM s "
    + " ".join(f"LEFT JOIN seen_{c} USING (contact_id)" for c in _ADDRESS),
)
def c12_columns(t):
    """All 30 attributes of every contact over all its records."""
    folded = vendor.survivors(parsed(t))
    return _shown(folded.withColumns({c: F.array_join(f"{c}.values", ",") for c in _ADDRESS}))


def _merged_sql() -> str:
    plain = [n for n in _NAME.values() if n not in _ADDRESS and n != "consumption_brand_preference"]
    union = """CASE WHEN n.consumption_brand_preference IS NULL OR n.consumption_brand_preference = o.consumption_brand_preference THEN o.consumption_brand_preference
      WHEN o.consumption_brand_preference IS NULL THEN n.consumption_brand_preference ELSE o.consumption_brand_preference || ',' || n.consumption_brand_preference END AS consumption_brand_preference"""
    return f"""merged AS (SELECT contact_id, {', '.join(f'coalesce(n.{c}, o.{c}) AS {c}' for c in plain)}, {union},
      list_sort(list_distinct(list_concat(coalesce(o.brands, []), coalesce(n.brands, [])))) AS brands FROM o FULL JOIN n USING (contact_id))"""


@query(
    "c12_vendor_merge",
    f"""WITH {_ROWS}, {_side('o', f"ingested_at < TIMESTAMP '{S.CUTOFF}'")}, {_side('n', f"ingested_at >= TIMESTAMP '{S.CUTOFF}'")}, {_merged_sql()}, {', '.join(map(_folded_sql, _ADDRESS))}
    SELECT contact_id, {_shown_sql(_LISTS)}, TIMESTAMP '{NOW}' AS created_at, TIMESTAMP '{NOW}' AS updated_at FROM merged """
    + " ".join(f"LEFT JOIN folded_{c} USING (contact_id)" for c in _ADDRESS),
)
def c12_merge_columns(t):
    """A stored snapshot of the early records, then the late ones merged into it, every column by its rule."""
    rows, now = parsed(t), F.lit(NOW).cast("timestamp_ntz")
    late = F.col("ingested_at") >= F.lit(S.CUTOFF).cast("timestamp_ntz")
    # a merge looks at its change set twice, so each is folded once and stored
    early, fresh = (materialise(vendor.survivors(rows.where(part)), work_path(t.spark, "vendor-survivors")) for part in (~late, late))
    snapshot = materialise(vendor.merge(None, early, now), work_path(t.spark, "vendor-contacts"))
    return _shown(vendor.merge(snapshot, fresh, now), "created_at", "updated_at")
