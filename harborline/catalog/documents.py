"""JSON document, list and address functions over whole tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from harborline.catalog import shapes as S
from harborline.catalog.registry import query
from harborline.functions import dates
from harborline.functions import documents as D
from harborline.operators.latest import latest_values, merged_documents
from harborline.operators.once import once
from harborline.operators.scoring import score_rows
from harborline.plans import contacts

CUT = f"TIMESTAMP '{S.CUTOFF}'"


def _keys(*names: str) -> Column:
    return F.array(*map(F.lit, names))


def _attributes(t):
    return once(S.contact_rows(t), {"a": D.as_map(F.col("document"))})


_ADDRESSES = f"""
addresses AS (SELECT contact_id, email, ingested_at FROM contact_rows WHERE email IS NOT NULL),
known AS (SELECT contact_id, email, max(ingested_at) AS seen FROM addresses WHERE ingested_at < {CUT} GROUP BY 1, 2),
fresh AS (SELECT contact_id, email, max(ingested_at) AS seen FROM addresses WHERE ingested_at >= {CUT} GROUP BY 1, 2),
ranked AS (SELECT contact_id, email, row_number() OVER (PARTITION BY contact_id ORDER BY grp, seen DESC, email DESC) AS rn FROM (
  SELECT 0 AS grp, f.* FROM fresh f ANTI JOIN known k ON f.contact_id = k.contact_id AND f.email = k.email
  UNION ALL SELECT 1, * FROM known)),
folded AS (
  SELECT contact_id, '{{' || string_agg('"' || CASE rn WHEN 1 THEN 'Primary' WHEN 2 THEN 'Secondary' WHEN 3 THEN 'Tertiary' ELSE 'Email_' || rn END || '":"' || email || '"', ',' ORDER BY rn) || '}}' AS email
  FROM ranked GROUP BY 1)
"""


def _batches(t):
    """Per contact the addresses before and after the cutoff, newest first."""
    rows = _attributes(t).select("contact_id", F.try_element_at("a", F.lit("email")).alias("email"), "ingested_at")
    late = F.col("ingested_at") >= F.lit(S.CUTOFF).cast("timestamp_ntz")
    once = rows.where(F.col("email").isNotNull()).groupBy("contact_id", late.alias("late"), "email").agg(F.max("ingested_at").alias("at"))
    newest = once.groupBy("contact_id").agg(
        *[F.sort_array(F.collect_list(F.when(F.col("late") == flag, F.struct("at", "email"))), asc=False).alias(name) for name, flag in (("old", False), ("new", True))]
    )
    split = lambda c: (F.transform(c, lambda p: p["email"]), F.transform(c, lambda p: p["at"].cast("string")))
    return newest, split


@query("u01_email_fold", f"WITH {S.CONTACT_ROWS}, {_ADDRESSES} SELECT contact_id, email FROM folded")
def u01(t):
    newest, split = _batches(t)
    known = once(newest, {"known": D.fold_addresses(F.lit(None).cast("string"), *split(F.col("old")))})
    return known.select("contact_id", D.fold_addresses(F.col("known"), *split(F.col("new"))).alias("email"))


@query(
    "u02_pick_attributes",
    f"""WITH {S.CONTACT_ROWS}
        SELECT row_id, '{{' || COALESCE('"email":"' || email || '",', '') || '"gr_source":"' || gr_source || '","row":"' || row_id || '"}}' AS picked FROM contact_rows""",
)
def u02(t):
    picked = D.pick(F.col("a"), _keys("email", "gr_source", "absent"), {"row": F.col("row_id").cast("string"), "none": F.lit(None).cast("string")})
    return _attributes(t).select("row_id", D.as_json(picked).alias("picked"))


_FIELDS = {"email": "email", "normalized_phone": "normalized_phone", "first_name": "first_name", "gr_source": "gr_source"}
_NEWEST = ", ".join(f"arg_max({c}, ingested_at) FILTER ({c} IS NOT NULL) AS {c}" for c in _FIELDS)


def _fields(document: str, *names: str):
    return [F.try_element_at(document, F.lit(n)).alias(n) for n in names or _FIELDS]


@query("u03_fold_documents", f"WITH {S.CONTACT_ROWS} SELECT contact_id, {_NEWEST} FROM contact_rows GROUP BY 1")
def u03(t):
    folded = merged_documents(_attributes(t), ["contact_id"], "a", ["ingested_at"])
    return folded.select("contact_id", *_fields("a"))


@query(
    "u03_first_non_null_array",
    f"""WITH {S.CONTACT_ROWS} SELECT row_id, COALESCE(first_name, 'nobody') AS first_name, COALESCE(email, 'none') AS email FROM contact_rows""",
)
def u03_array(t):
    defaults = F.create_map(F.lit("first_name"), F.lit("nobody"), F.lit("email"), F.lit("none"))
    merged = D.first_non_null(F.array(F.col("a"), F.lit(None).cast("map<string,string>"), defaults))
    return _attributes(t).withColumn("m", merged).select("row_id", *_fields("m", "first_name", "email"))


_OLD_NEW = f"""
old_doc AS (SELECT contact_id, {_NEWEST} FROM contact_rows WHERE ingested_at < {CUT} GROUP BY 1),
new_doc AS (SELECT contact_id, {_NEWEST} FROM contact_rows WHERE ingested_at >= {CUT} GROUP BY 1)
"""


def _old_new(t):
    """Merged documents before and after the cutoff, side by side."""
    late = F.col("ingested_at") >= F.lit(S.CUTOFF).cast("timestamp_ntz")
    rows = _attributes(t).withColumn("late", late)
    both = merged_documents(rows, ["contact_id", "late"], "a", ["ingested_at"])
    return both.groupBy("contact_id").agg(
        F.any_value(F.when(~F.col("late"), F.col("a")), ignoreNulls=True).alias("old"),
        F.any_value(F.when(F.col("late"), F.col("a")), ignoreNulls=True).alias("new"),
    )


def _either(order: str) -> str:
    a, b = ("n", "o") if order == "new" else ("o", "n")
    return ", ".join(f"COALESCE({a}.{c}, {b}.{c}) AS {c}" for c in ("email", "normalized_phone", "first_name"))


@query(
    "u04_prefer_source",
    f"""WITH {S.CONTACT_ROWS}, {_OLD_NEW}
        SELECT contact_id, {_either("new")}, COALESCE(n.gr_source, o.gr_source) AS gr_source FROM old_doc o FULL JOIN new_doc n USING (contact_id)""",
)
def u04(t):
    return _old_new(t).withColumn("m", D.prefer_source(F.col("old"), F.col("new"))).select("contact_id", *_fields("m"))


@query(
    "u05_keep_fixed_keys",
    f"""WITH {S.CONTACT_ROWS}, {_OLD_NEW}
        SELECT contact_id, {_either("new")}, COALESCE(o.gr_source, n.gr_source) AS gr_source FROM old_doc o FULL JOIN new_doc n USING (contact_id)""",
)
def u05(t):
    merged = D.prefer_source_except(F.col("old"), F.col("new"), ["gr_source"])
    return _old_new(t).withColumn("m", merged).select("contact_id", *_fields("m"))


@query(
    "u06_union_lists",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = l_linestatus THEN l_returnflag ELSE l_returnflag || ',' || l_linestatus END
         || CASE WHEN l_returnflag = 'X' OR l_linestatus = 'X' THEN '' ELSE ',X' END AS merged FROM lineitem""",
)
def u06(t):
    source = F.concat(F.lit(" X , ,"), "l_linestatus")
    target = F.concat_ws(",", "l_returnflag", "l_linestatus")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", D.union_lists(target, source).alias("merged"))


@query(
    "u07_union_list_array",
    """SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) || ',all' AS types FROM events GROUP BY 1""",
)
def u07(t):
    once = t.events.select("user_id", "event_type").distinct().groupBy("user_id").agg(F.array_sort(F.collect_list("event_type")).alias("l"))
    lists = F.concat(F.transform("l", lambda v: F.concat(v, F.lit(","), v)), F.array(F.lit("all, all"), F.lit(None)))
    return once.select("user_id", D.union_list_array(lists).alias("types"))


@query(
    "u09_documents_across_sources",
    """SELECT user_id, arg_max(k, (origin, ts, event_id)) AS k, max(CASE WHEN origin = 1 THEN 'event' END) AS seen FROM (
         SELECT user_id, 1 AS origin, ts, event_id, json_extract_string(props, '$.k') AS k FROM events
         UNION ALL SELECT o_custkey, 2, o_orderdate, o_orderkey, o_orderstatus FROM orders) GROUP BY 1""",
)
def u09(t):
    events = t.events.select("user_id", F.lit(1).alias("origin"), "ts", F.col("event_id").alias("seq"), F.map_concat(D.as_map(F.col("props")), F.create_map(F.lit("seen"), F.lit("event"))).alias("d"))
    orders = t.orders.select(F.col("o_custkey").alias("user_id"), F.lit(2).alias("origin"), F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("seq"), F.create_map(F.lit("k"), F.col("o_orderstatus")).alias("d"))
    return merged_documents(events.unionByName(orders), ["user_id"], "d", ["origin", "ts", "seq"]).select("user_id", *_fields("d", "k", "seen"))


@query("u10_filled_or", "SELECT event_id, CASE WHEN event_type = 'view' THEN props ELSE event_type END AS v FROM events")
def u10(t):
    source = F.when(F.col("event_type") == "view", " ").otherwise(F.col("event_type"))
    return t.events.select("event_id", D.filled_or(source, F.col("props")).alias("v"))


@query(
    "u11_first_value",
    f"WITH {S.CONTACT_ROWS} SELECT row_id, COALESCE(city, first_name, gr_source) AS picked FROM contact_rows",
)
def u11(t):
    return _attributes(t).select("row_id", D.first_value(F.col("a"), _keys("city_name", "first_name", "gr_source")).alias("picked"))


@query(
    "u12_any_flag",
    f"WITH {S.CONTACT_ROWS} SELECT row_id, parent_flag FROM contact_rows",
)
def u12(t):
    return _attributes(t).select("row_id", D.any_flag(F.col("a"), _keys("is_parent", "has_child")).alias("parent_flag"))


@query(
    "u13_flag_at",
    f"WITH {S.CONTACT_ROWS} SELECT row_id, parent_flag, CAST(NULL AS BOOLEAN) AS no_flag FROM contact_rows",
)
def u13(t):
    return _attributes(t).select("row_id", D.flag_at(F.col("a"), "is_parent").alias("parent_flag"), D.flag_at(F.col("a"), "gr_source").alias("no_flag"))


@query(
    "u14_listed_values",
    f"""WITH {S.CONTACT_ROWS}
        SELECT row_id, CASE WHEN brands IS NULL THEN gr_source ELSE brands || ',' || gr_source END AS everything,
               CASE WHEN brands LIKE '%,F' THEN 'F' END AS allowed FROM contact_rows""",
)
def u14(t):
    keys = _keys("brands", "gr_source")
    return _attributes(t).select(
        "row_id", D.listed_values(F.col("a"), keys, F.array().cast("array<string>")).alias("everything"),
        D.listed_values(F.col("a"), keys, _keys("F", "Z")).alias("allowed"),
    )


_LOOKUP = {"1-URGENT": "high", "2-HIGH": "high", "3-MEDIUM": "mid"}


def _lookup() -> Column:
    return F.create_map(*[F.lit(x) for pair in _LOOKUP.items() for x in pair])


_CATEGORY = "CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'mid' END"


def _brand_documents(t):
    document = F.to_json(F.struct(F.col("o_orderpriority").alias("brand"), F.col("o_orderstatus").alias("other"), F.lit("1-URGENT").alias("unlisted")))
    return t.orders.select("o_orderkey", D.as_map(document).alias("a"))


@query(
    "u15_brand_values",
    f"SELECT o_orderkey, CASE WHEN {_CATEGORY} IS NULL THEN '{{}}' ELSE '{{\"' || o_orderpriority || '\":\"' || {_CATEGORY} || '\"}}' END AS brands FROM orders",
)
def u15(t):
    return _brand_documents(t).select("o_orderkey", D.as_json(D.brand_values(F.col("a"), _keys("brand", "other"), _lookup())).alias("brands"))


@query(
    "u16_translate_list",
    f"SELECT o_orderkey, COALESCE({_CATEGORY}, o_orderpriority) || ',' || o_orderstatus AS liked, o_orderpriority AS kept FROM orders",
)
def u16(t):
    document = F.to_json(F.struct(F.concat_ws("; ", "o_orderpriority", "o_orderstatus").alias("liked"), F.col("o_orderpriority").alias("kept")))
    rows = t.orders.select("o_orderkey", D.translate_list(D.as_map(document), "liked", _lookup()).alias("a"))
    return rows.select("o_orderkey", *_fields("a", "liked", "kept"))


@query("u17_category_at", f"SELECT o_orderkey, {_CATEGORY} AS category FROM orders")
def u17(t):
    return _brand_documents(t).select("o_orderkey", D.category_at(F.col("a"), "brand", _lookup()).alias("category"))


@query(
    "u18_birth_date",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'X' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS born FROM orders",
)
def u18(t):
    status = F.col("o_orderstatus")
    full = F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).when(status == "O", F.date_format("o_orderdate", "dd/MM/yyyy"))
    day, month, year = (f("o_orderdate").cast("string") for f in (F.dayofmonth, F.month, F.year))
    return t.orders.select("o_orderkey", dates.birth_date(full, day, month, year).cast("string").alias("born"))


@query(
    "u19_value_if",
    f"WITH {S.CONTACT_ROWS} SELECT row_id, CASE WHEN parent_flag THEN brands END AS intent FROM contact_rows",
)
def u19(t):
    return _attributes(t).select("row_id", D.value_if(F.col("a"), "is_parent", "brands", "Yes").alias("intent"))


@query(
    "u20_strip_prefix",
    """SELECT o_orderkey, '{"status":"' || o_orderstatus || '","level":"' || o_orderpriority || '"}' AS coupons FROM orders""",
)
def u20(t):
    document = F.to_json(F.struct(F.col("o_orderstatus").alias("coupon_redeemed_status"), F.lit("x").alias("other"), F.col("o_orderpriority").alias("coupon_redeemed_level")))
    return t.orders.select("o_orderkey", D.as_json(D.strip_prefix(D.as_map(document), "coupon_redeemed")).alias("coupons"))


_IDS = """
old_ids AS (SELECT o_custkey AS id, o_orderpriority AS address, o_orderstatus AS ref FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY 1, 2, 3),
new_ids AS (SELECT o_custkey AS id, o_orderpriority AS address, o_orderstatus AS ref FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY 1, 2, 3)
"""


@query(
    "u21_ids_by_address",
    f"""WITH {_IDS}, pairs AS (SELECT id, address, ref FROM old_ids UNION SELECT id, address, ref FROM new_ids)
        SELECT id, address, string_agg(ref, ',' ORDER BY ref) AS refs FROM pairs GROUP BY 1, 2""",
)
def u21(t):
    late = F.col("o_orderdate") >= F.lit(S.CUTOFF).cast("timestamp_ntz")
    once = t.orders.select(F.col("o_custkey").alias("id"), late.alias("late"), F.col("o_orderpriority").alias("address"), F.col("o_orderstatus").alias("ref")).distinct()
    pairs = once.groupBy("id").agg(
        *[F.collect_list(F.when(F.col("late") == flag, F.struct("address", F.col("ref").alias("id")))).alias(name) for name, flag in (("old", False), ("new", True))]
    )
    merged = D.merge_ids(D.ids_by_address(F.col("old")), D.ids_by_address(F.col("new")))
    return pairs.select("id", F.explode(merged).alias("address", "r")).select("id", "address", F.array_join(F.array_sort("r"), ",").alias("refs"))


@query(
    "u22_merge_validity",
    """WITH stated AS (SELECT o_custkey AS id, o_orderpriority AS address, o_orderdate AS since, o_orderkey AS seq,
           CASE o_orderstatus WHEN 'F' THEN 'invalid' WHEN 'O' THEN 'valid' END AS state FROM orders)
       SELECT id, address, arg_max(state, (since, seq)) AS state FROM stated WHERE state IS NOT NULL GROUP BY 1, 2
       UNION ALL SELECT DISTINCT o_custkey, 'old', 'unknown' FROM orders""",
)
def u22(t):
    status = F.col("o_orderstatus")
    rows = t.orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("address"), F.struct("o_orderdate", "o_orderkey").alias("rank"),
        F.when(status == "F", "TRUE").otherwise("false").alias("bad"), F.when(status == "O", "valid").when(status == "F", "catchall").alias("result"),
    )
    stated = rows.where((F.col("bad") == "TRUE") | F.col("result").isNotNull())
    newest = stated.groupBy("id", "address").agg(F.max_by(F.struct("bad", "result", "rank"), "rank").alias("s"))
    arrays = newest.groupBy("id").agg(F.collect_list(F.struct("address", "s.bad", "s.result")).alias("l"))
    everyone = t.orders.select(F.col("o_custkey").alias("id")).distinct().join(arrays, "id", "left")
    old = F.create_map(F.lit("old"), F.lit("unknown"))
    batch = lambda c: F.transform(F.coalesce("l", F.array().cast("array<struct<address:string,bad:string,result:string>>")), lambda p: p[c])
    merged = D.merge_validity(old, batch("address"), batch("bad"), batch("result"))
    return everyone.select("id", F.explode(merged).alias("address", "state"))


@query(
    "u23_primary_address",
    f"""WITH {S.CONTACT_ROWS}, {_ADDRESSES}
        SELECT contact_id, email AS address, 'valid' AS validation_result, upper(email) AS address_normalised FROM ranked WHERE rn = 1""",
)
def u23(t):
    newest, split = _batches(t)
    known = once(newest, {"known": D.fold_addresses(F.lit(None).cast("string"), *split(F.col("old")))})
    folded = once(known, {"email": D.fold_addresses(F.col("known"), *split(F.col("new")))})
    primary = F.try_element_at(D.as_map(F.col("email")), F.lit("Primary"))
    validity = D.as_json(F.create_map(primary, F.lit("valid")))
    normalised = D.as_json(F.create_map(F.lit("Primary"), F.upper(primary)))
    return folded.select("contact_id", D.primary_address(F.col("email"), validity, normalised, F.lit("{}")).alias("p")).select(
        "contact_id", "p.address", "p.validation_result", "p.address_normalised"
    )


@query(
    "u24_append_structs",
    """SELECT o_orderkey, '[{"name":"' || o_orderstatus || '","level":"' || o_orderpriority || '"},{"name":"F","level":"x"}]' AS relations FROM orders""",
)
def u24(t):
    one = lambda name, level: F.struct(name.alias("name"), level.alias("level"))
    own = one(F.col("o_orderstatus"), F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", F.to_json(D.append_distinct(F.array(own), F.array(own, one(F.lit("F"), F.lit("x"))))).alias("relations"))


@query(
    "u25_named_counts",
    """SELECT user_id, event_type, '"' || event_type || '":{"events":' || count(*) || ',"errors":' || count(*) FILTER (value > 30) || '}' AS fragment FROM events GROUP BY 1, 2""",
)
def u25(t):
    counts = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("value") > 30).alias("errors"))
    return counts.select("user_id", "event_type", D.named_counts(F.col("event_type"), {"events": F.col("events"), "errors": F.col("errors")}).alias("fragment"))


@query("u26_any_timestamp", "SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def u26(t):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    raw = F.when(F.col("event_type") == "view", seconds.cast("string")).otherwise(F.date_format("ts", "dd-MM-yyyy HH:mm:ss"))
    return t.events.select("event_id", dates.any_timestamp(raw).alias("parsed"))


@query(
    "u27_scalar_at",
    "SELECT o_orderkey, o_orderstatus AS a_b, o_orderpriority AS first, CAST(NULL AS VARCHAR) AS object_is_null FROM orders",
)
def u27(t):
    document = F.to_json(F.struct(F.struct(F.col("o_orderstatus").alias("b")).alias("a"), F.array("o_orderpriority", "o_orderstatus").alias("list")))
    rows = t.orders.select("o_orderkey", document.alias("d"))
    d = F.col("d")
    return rows.select("o_orderkey", D.scalar_at(d, "$.a.b").alias("a_b"), D.scalar_at(d, "$.list[0]").alias("first"), D.scalar_at(d, "$.a").alias("object_is_null"))


@query(
    "u28_elements_to_rows",
    """SELECT o_orderkey, unnest(['{"id":"' || o_custkey || '"}', '{"id":"' || o_orderstatus || '"}']) AS element FROM orders""",
)
def u28(t):
    both = F.to_json(F.array(F.struct(F.col("o_custkey").cast("string").alias("id")), F.struct(F.col("o_orderstatus").alias("id"))))
    return t.orders.select("o_orderkey", F.explode(D.elements(both)).alias("element"))


def _mean_model():
    def model(batch: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        matrix = np.stack(batch["embedding"].to_numpy()).astype("float64")
        weights = np.arange(1, matrix.shape[1] + 1, dtype="float64")
        return pd.DataFrame({"vec_id": batch["vec_id"], "score": np.round(matrix @ weights, 3)})

    return model


@query(
    "u30_batch_scoring",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) * i)), 3) AS score FROM embeddings""",
)
def u30(t):
    return score_rows(t.embeddings.select("vec_id", "embedding"), _mean_model, "vec_id long, score double")


@query("u31_json_round_trip", """SELECT event_id, '{"k":"' || json_extract_string(props, '$.k') || '"}' AS props FROM events""")
def u31(t):
    return t.events.select("event_id", D.as_json(D.as_map(F.col("props"))).alias("props"))


@query(
    "u03_latest_values_of_documents",
    f"WITH {S.CONTACT_ROWS} SELECT contact_id, arg_max(brands, (ingested_at, row_id)) FILTER (brands IS NOT NULL) AS brands FROM contact_rows GROUP BY 1",
)
def u03_values(t):
    rows = _attributes(t).select("contact_id", "ingested_at", "row_id", F.try_element_at("a", F.lit("brands")).alias("brands"))
    return latest_values(rows, ["contact_id"], ["brands"], ["ingested_at", "row_id"])


@query(
    "c11_crm_lists",
    """SELECT contact_id, string_agg(DISTINCT v, ',' ORDER BY v) AS brands FROM (
         SELECT CAST(o_custkey AS VARCHAR) AS contact_id, unnest([o_orderpriority, o_orderstatus]) AS v FROM orders) GROUP BY 1""",
)
def c11_lists(t):
    crm = contacts.crm_contacts(crm_raw(t))
    return contacts.listed_per_contact(crm, "brands")


def crm_raw(t):
    """Orders as CRM records with a JSON array of contact ids."""
    o = t.orders
    ids = F.to_json(F.array(F.struct(F.col("o_custkey").cast("string").alias("contact_id"), F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("phone"), F.col("o_orderstatus").alias("mobile"))))
    document = F.to_json(F.struct(
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("c"), F.col("o_orderpriority"), F.lit("@example.org"))).alias("email"),
        F.concat_ws(" , ", "o_orderpriority", "o_orderstatus").alias("brands"),
        F.when(F.col("o_orderstatus") == "F", "true").alias("bad_address"), F.lit("valid").alias("verdict"),
        F.col("o_orderpriority").alias("relation_name"), F.col("o_orderstatus").alias("relation_kind"),
    ))
    return o.select(ids.alias("ids"), document.alias("document"), F.col("o_orderkey").cast("string").alias("object_id"), F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("modified_at"))


@query(
    "c11_crm_ids",
    """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS contact_id, 'c' || o_orderpriority || '@example.org' AS email, CAST(o_orderkey AS VARCHAR) AS object_id
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def c11_ids(t):
    return contacts.crm_id_pairs(contacts.crm_contacts(crm_raw(t)))


@query(
    "c11_crm_phone",
    """SELECT CAST(o_custkey AS VARCHAR) AS contact_id, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE o_orderstatus END AS phone, CAST(o_orderkey AS VARCHAR) AS object_id FROM orders""",
)
def c11_phone(t):
    return contacts.crm_contacts(crm_raw(t)).select("contact_id", "phone", "object_id")
