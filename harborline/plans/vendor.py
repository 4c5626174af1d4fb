"""Vendor contacts with all their attributes: parse, fold, merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions import documents as D
from harborline.functions.dates import age_years, birth_date
from harborline.functions.security import hashed_identifier
from harborline.functions.text import blank_to_null
from harborline.operators import merge as M
from harborline.operators.attributes import Addresses, Entries, Newest, Rule, fold
from harborline.operators.once import once
from harborline.plans.contacts import _first_fold, _fold, group_keys, text_at

#: How each column is folded over a contact's records.
COLUMNS: dict[str, Rule] = {
    "email": Addresses(), "email_normalized": Addresses(), "email_hashed": Addresses(),
    "first_name": Newest(), "last_name": Newest(), "phone": Newest(), "phone_number_normalized": Newest(), "phone_number_hashed": Newest(),
    "gaid": Newest(), "idfa": Newest(), "birthday": Newest("date"), "pincode": Newest(), "gender": Newest(), "city": Newest(), "state": Newest(),
    "source": Entries(), "consumption_brand_preference": Newest(), "brand_consumption_frequency": Entries(), "parent_flag": Newest("boolean"),
    "dessert_preference": Entries(), "scan_code_flag": Newest("boolean"), "packscan_packtype": Newest(), "chocolate_consumption": Newest(),
    "romance": Entries(), "sports": Entries(), "biscuit_consumption_flag": Newest("boolean"), "mithai_consumption_flag": Newest("boolean"),
    "candies_consumption_flag": Newest("boolean"), "age": Newest("int"), "coupon_flag": Newest("boolean"),
}
#: How a change is merged into the stored contact; every other column takes the new value unless it is null.
RULES: dict[str, M.Rule] = {
    **dict.fromkeys(COLUMNS, M.coalesce),
    **dict.fromkeys(("email", "email_normalized", "email_hashed"), _fold),
    **dict.fromkeys(("gender", "city", "state"), M.non_empty),
    **dict.fromkeys(("source", "brand_consumption_frequency", "dessert_preference", "romance", "sports"), M.map_merge),
    "consumption_brand_preference": M.csv_union,
}
#: Attribute groups of the lookup that say which document keys feed a column.
GROUPS = ["city", "source", "brand_preference", "brand_frequency", "parent_flag", "dessert", "scan_code", "romance", "sports", "mithai", "candies", "coupon"]


def lookup_map(lookup: DataFrame, key: str, value: str) -> Column:
    """A small lookup table as one map, as a scalar subquery; of repeated keys the smallest value counts."""
    once_each = lookup.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("k")).agg(F.min(F.col(value).cast("string")).alias("v"))
    return once_each.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("m")).scalar()


def parse(raw: DataFrame, as_of: Column, attribute_map: DataFrame, brands: DataFrame, recipes: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Vendor records ``(contact_id, document, ingested_at, row_id)`` with every attribute of COLUMNS.

    Lookups: attribute_map (attribute_group, attribute_name, hmz_object), brands (brand, category), recipes
    (id, name), frequencies (frequency, category). Each document is parsed once.
    """
    known = raw.where(blank_to_null(F.col("contact_id")).isNotNull())
    parsed = once(known, {"a": D.as_map(F.col("document"))}).withColumns({f"_{g}": group_keys(attribute_map, g) for g in GROUPS})
    parsed = parsed.withColumns({
        "_brands": lookup_map(brands, "brand", "category"), "_recipes": lookup_map(recipes, "id", "name"),
        "_frequencies": lookup_map(frequencies, "frequency", "category"),
    })
    a, at, keys = F.col("a"), lambda key: text_at("a", key), lambda group: F.col(f"_{group}")
    birth = birth_date(at("date_of_birth"), at("birth_day"), at("birth_month"), at("birth_year"))
    dated = once(parsed, {"birthday": birth, "birth_year": at("birth_year").try_cast("int")})
    made = {
        "email": at("email"), "email_normalized": at("normalized_email"), "email_hashed": hashed_identifier(at("email_hashed"), at("normalized_email")),
        "first_name": at("first_name"), "last_name": at("last_name"), "phone": at("phone"),
        "phone_number_normalized": F.when(at("phone").isNotNull(), at("normalized_phone")),
        "phone_number_hashed": hashed_identifier(at("phone_hashed"), at("normalized_phone")),
        "gaid": at("google_advertiser_id__gaid_"), "idfa": at("apple_id_for_advertisers__idfa_"),
        "birthday": F.col("birthday"), "pincode": at("zip"), "gender": at("gender"), "city": D.first_value(a, keys("city")), "state": at("state"),
        "source": D.pick(a, keys("source")),
        "consumption_brand_preference": D.listed_values(a, keys("brand_preference"), F.map_keys("_brands")),
        "brand_consumption_frequency": D.brand_values(a, keys("brand_frequency"), F.col("_brands")),
        "parent_flag": D.any_flag(a, keys("parent_flag")),
        "dessert_preference": D.translate_list(D.pick(a, keys("dessert")), "liked_recipes", F.col("_recipes")),
        "scan_code_flag": D.any_flag(a, keys("scan_code")), "packscan_packtype": at("packtype"),
        "chocolate_consumption": D.category_at(a, "how_often_do_you_consume_chocolates_", F.col("_frequencies")),
        "romance": D.pick(a, keys("romance")), "sports": D.pick(a, keys("sports")),
        "biscuit_consumption_flag": D.flag_at(a, "biscuit_consumption_flag"), "mithai_consumption_flag": D.any_flag(a, keys("mithai")),
        "candies_consumption_flag": D.any_flag(a, keys("candies")), "age": age_years(F.col("birthday"), F.col("birth_year"), as_of),
        "coupon_flag": D.any_flag(a, keys("coupon")),
    }
    return dated.select("contact_id", "ingested_at", "row_id", *[made[c].alias(c) for c in COLUMNS])


def survivors(parsed: DataFrame) -> DataFrame:
    """Per contact the newest filled value of every attribute, maps key by key, and the history of its addresses."""
    return fold(parsed, ["contact_id"], COLUMNS, ["ingested_at", "row_id"])


def merge(target: DataFrame | None, source: DataFrame, now: Column) -> DataFrame:
    """Upsert survivors into the stored contacts (None: there are none yet); all columns of COLUMNS and both stamps."""
    if target is None:
        stamps = {c: F.lit(None).cast("timestamp_ntz") for c in ("created_at", "updated_at")}
        addresses = {c: F.lit(None).cast("string") for c, rule in COLUMNS.items() if isinstance(rule, Addresses)}
        target = source.where(F.lit(False)).withColumns(addresses | stamps)
    first = {c: _first_fold for c, rule in COLUMNS.items() if isinstance(rule, Addresses)}
    return M.merge_upsert(target, source, ["contact_id"], RULES, on_insert=first, created_at="created_at", updated_at="updated_at", now=now)
