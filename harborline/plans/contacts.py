"""Harmonising contacts from JSON documents into one row per contact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions import documents as D
from harborline.functions.dates import age_years, birth_date
from harborline.functions.security import hashed_identifier
from harborline.functions.text import blank_to_null
from harborline.operators import merge as M
from harborline.operators.latest import latest_by_key, latest_values, merged_documents
from harborline.operators.once import once

ADULT_RANGE = (18, 100)  # fixed values


def group_keys(attribute_map: DataFrame, group: str, hmz_object: str = "contact") -> Column:
    """Attribute names of a group as a scalar array, from the lookup table.

    The lookup stays a scalar subquery of the job that uses it; it is never
    brought to the driver. Attach it with ``withColumn`` before a higher-order
    function refers to it.
    """
    return (
        attribute_map.where((F.col("attribute_group") == group) & (F.col("hmz_object") == hmz_object))
        .agg(F.array_sort(F.collect_set("attribute_name")).alias("names"))
        .scalar()
    )


def text_at(attributes: str, key: str) -> Column:
    """One filled attribute of a map column."""
    return blank_to_null(F.try_element_at(F.col(attributes), F.lit(key)))


VENDOR_GROUPS = ["city", "source", "brands", "parent_flag"]


def vendor_contacts(raw: DataFrame, as_of: Column, attribute_map: DataFrame) -> DataFrame:
    """Vendor rows ``(contact_id, document, ingested_at)`` to typed attributes.

    The lookup says which document keys feed the grouped attributes.
    """
    parsed = once(raw.where(blank_to_null(F.col("contact_id")).isNotNull()), {"a": D.as_map(F.col("document"))})
    parsed = parsed.withColumns({f"_{g}": group_keys(attribute_map, g) for g in VENDOR_GROUPS})
    group = {g: F.col(f"_{g}") for g in VENDOR_GROUPS}
    at = lambda key: text_at("a", key)
    birth = birth_date(at("date_of_birth"), at("birth_day"), at("birth_month"), at("birth_year"))
    aged = once(parsed, {"birthday": birth, "birth_year": at("birth_year").try_cast("int")})
    aged = once(aged, {"age": age_years(F.col("birthday"), F.col("birth_year"), as_of)})
    low, high = ADULT_RANGE
    adults = aged.where(F.col("age").between(low, high) | F.col("age").isNull())
    return adults.select(
        "contact_id", "ingested_at",
        at("email").alias("email"),
        hashed_identifier(at("email_hashed"), at("normalized_email")).alias("email_hashed"),
        at("phone").alias("phone"),
        hashed_identifier(at("phone_hashed"), at("normalized_phone")).alias("phone_hashed"),
        at("first_name").alias("first_name"),
        at("last_name").alias("last_name"),
        at("gender").alias("gender"),
        D.first_value(F.col("a"), group["city"]).alias("city"),
        "birthday",
        "age",
        D.pick(F.col("a"), group["source"]).alias("source"),
        D.listed_values(F.col("a"), group["brands"]).alias("brands"),
        D.any_flag(F.col("a"), group["parent_flag"]).alias("parent_flag"),
    )


VENDOR_TEXT = ["phone", "phone_hashed", "first_name", "last_name", "gender", "city", "birthday", "age", "brands", "parent_flag"]


def newest_vendor_rows(contacts: DataFrame) -> DataFrame:
    """Latest row per contact; at equal times a phone hash beats a mail hash."""
    priority = F.when(F.col("phone_hashed").isNotNull(), 1).when(F.col("email_hashed").isNotNull(), 2).otherwise(3)
    ranked = contacts.withColumn("priority", priority)
    return latest_by_key(ranked, ["contact_id"], ["ingested_at", -F.col("priority"), "email", "phone"]).drop("priority")


def survivors(contacts: DataFrame) -> DataFrame:
    """Latest filled value of every attribute per contact, plus mail history.

    Documents are merged attribute by attribute and addresses are folded to
    their newest occurrence first, so no step gathers all rows of a contact.
    ``contacts`` is read three times: pass a written table (``sinks.tables.
    materialise``) rather than the parsing step itself.
    """
    values = latest_values(contacts, ["contact_id"], VENDOR_TEXT, ["ingested_at", "email", "phone"])
    documents = merged_documents(contacts, ["contact_id"], "source", ["ingested_at"])
    once = (
        contacts.where(F.col("email").isNotNull())
        .groupBy("contact_id", "email")
        .agg(F.max("ingested_at").alias("at"))
    )
    newest = F.sort_array(F.collect_list(F.struct("at", "email")), asc=False)
    addresses = once.groupBy("contact_id").agg(newest.alias("n")).select(
        "contact_id",
        F.struct(
            F.transform("n", lambda p: p["email"]).alias("values"),
            F.transform("n", lambda p: p["at"].cast("string")).alias("dates"),
        ).alias("email"),
    )
    return values.join(documents, "contact_id", "left").join(addresses, "contact_id", "left")


def _fold(target: Column, source: Column) -> Column:
    return F.when(source.isNull(), target).otherwise(M.fold_addresses(target, source))


def _first_fold(_: Column, source: Column) -> Column:
    return F.when(source.isNotNull(), M.new_addresses(source))


VENDOR_RULES = {
    "email": _fold,
    "phone": M.coalesce,
    "phone_hashed": M.coalesce,
    "first_name": M.coalesce,
    "last_name": M.coalesce,
    "birthday": M.coalesce,
    "age": M.coalesce,
    "gender": M.non_empty,
    "city": M.non_empty,
    "source": M.map_merge_immutable("gr_source"),
    "brands": M.csv_union,
    "parent_flag": M.coalesce,
}
WATCHED = ["gender", "first_name", "last_name", "city", "brands"]


def merge_contacts(target: DataFrame, source: DataFrame, now: Column) -> DataFrame:
    """Upsert survivors into the harmonised contacts."""
    return M.merge_upsert(
        target, source, ["contact_id"], VENDOR_RULES,
        on_insert={"email": _first_fold},
        watched=WATCHED, bump="personalised_at",
        created_at="created_at", updated_at="updated_at", now=now, check_unique=False,
    )


def crm_contacts(raw: DataFrame) -> DataFrame:
    """CRM rows: one contact per element of the JSON id array.

    Columns: ids (JSON array of objects), document, object_id, created_at,
    modified_at.
    """
    element = once(raw.select("*", F.explode_outer(D.elements(F.col("ids"))).alias("e")).where(F.col("e").isNotNull()), {"attributes": D.as_map(F.col("document"))})
    return element.select(
        D.scalar_at(F.col("e"), "$.contact_id").alias("contact_id"),
        F.coalesce(D.scalar_at(F.col("e"), "$.phone"), D.scalar_at(F.col("e"), "$.mobile")).alias("phone"),
        D.scalar_at(F.col("document"), "$.email").alias("email"),
        "attributes",
        "object_id", "created_at", "modified_at",
    )


def crm_id_pairs(contacts: DataFrame) -> DataFrame:
    """Distinct (contact, address, CRM id) rows: the ids in long form."""
    return contacts.where(F.col("email").isNotNull()).select("contact_id", "email", "object_id").distinct()


def crm_ids(contacts: DataFrame) -> DataFrame:
    """Per contact a map from address to its distinct CRM ids.

    The map of a contact is one value; where an address may carry any number
    of ids, work with :func:`crm_id_pairs` instead.
    """
    ids = crm_id_pairs(contacts).groupBy("contact_id", "email").agg(
        F.array_sort(F.collect_list("object_id")).alias("ids")
    )
    return ids.groupBy("contact_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("email", "ids")))).alias("crm_ids")
    )


RELATION = ["relation_name", "relation_kind"]


def crm_survivors(contacts: DataFrame) -> DataFrame:
    """One row per contact: newest phone, brand list, CRM ids, address validity
    and the distinct relations named in its records.

    Every part is folded to distinct or newest rows before it is collected.
    ``contacts`` is read once per part: pass a written table.
    """
    order = ["modified_at", "object_id"]
    at = lambda key: F.try_element_at("attributes", F.lit(key))
    phones = latest_values(contacts, ["contact_id"], ["phone"], order)
    stated = contacts.where(F.col("email").isNotNull()).select(
        "contact_id", "email", *order,
        F.when(F.lower(at("bad_address")) == "true", "invalid").otherwise(at("verdict")).alias("state"),
    )
    newest = latest_values(stated, ["contact_id", "email"], ["state"], order).where(F.col("state").isNotNull())
    validity = newest.groupBy("contact_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("email", "state")))).alias("validity")
    )
    named = contacts.select("contact_id", *[at(c).alias(c) for c in RELATION]).distinct()
    relations = named.where(F.coalesce(*RELATION).isNotNull()).groupBy("contact_id").agg(
        F.array_sort(F.collect_list(F.struct(*RELATION))).alias("relations")
    )
    result = phones
    for part in (listed_per_contact(contacts, "brands"), crm_ids(contacts), validity, relations):
        result = result.join(part, "contact_id", "left")
    return result


CRM_RULES = {
    "phone": M.coalesce,
    "brands": M.csv_union,
    "crm_ids": M.merge_ids,
    "validity": M.map_merge,
    "relations": M.append_structs,
}


def merge_crm(target: DataFrame, source: DataFrame, now: Column) -> DataFrame:
    """Upsert CRM survivors; a changed phone or brand list is stamped."""
    return M.merge_upsert(
        target, source, ["contact_id"], CRM_RULES, watched=["phone", "brands"], bump="personalised_at",
        created_at="created_at", updated_at="updated_at", now=now, check_unique=False,
    )


def listed_per_contact(contacts: DataFrame, key: str) -> DataFrame:
    """All entries of one list-valued attribute per contact, sorted."""
    entries = contacts.select(
        "contact_id", F.explode(F.split(F.try_element_at("attributes", F.lit(key)), ",")).alias("entry")
    ).select("contact_id", F.trim("entry").alias("entry"))
    once = entries.where(F.col("entry") != "").distinct()
    return once.groupBy("contact_id").agg(F.array_join(F.array_sort(F.collect_list("entry")), ",").alias(key))
