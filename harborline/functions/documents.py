"""JSON documents as ``map<string,string>`` columns and their merge rules.

All rules are built from higher-order functions, so they run inside the JVM.
A document is parsed once (:func:`as_map`), worked on as a map and rendered
once at the sink (:func:`as_json`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from harborline.functions.text import blank_to_null, to_flag

# Labels of the first mail addresses of a contact and the prefix
# of the following ones, and the key suffix that marks a non-address entry.
FIRST_LABELS = ["Primary", "Secondary", "Tertiary"]
LATER_LABEL = "Email_"
DATE_KEY_SUFFIX = "Date"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), lambda bound: body(bound)), 1)


# --- parsing and rendering -------------------------------------------------

def as_map(document: Column) -> Column:
    """Flat view of a JSON object; nested values keep their JSON text."""
    return F.from_json(document, "map<string,string>")


def as_json(value: Column) -> Column:
    return F.to_json(value)


def scalar_at(document: Column, path: str) -> Column:
    """Scalar at a JSON path; objects and arrays give null."""
    value = F.get_json_object(document, path)
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(document), path, "variant"))
    # a document that repeats a key has no variant; there, what isn't JSON itself must have been a text
    text = (kind == "STRING") | (kind.isNull() & F.try_parse_json(value).isNull())
    return F.when(~value.rlike(r"^\s*[\[{]"), value).when(text, value)


def elements(document: Column, element_type: str = "string") -> Column:
    """A JSON array as an array column."""
    return F.from_json(document, f"array<{element_type}>")


# --- picking attributes ----------------------------------------------------

def pick(attributes: Column, keys: Column, extras: dict[str, Column] | None = None) -> Column:
    """The listed, filled attributes plus fixed extra entries."""
    chosen = F.map_filter(attributes, lambda k, v: F.array_contains(keys, k) & v.isNotNull())
    if not extras:
        return chosen
    names = list(extras)
    kept = F.map_filter(chosen, lambda k, _: ~k.isin(names))
    added = F.create_map(*[c for name in names for c in (F.lit(name), extras[name])])
    return F.map_concat(kept, F.map_filter(added, lambda _, v: v.isNotNull()))


def first_value(attributes: Column, keys: Column) -> Column:
    """First listed attribute that holds a value."""
    values = F.transform(keys, lambda k: blank_to_null(F.try_element_at(attributes, k)))
    return F.try_element_at(F.filter(values, lambda v: v.isNotNull()), F.lit(1))


def any_flag(attributes: Column, keys: Column) -> Column:
    """True if one listed attribute says yes; null if none is present."""
    values = F.filter(
        F.transform(keys, lambda k: F.try_element_at(attributes, k)), lambda v: v.isNotNull()
    )
    return let(
        values,
        lambda vs: F.when(F.size(vs) > 0, F.exists(vs, lambda v: F.coalesce(to_flag(v), F.lit(False)))),
    )


def flag_at(attributes: Column, key: str) -> Column:
    return to_flag(F.try_element_at(attributes, F.lit(key)))


def listed_values(attributes: Column, keys: Column, allowed: Column | None = None) -> Column:
    """Values of the listed attributes as one comma list, optionally filtered.

    A value may itself be a list separated by comma or semicolon. An empty
    allow-list lets everything through.
    """
    values = F.flatten(
        F.transform(
            F.filter(
                F.transform(keys, lambda k: F.try_element_at(attributes, k)),
                lambda v: v.isNotNull(),
            ),
            lambda v: F.transform(F.split(v, "[,;]"), lambda v: F.trim(v)),
        )
    )
    kept = F.filter(F.array_distinct(values), lambda v: v != "")
    if allowed is not None:
        kept = F.filter(kept, lambda v: (F.size(allowed) == 0) | F.array_contains(allowed, v))
    return F.nullif(F.array_join(kept, ","), F.lit(""))


def brand_values(attributes: Column, keys: Column, category_of: Column) -> Column:
    """Listed attributes re-keyed to brand names with their brand's category.

    ``category_of`` maps brand -> category; attributes whose value names no
    known brand are left out.
    """
    entries = F.map_entries(
        F.map_filter(
            attributes,
            lambda k, v: F.array_contains(keys, k) & F.try_element_at(category_of, v).isNotNull(),
        )
    )
    brands = F.array_distinct(F.transform(entries, lambda e: e["value"]))
    return F.map_from_arrays(brands, F.transform(brands, lambda b: F.try_element_at(category_of, b)))


def translate_list(attributes: Column, key: str, names: Column) -> Column:
    """Replace ids by names inside one list-valued attribute."""
    def rename(value: Column) -> Column:
        ids = F.transform(F.split(value, "[,;]"), lambda v: F.trim(v))
        return F.array_join(
            F.transform(ids, lambda i: F.coalesce(F.try_element_at(names, i), i)), ","
        )
    return F.transform_values(attributes, lambda k, v: F.when(k == key, rename(v)).otherwise(v))


def category_at(attributes: Column, key: str, categories: Column) -> Column:
    """Category of one attribute's value through a lookup map."""
    return F.try_element_at(categories, F.try_element_at(attributes, F.lit(key)))


def value_if(attributes: Column, condition_key: str, value_key: str, expected: str) -> Column:
    """One attribute, given that another one has the expected value."""
    condition = F.lower(F.trim(F.try_element_at(attributes, F.lit(condition_key))))
    return F.when(condition == expected.lower(), F.try_element_at(attributes, F.lit(value_key)))


def strip_prefix(attributes: Column, prefix: str) -> Column:
    """Attributes whose key has the prefix, with the prefix taken off; of keys that become equal the first in order stays."""
    chosen = F.map_filter(attributes, lambda k, _: k.startswith(prefix))
    entries = F.transform(
        F.map_entries(chosen),
        lambda e: F.struct(F.regexp_replace(F.substring(e["key"], F.lit(len(prefix) + 1), F.length(e["key"])), "^_+", "").alias("key"), e["value"].alias("value")),
    )
    keys = F.transform(entries, lambda e: e["key"])
    return F.map_from_entries(F.filter(entries, lambda e, i: F.array_position(keys, e["key"]) == i + 1))


# --- merging two documents -------------------------------------------------

def _either(target: Column, source: Column, merged: Column) -> Column:
    return F.when(target.isNull(), source).when(source.isNull(), target).otherwise(merged)


def prefer_source(target: Column, source: Column) -> Column:
    """Key-wise: the source value unless it is null."""
    merged = F.map_zip_with(target, source, lambda _, t, s: F.coalesce(s, t))
    return _either(target, source, merged)


def prefer_source_except(target: Column, source: Column, fixed_keys: list[str]) -> Column:
    """As :func:`prefer_source`, but the fixed keys keep a value once set."""
    merged = F.map_zip_with(
        target,
        source,
        lambda k, t, s: F.when(k.isin(fixed_keys), F.coalesce(t, s)).otherwise(F.coalesce(s, t)),
    )
    return _either(target, source, merged)


def first_non_null(documents: Column) -> Column:
    """Fold an array of maps, earlier entries winning key by key."""
    empty = F.create_map().cast("map<string,string>")
    return F.aggregate(
        documents,
        empty,
        lambda acc, m: F.when(m.isNull(), acc).otherwise(
            F.map_zip_with(acc, m, lambda _, a, b: F.coalesce(a, b))
        ),
    )


def union_lists(*lists: Column) -> Column:
    """Set union of comma lists, first occurrence keeps its place."""
    items = F.transform(F.split(F.concat_ws(",", *lists), ","), lambda v: F.trim(v))
    kept = F.array_distinct(F.filter(items, lambda v: v != ""))
    return F.nullif(F.array_join(kept, ","), F.lit(""))


def union_list_array(lists: Column) -> Column:
    """:func:`union_lists` over an array column of comma lists."""
    return union_lists(F.array_join(lists, ","))


def distinct_values(values: Column) -> Column:
    """Distinct filled values of an array as one comma list."""
    kept = F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (F.trim(v) != "")))
    return F.nullif(F.array_join(kept, ","), F.lit(""))


def filled_or(source: Column, target: Column) -> Column:
    """The source text unless it is null or blank."""
    return F.coalesce(F.when(F.trim(source) != "", source), target)


def append_distinct(target: Column, source: Column) -> Column:
    """Append structs to an array of structs, without repeats."""
    return _either(target, source, F.array_union(target, source))


# --- contact addresses -----------------------------------------------------

def fold_addresses(old: Column, values: Column, dates: Column) -> Column:
    """Merge known addresses with a new batch into a labelled JSON document.

    The first occurrence of an address counts; known ones have no date. The
    newest come first and undated ones keep their order at the end.
    """
    known_map = as_map(old)
    known = F.transform(
        F.filter(
            F.map_entries(known_map),
            lambda e: ~e["key"].endswith(DATE_KEY_SUFFIX) & (F.coalesce(e["value"], F.lit("")) != ""),
        ),
        lambda e: F.struct(e["value"].alias("value"), F.lit(None).cast("timestamp").alias("at")),
    )
    none = F.array().cast("array<struct<value:string,at:timestamp>>")
    batch = F.when(
        F.size(values) == F.size(dates),
        F.filter(
            F.zip_with(
                values, dates, lambda v, d: F.struct(v.alias("value"), d.try_cast("timestamp").alias("at"))
            ),
            lambda p: F.coalesce(p["value"], F.lit("")) != "",
        ),
    )
    pairs = F.concat(F.coalesce(known, none), F.coalesce(batch, none))
    no_news = F.coalesce(F.size(values), F.lit(0)) <= 0
    return F.when(
        old.isNotNull() & no_news, F.coalesce(F.when(known_map.isNotNull(), old), F.lit("{}"))
    ).otherwise(let(let(pairs, _newest_first), _labelled))


def _newest_first(pairs: Column) -> Column:
    """First occurrence of each address, dated ones first, newest on top."""
    names = F.transform(pairs, lambda p: p["value"])
    unique = F.filter(pairs, lambda p, i: F.array_position(names, p["value"]) == i + 1)
    ranked = F.transform(
        unique, lambda p, i: F.struct(p["at"].alias("at"), (-i).alias("seq"), p["value"].alias("value"))
    )
    return F.sort_array(ranked, asc=False)


def _labelled(ranked: Column) -> Column:
    """JSON object label -> address; null when there is none."""
    labels = F.transform(
        ranked,
        lambda _, i: F.when(
            i < len(FIRST_LABELS), F.try_element_at(F.array(*map(F.lit, FIRST_LABELS)), i + 1)
        ).otherwise(F.concat(F.lit(LATER_LABEL), (i + 1).cast("string"))),
    )
    merged = F.map_from_arrays(labels, F.transform(ranked, lambda r: r["value"]))
    return F.when(F.size(ranked) > 0, as_json(merged))


def ids_by_address(pairs: Column) -> Column:
    """``array<struct<address,id>>`` to a map address -> distinct ids."""
    addressed = F.filter(pairs, lambda p: p["address"].isNotNull() & p["id"].isNotNull())
    addresses = F.array_distinct(F.transform(addressed, lambda p: p["address"]))
    return F.map_from_arrays(
        addresses,
        F.transform(
            addresses,
            lambda a: F.array_distinct(
                F.transform(F.filter(addressed, lambda p: p["address"] == a), lambda p: p["id"])
            ),
        ),
    )


def merge_ids(target: Column, source: Column) -> Column:
    """Union of the id lists per address."""
    merged = F.map_zip_with(
        target,
        source,
        lambda _, t, s: F.when(t.isNull(), s).when(s.isNull(), t).otherwise(F.array_union(t, s)),
    )
    return _either(target, source, merged)


def merge_validity(target: Column, addresses: Column, bad: Column, results: Column) -> Column:
    """Validity per address; the newest (first) statement of a batch wins.

    A bad-address flag marks the address as invalid, else the result counts.
    """
    states = F.transform(
        F.arrays_zip(addresses.alias("address"), bad.alias("bad"), results.alias("result")),
        lambda z: F.struct(
            z["address"].alias("address"),
            F.when(F.lower(z["bad"]) == "true", F.lit("invalid")).otherwise(z["result"]).alias("state"),
        ),
    )
    stated = F.filter(states, lambda s: s["address"].isNotNull() & s["state"].isNotNull())

    def newest(found: Column) -> Column:
        names = F.transform(found, lambda s: s["address"])
        return F.map_from_entries(F.filter(found, lambda s, i: F.array_position(names, s["address"]) == i + 1))

    return prefer_source(target, let(stated, newest))


def primary_address(address: Column, validity: Column, normalised: Column, hashed: Column) -> Column:
    """Primary address with its validation result, normalised form and hash."""
    primary = F.try_element_at(as_map(address), F.lit(FIRST_LABELS[0]))
    return F.struct(
        primary.alias("address"),
        F.try_element_at(as_map(validity), primary).alias("validation_result"),
        F.try_element_at(as_map(normalised), F.lit(FIRST_LABELS[0])).alias("address_normalised"),
        F.try_element_at(as_map(hashed), F.lit(FIRST_LABELS[0])).alias("address_hashed"),
    )


# --- formatted fragments ---------------------------------------------------

def json_text(text: Column) -> Column:
    """A text as a quoted, escaped JSON string; null stays null."""
    quoted = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def named_counts(name: Column, counts: dict[str, Column]) -> Column:
    """One ``"name":{...}`` fragment of a JSON object."""
    body = as_json(F.struct(*[c.alias(n) for n, c in counts.items()]))
    return F.concat(json_text(name), F.lit(":"), body)
