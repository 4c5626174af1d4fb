"""Text cleaning and identifier normalisation, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a cleaned text may keep, and the words that
# stand for a missing identifier.
KEPT_CHARACTERS = r"A-Za-z0-9\s,.\";:!?()_&%$#@"
MISSING_WORDS = ["nan", "none", ""]
PHONE_PREFIX = "+91"
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]


def keep_plain(text: Column) -> Column:
    """Drop every character outside the allowed set, then leading blanks."""
    return F.ltrim(F.regexp_replace(text, f"[^{KEPT_CHARACTERS}]", ""))


def title_words(text: Column) -> Column:
    """Capitalise each run of letters/digits.

    ``initcap`` only breaks on white space, so a marker is placed between a
    separator and the following letter, and removed after capitalising.
    """
    marked = F.regexp_replace(F.lower(text), r"([^\p{L}\p{N}\s])(?=[\p{L}\p{N}])", "$1\u0001 ")
    return F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def first_filled(*candidates: Column) -> Column:
    """First alternative that is neither null nor blank."""
    return F.coalesce(*[blank_to_null(c) for c in candidates])


def after_first(text: Column, separator: str, fallback: Column) -> Column:
    """Text behind the first separator; ``fallback`` where there is none."""
    position = F.instr(text, separator)
    return F.when(
        position > 0, F.substring(text, position + F.lit(len(separator)), F.length(text))
    ).otherwise(fallback)


def leading_tokens(text: Column, separator: str = "_", count: int = 2) -> Column:
    """The first tokens, joined again and lower-cased."""
    return F.lower(F.array_join(F.slice(F.split(text, separator), 1, count), separator))


def unquote_list(text: Column) -> Column:
    """Quotes removed and semicolons turned into commas."""
    return F.replace(F.replace(text, F.lit('"'), F.lit("")), F.lit(";"), F.lit(","))


def email_or_phone(identifier: Column) -> tuple[Column, Column]:
    """Split one identifier column into (email, phone)."""
    is_email = identifier.contains("@")
    return F.when(is_email, identifier), F.when(~is_email, identifier)


def contains_flag(text: Column, fragment: str) -> Column:
    """True when the fragment occurs, false otherwise, also for null."""
    return F.coalesce(text.contains(fragment), F.lit(False))


def _present(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(~F.lower(trimmed).isin(MISSING_WORDS), trimmed)


def clean_phone(value: Column) -> Column:
    """Trimmed phone text without a float suffix; null without any digit."""
    text = F.regexp_replace(_present(value.cast("string")), r"\.0$", "")
    return F.when(text.rlike("[0-9]"), text)


def clean_email(value: Column) -> Column:
    return _present(value.cast("string"))


def with_country_prefix(phone: Column, prefix: str = PHONE_PREFIX) -> Column:
    return F.when(phone.startswith(prefix), phone).otherwise(F.concat(F.lit(prefix), phone))


def with_single_plus(phone: Column) -> Column:
    """Exactly one leading plus sign, however many there were."""
    return F.concat(F.lit("+"), F.ltrim(phone, F.lit("+")))


def plain_mailbox(email: Column) -> Column:
    """Letters and digits only before the first @; other text is left alone."""
    at = F.instr(email, "@")
    mailbox = F.regexp_replace(F.substring(email, F.lit(1), at - 1), "[^a-zA-Z0-9]", "")
    return F.when(at > 0, F.concat(mailbox, F.substring(email, at, F.length(email)))).otherwise(email)


def to_flag(text: Column) -> Column:
    """Yes/no words to boolean; anything else is null."""
    word = F.lower(text)
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def number_text(value: Column) -> Column:
    """Identifier as text without the float suffix a numeric reader adds."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")
