"""Hashing, surrogate keys and reversible protection of identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hashed_identifier(supplied: Column, normalised: Column) -> Column:
    """The hash a vendor supplied, else SHA-256 of the normalised value."""
    given = F.nullif(F.trim(supplied), F.lit(""))
    return F.coalesce(given, F.sha2(F.nullif(F.trim(normalised), F.lit("")), 256))


def md5_key(value: Column) -> Column:
    return F.upper(F.md5(value.cast("string")))


def version_key(business_key: Column, start_date: Column) -> Column:
    """Surrogate key of one dimension version."""
    return F.md5(F.concat_ws("|", business_key.cast("string"), start_date.cast("string")))


def fast_version_key(business_key: Column, start_date: Column) -> Column:
    """64-bit variant of :func:`version_key`, as text."""
    return F.xxhash64(business_key, start_date).cast("string")


def encrypt(value: Column, key: Column) -> Column:
    """AES-GCM with a random nonce, base64 text; null stays null."""
    return F.base64(F.aes_encrypt(value.cast("string"), key))


def decrypt(value: Column, key: Column) -> Column:
    return F.aes_decrypt(F.unbase64(value), key).cast("string")
