"""Change records: envelope decoding and typed projections per table.

A message is parsed once, and every field read from it as text. Each text is then cast
to its type, and a value that is there but doesn't fit its type sends the whole
message to the rejected rows, with the text and the reasons: a wrong value
never becomes a default. Defaults stand for missing fields only.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.operators.once import once
from harborline.settings import work_path


@dataclass(frozen=True)
class Field:
    """One column of a change record and how it is decoded.

    kind: long | int | double | text | decimal | bytes_decimal | micros;
    optional fields keep null, the others get the default of their kind.
    precision and scale are those of decimals; a larger number is an error.
    """

    name: str
    kind: str
    optional: bool = False
    scale: int = 2
    precision: int = 18


@dataclass(frozen=True)
class Table:
    key: str
    fields: tuple[Field, ...]


def _stamps() -> tuple[Field, ...]:
    return (Field("created_at", "micros"), Field("updated_at", "micros"))


TABLES: dict[str, Table] = {
    "users": Table("user_id", (
        Field("user_id", "long"), Field("name", "text"), Field("email", "text"),
        Field("password_hash", "text"), Field("phone", "text", True), *_stamps(),
        Field("deleted_at", "micros", True),
    )),
    "categories": Table("category_id", (
        Field("category_id", "long"), Field("name", "text"), Field("parent_id", "long", True),
        *_stamps(), Field("deleted_at", "micros", True),
    )),
    "products": Table("product_id", (
        Field("product_id", "long"), Field("name", "text"), Field("description", "text"),
        Field("price", "decimal"), Field("stock_quantity", "int"),
        Field("category_id", "long", True), *_stamps(), Field("deleted_at", "micros", True),
    )),
    "orders": Table("order_id", (
        Field("order_id", "long"), Field("user_id", "long"), Field("order_status", "text"),
        Field("total_amount", "decimal"), *_stamps(),
    )),
    "order_items": Table("order_item_id", (
        Field("order_item_id", "long"), Field("order_id", "long"), Field("product_id", "long"),
        Field("quantity", "int"), Field("price", "decimal"), *_stamps(),
    )),
    "payments": Table("payment_id", (
        Field("payment_id", "long"), Field("order_id", "long"), Field("amount", "decimal"),
        Field("payment_method", "text"), Field("payment_date", "micros"), Field("status", "text"),
        *_stamps(),
    )),
    "shipping": Table("shipping_id", (
        Field("shipping_id", "long"), Field("order_id", "long"), Field("address", "text"),
        Field("city", "text"), Field("postal_code", "text"), Field("country", "text"),
        Field("shipping_date", "micros"), Field("tracking_number", "text", True), *_stamps(),
    )),
    "product_reviews": Table("review_id", (
        Field("review_id", "long"), Field("product_id", "long"), Field("user_id", "long"),
        Field("rating", "int"), Field("comment", "text", True), *_stamps(),
    )),
}


def bytes_to_decimal(raw: Column, scale: int = 2, precision: int = 38) -> Column:
    """Big-endian two's-complement bytes, up to 16 and more if they only extend the sign, to an exact decimal.

    Null for no bytes and for numbers of more digits than the precision.
    """
    digits = F.hex(raw)
    negative = digits >= "8"  # by the first digit
    last = F.lpad(F.right(digits, F.lit(32)), 32, F.when(negative, "F").otherwise("0"))
    words = [F.conv(F.substring(last, 1 + 8 * i, 8), 16, 10).cast("decimal(10,0)") for i in range(4)]
    total = (words[0] - F.when(negative, F.lit(Decimal(1 << 32))).otherwise(F.lit(Decimal(0)))).cast("decimal(38,0)")
    for word in words[1:]:
        total = F.try_add(F.try_multiply(total, F.lit(Decimal(1 << 32))), word).cast("decimal(38,0)")
    scaled = F.try_multiply(total, F.lit(Decimal(1).scaleb(-scale))) if scale else total
    held = (F.octet_length(raw) <= 16) | digits.rlike("^(0*(?=[0-7])|F*(?=[89A-F])).{32}$")
    return F.when((F.octet_length(raw) > 0) & held, scaled.try_cast(f"decimal({precision},{scale})"))


def micros_to_timestamp(value: Column) -> Column:
    """Epoch microseconds to a timestamp, cut to milliseconds."""
    return F.timestamp_millis(F.floor(value.cast("long") / 1000)).cast("timestamp_ntz")


_DEFAULTS = {"micros": ("1970-01-01", "timestamp_ntz"), "text": ("", "string"), "long": (0, "bigint"), "int": (0, "int"), "double": (0, "double")}


def _default(field: Field) -> Column:
    value, kind = _DEFAULTS.get(field.kind, (0, f"decimal({field.precision},{field.scale})"))
    return F.lit(value).cast(kind)


def decode(field: Field, value: Column) -> Column:
    """One value that already has its wire type; a missing one becomes its default unless optional."""
    if field.kind == "micros":
        typed = micros_to_timestamp(value)
    elif field.kind == "bytes_decimal":
        typed = bytes_to_decimal(value, field.scale, field.precision)
    elif field.kind == "decimal":
        typed = value.cast(f"decimal({field.precision},{field.scale})")
    else:
        typed = value.cast("string" if field.kind == "text" else field.kind)
    return typed if field.optional else F.when(value.isNull(), _default(field)).otherwise(typed)


def _whole(text: Column, kind: str) -> Column:
    """A whole number, also written 12.0 or 1.2E1; null for anything else."""
    exact = text.try_cast("decimal(38,6)")
    return F.coalesce(text.try_cast(kind), F.when(F.floor(exact) == exact, exact.try_cast(kind)))


def decode_text(field: Field, text: Column) -> Column:
    """The typed value of a field's text; null where the text doesn't fit the type."""
    if field.kind == "text":
        return text
    if field.kind in ("long", "int"):
        return _whole(text, field.kind)
    if field.kind == "micros":
        return micros_to_timestamp(_whole(text, "long"))
    if field.kind == "bytes_decimal":
        return bytes_to_decimal(F.try_to_binary(text, F.lit("base64")), field.scale, field.precision)
    if field.kind == "decimal":
        # more decimals than the scale would be rounded: such a number doesn't fit either
        exact = text.try_cast("decimal(38,18)")
        typed = text.try_cast(f"decimal({field.precision},{field.scale})")
        return F.when(exact.isNull() | (exact == typed), typed)
    return text.try_cast(field.kind)


def _fields(table: str, decimals: str) -> list[Field]:
    if decimals not in ("numbers", "bytes"):
        raise ValueError(f"decimals are numbers or bytes, not {decimals}")
    swap = {"decimal": "bytes_decimal"} if decimals == "bytes" else {}
    return [Field(f.name, swap.get(f.kind, f.kind), f.optional, f.scale, f.precision) for f in TABLES[table].fields]


def decoded(records: DataFrame, table: str, value: str = "value", decimals: str = "numbers") -> DataFrame:
    """The message (`value`, as text), `row` (typed, or null), `error` (null, or what is wrong) and `deleted`.

    A message without a row after the change is a delete, as is a null message. One that isn't a JSON
    object, or whose key is missing, or any of whose values doesn't fit its type, has an error; several
    are joined by semicolons. Numbers may be written as texts. decimals: `numbers`, or `bytes` for the
    base64 form of unscaled two's-complement bytes. Works on batch and stream; one parse a message.
    """
    fields, key = _fields(table, decimals), TABLES[table].key
    message = F.col(f"`{value}`").cast("string")
    # a variant keeps the digits of numbers, a column of strings would pass them through doubles
    parsed = once(records.select(message.alias("value")), {"record": F.try_parse_json(message)})
    texts = {f.name: F.col(f"texts.{f.name}") for f in fields}
    read = once(parsed, {"texts": F.struct(*[F.try_variant_get("record", f"$.after.{f.name}", "string").alias(f.name) for f in fields])})
    values = once(read, {"made": F.struct(*[decode_text(f, texts[f.name]).alias(f.name) for f in fields])})
    wrong = [
        F.when(texts[f.name].isNotNull() & F.col(f"made.{f.name}").isNull(), F.concat(F.lit(f"{f.name}: "), texts[f.name])) for f in fields
    ]
    shaped = F.ltrim("value").startswith("{") & F.rtrim("value").endswith("}")
    broken = F.col("value").isNotNull() & (F.col("record").isNull() | ~shaped)
    after = F.try_variant_get("record", "$.after", "variant")
    empty = after.isNull() | F.is_variant_null(after)
    reasons = F.concat_ws("; ", F.when(texts[key].isNull(), F.lit(f"{key}: missing")), *wrong)
    error = F.when(broken, "not a change record").when(~empty, F.nullif(reasons, F.lit("")))
    checked = values.withColumn("error", error).withColumn("deleted", error.isNull() & empty)
    row = [(F.col(f"made.{f.name}") if f.optional else F.coalesce(f"made.{f.name}", _default(f))).alias(f.name) for f in fields]
    return checked.select("value", F.when(F.col("error").isNull() & ~F.col("deleted"), F.struct(*row)).alias("row"), "error", "deleted")


def after_images(records: DataFrame, table: str, value: str = "value", decimals: str = "numbers") -> DataFrame:
    """The rows after the change of all messages without an error.

    Where the others must be kept (they should be), use `split_records` or, in a stream, `decoded` with
    several sinks: `images` and `rejected` are its two sides.
    """
    return images(decoded(records, table, value, decimals))


def images(decoded_records: DataFrame) -> DataFrame:
    return decoded_records.where("row is not null").select("row.*")


def rejected(decoded_records: DataFrame) -> DataFrame:
    """value (the message's text, unchanged) and error."""
    return decoded_records.where("error is not null").select("value", "error")


def split_records(records: DataFrame, table: str, value: str = "value", decimals: str = "numbers", path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected messages) of a batch, from one parse that is written to `path` or the shared folder."""
    spark = records.sparkSession
    made = decoded(records, table, value, decimals)
    path = path or work_path(spark, "change-records")
    made.write.parquet(path)
    held = spark.read.schema(made.schema).parquet(path)
    return images(held), rejected(held)


_AVRO = {"long": "long", "int": "int", "double": "double", "text": "string", "micros": "long"}


def avro_schema(table: str) -> str:
    """The reader's Avro schema of a change record: decimals are unscaled bytes with their logical type."""
    fields = []
    for f in TABLES[table].fields:
        exact = {"type": "bytes", "logicalType": "decimal", "precision": f.precision, "scale": f.scale}
        kind = exact if f.kind in ("decimal", "bytes_decimal") else _AVRO[f.kind]
        fields.append({"name": f.name, "type": ["null", kind], "default": None})
    after = {"type": "record", "name": "Value", "fields": fields}
    return json.dumps({"type": "record", "name": "Envelope", "fields": [{"name": "after", "type": ["null", after], "default": None}]})


def decoded_avro(records: DataFrame, table: str, value: str = "value", header: int = 5, schema: str | None = None) -> DataFrame:
    """As `decoded`, from binary Avro behind a registry header of so many bytes; `value` is the message in base64.

    schema: the writer's, if it isn't `avro_schema`. Needs Spark's Avro package on the cluster. Avro values have
    their types, so only unreadable messages and missing keys are errors.
    """
    from pyspark.sql.avro.functions import from_avro

    fields, key = TABLES[table].fields, TABLES[table].key
    body = F.substring(F.col(f"`{value}`"), header + 1, 2**31 - 1)
    parsed = from_avro(body, schema or avro_schema(table), {"mode": "PERMISSIVE"})
    read = once(records.select(F.col(f"`{value}`").alias("value")), {"record": parsed})
    exact = {f.name: Field(f.name, "decimal", f.optional, f.scale, f.precision) if f.kind == "bytes_decimal" else f for f in fields}
    return avro_rows(read.select(F.base64("value").alias("value"), "record"), [exact[f.name] for f in fields], key)


def avro_rows(read: DataFrame, fields: list[Field], key: str) -> DataFrame:
    """`decoded` for records that a typed reader made: `record` is null where a message couldn't be read."""
    empty = F.col("record.after").isNull()
    unread = F.col("value").isNotNull() & F.col("record").isNull()
    error = F.when(unread, "not a change record").when(~empty & F.col(f"record.after.{key}").isNull(), f"{key}: missing")
    checked = read.withColumn("error", error).withColumn("deleted", error.isNull() & empty)
    row = F.struct(*[decode(f, F.col(f"record.after.{f.name}")).alias(f.name) for f in fields])
    return checked.select("value", F.when(F.col("error").isNull() & ~F.col("deleted"), row).alias("row"), "error", "deleted")


def topic_stream(spark: SparkSession, fmt: str, options: dict[str, str], schema: str | None = None) -> DataFrame:
    """Change-record stream from any source format.

    For a broker, earliest offsets apply on the first start and the checkpoint
    decides afterwards.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    if schema:
        reader = reader.schema(schema)
    return reader.options(**options).load()
