"""Bronze -> silver -> star schema of the shop."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions.dates import calendar_columns, on_day
from harborline.operators.aggregates import count_distinct_if, sum_if
from harborline.operators.asof import version_at, versions_on
from harborline.operators.conform import cleaning_columns
from harborline.operators.scd import guard_dimension, guard_fact, scd2_apply
from harborline.sinks.tables import materialise, replace_partitions


def bronze_to_silver(bronze: DataFrame, day: str | None = None) -> DataFrame:
    """Cleaned rows of one day (or all): filter first, then project."""
    if day:
        bronze = bronze.where(on_day(F.col("updated_at"), day))
    return bronze.select(*cleaning_columns(bronze))


def calendar(days: DataFrame, column: str = "date_key") -> DataFrame:
    """Calendar dimension for a DataFrame of days."""
    return days.select(column, *[c.alias(n) for n, c in calendar_columns(F.col(column)).items()])


def day_range(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """All days between the two dates of a one-row DataFrame."""
    return bounds.select(F.explode(F.sequence(first, last)).alias("date_key"))


def fact_order(orders: DataFrame, users: DataFrame, shipping: DataFrame, payments: DataFrame, day: str | None = None) -> DataFrame:
    """Order status facts: one row per status an order reached.

    All branches look up the user version at creation time and the same place
    and payment, so these are joined once per order; the status rows are laid
    out as an array and exploded at the very end. Every input is read once and
    no branch row goes through a shuffle.
    """
    status = F.col("order_status")
    row = lambda name, at, done: F.struct(
        F.to_date(at).alias("date_key"), name.alias("status"), done.alias("order_completed_time")
    )
    none = F.lit(None).cast("timestamp_ntz")
    branches = F.array_compact(
        F.array(
            row(F.lit("created"), F.col("created_time"), none),
            F.when(
                status.isin("completed", "cancelled"),
                row(status, F.col("updated_time"), F.when(status == "completed", F.col("updated_time"))),
            ),
        )
    )
    if day:
        orders = orders.where(on_day(F.col("created_time"), day) | on_day(F.col("updated_time"), day))
    versioned = version_at(orders, users, "user_id", "created_time", ["user_key"], keep_unmatched=False)
    reached = (
        versioned.join(shipping.select("order_id", "postal_code", "country", "city"), "order_id", "left")
        .join(payments.select("order_id", "payment_method"), "order_id", "left")
        .withColumn("b", F.explode(branches))
    )
    if day:
        reached = reached.where(F.col("b.date_key") == F.lit(day).cast("date"))
    return reached.select(
        "order_id",
        "user_key",
        F.col("b.date_key").alias("date_key"),
        F.col("b.status").alias("order_status"),
        F.col("created_time").alias("order_created_time"),
        F.col("b.order_completed_time").alias("order_completed_time"),
        "payment_method",
        "postal_code",
        "country",
        "city",
        "total_amount",
    )


def fact_order_detail(items: DataFrame, products: DataFrame, categories: DataFrame, day: str) -> DataFrame:
    """Item facts of one day with the product and category of that day.

    All facts share one date, so the dimensions are cut to that date first and
    joined by plain equality.
    """
    at = F.lit(day).cast("date")
    product = versions_on(products, at).select("product_id", "product_key", "category_id")
    category = versions_on(categories, at).select("category_id", "category_key")
    return (
        items.where(on_day(F.col("created_time"), day))
        .join(product, "product_id", "left")
        .join(category, "category_id", "left")
        .select("order_id", F.to_date("created_time").alias("date_key"), "product_key", "category_key", "quantity", "price_amount")
    )


def fact_order_detail_history(items: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Item facts of all days at once, by chained as-of lookups."""
    with_product = version_at(items, products, "product_id", "created_time", ["product_key", "category_id"])
    with_category = version_at(with_product, categories, "category_id", "created_time", ["category_key"])
    return with_category.select(
        "order_id", F.to_date("created_time").alias("date_key"), "product_key", "category_key", "quantity", "price_amount"
    )


def daily_transaction(fact: DataFrame, detail: DataFrame, categories: DataFrame, day: str | None = None) -> DataFrame:
    """Orders, users, items and revenue per day, status, method, category, place.

    Items are summed per order and category before the join, so the join and
    the distinct counts handle orders rather than items. An order is counted
    by its first row in a group, beside the join that brought its rows
    together, a user by the row per group and user: one shuffle of the orders,
    where two distinct counts would send each of them twice.
    """
    if day:
        fact = fact.where(F.col("date_key") == F.lit(day).cast("date"))
        # items of other days' orders go before the lookups that lie between them and here
        detail = detail.join(fact.select("order_id").distinct(), "order_id", "left_semi")
    names = categories.select("category_key", F.col("name").alias("category"))
    completed = F.col("order_status") == "completed"
    per_category = detail.groupBy("order_id", "category_key").agg(
        F.sum("quantity").alias("quantity"), F.sum("price_amount").alias("price_amount")
    )
    group = ["date_key", "order_status", "payment_method", "category", "country", "city"]
    sums = {"items_sold": "quantity", "total_revenue": "price_amount"}
    per_order = (
        fact.select("order_id", "user_key", "date_key", "order_status", "payment_method", "country", "city")
        .join(per_category, "order_id", "left")
        .join(names, "category_key", "left")
        .groupBy(*group, "order_id", "user_key")
        .agg(*[sum_if(F.col(c), completed).alias(name) for name, c in sums.items()])
    )
    kinds = {name: per_order.schema[name].dataType for name in sums}
    first = F.row_number().over(Window.partitionBy(*group, "order_id").orderBy("user_key")) == 1
    per_user = per_order.withColumn("_first", first & F.col("order_id").isNotNull()).groupBy(*group, "user_key").agg(
        F.count_if("_first").alias("total_order"), *[F.sum(name).alias(name) for name in sums]
    )
    return per_user.groupBy(*group).agg(
        F.sum("total_order").alias("total_order"), F.count("user_key").alias("total_user"),
        *[F.sum(name).cast(kinds[name]).alias(name) for name in sums],
    )


def daily_user(fact: DataFrame, users: DataFrame, day: str | None = None) -> DataFrame:
    """Active users per day and those of them created that day."""
    if day:
        fact = fact.where(F.col("date_key") == F.lit(day).cast("date"))
    joined = fact.select("date_key", "user_key").join(
        users.select("user_key", "user_id", F.to_date("created_time").alias("created")), "user_key"
    )
    return joined.groupBy("date_key").agg(
        F.count_distinct("user_id").alias("active_user"),
        count_distinct_if(F.col("user_id"), F.col("created") == F.col("date_key")).alias("new_user"),
    )


def _stored(like: DataFrame, path: str) -> DataFrame | None:
    """The table at ``path``, or nothing before the first load."""
    try:
        return like.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def store_fact(fact: DataFrame, path: str, day: str, sort: list[str]) -> None:
    """Write one day of facts into its own partition, once.

    Sorting inside the partition lets later scans skip row groups.
    """
    stored = _stored(fact, path)
    if stored is not None:
        guard_fact(stored, day)
    replace_partitions(fact.where(F.col("date_key") == F.lit(day).cast("date")), path, ["date_key"], sort)


def store_dimension(changes: DataFrame, old: DataFrame, path: str, key: str, surrogate: str, day: str) -> DataFrame:
    """Apply one day of changes and write the dimension as a new snapshot.

    ``path`` is a fresh folder; readers switch to it once it is complete, so a
    failed run leaves the previous snapshot in place.
    """
    guard_dimension(old, day)
    return materialise(scd2_apply(old, changes, key, surrogate, day), path)
