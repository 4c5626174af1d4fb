"""Live marts over the bronze tables of the shop.

Every mart works on the latest version of each row. ``day`` restricts a mart to
one local day; without it the mart is reported for every day at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions.dates import hours_crossed, on_day, within
from harborline.operators.aggregates import share_pct
from harborline.operators.latest import latest_by_key
from harborline.streaming.jobs import bursts

ITEM_ORDER = ["updated_at", "product_id", "quantity", "price"]
ORDER_ORDER = ["updated_at", "order_status"]
PAYMENT_ORDER = ["updated_at", "status", "amount"]


def latest_orders(orders: DataFrame) -> DataFrame:
    return latest_by_key(orders, ["order_id"], ORDER_ORDER)


def latest_items(items: DataFrame) -> DataFrame:
    return latest_by_key(items, ["order_item_id"], ITEM_ORDER)


def _value() -> Column:
    return (F.col("price") * F.col("quantity")).cast("decimal(22,2)")


def completed_items(orders: DataFrame, items: DataFrame, day: str | None = None) -> DataFrame:
    """Items of completed orders; the day applies after deduplication."""
    done = latest_orders(orders).where(F.col("order_status") == "completed")
    if day:
        done = done.where(on_day(F.col("updated_at"), day))
    done = done.select("order_id", "user_id", "created_at", F.to_date("updated_at").alias("day"))
    sold = latest_items(items).select("order_id", "product_id", "quantity", _value().alias("value"))
    return done.join(sold, "order_id")


def order_revenue(orders: DataFrame, items: DataFrame, day: str | None = None) -> DataFrame:
    """Orders, items and revenue per hour of creation."""
    return (
        completed_items(orders, items, day)
        .groupBy("day", F.hour("created_at").alias("hour"))
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            F.sum("quantity").alias("items_sold"),
            F.sum("value").alias("revenue"),
        )
    )


def unique_users(orders: DataFrame, day: str | None = None) -> DataFrame:
    latest = latest_orders(orders)
    if day:
        latest = latest.where(on_day(F.col("updated_at"), day))
    return latest.groupBy(F.to_date("updated_at").alias("day")).agg(
        F.count_distinct("user_id").alias("active_users"), F.count(F.lit(1)).alias("total_orders")
    )


def top_products(orders: DataFrame, items: DataFrame, products: DataFrame, day: str | None = None, limit: int = 10, dedup_products: bool = True) -> DataFrame:
    """Best-selling products by revenue, ties by name.

    Sales are summed per product before the product name is looked up. Raw
    product versions would count a sale once per version, so they are reduced
    to the latest unless ``dedup_products`` is off.
    """
    per_product = (
        completed_items(orders, items, day)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("q"), F.sum("value").alias("v"))
    )
    names = latest_by_key(products, ["product_id"], ["updated_at"]) if dedup_products else products
    return (
        per_product.join(names.select("product_id", "name"), "product_id")
        .groupBy("name")
        .agg(F.sum("q").alias("total_quantity"), F.sum("v").alias("revenue"))
        .orderBy(F.desc("revenue"), "name")
        .limit(limit)
    )


def payment_failures(payments: DataFrame, day: str | None = None) -> DataFrame:
    """Failure rate of the last payment of each order."""
    last = latest_by_key(payments, ["order_id"], [*PAYMENT_ORDER, "payment_id"])
    if day:
        last = last.where(on_day(F.col("payment_date"), day))
    failed = F.col("status") == "failed"
    return last.groupBy(F.to_date("payment_date").alias("day")).agg(
        F.count_if(failed).alias("failed"), F.count(F.lit(1)).alias("total"), share_pct(failed).alias("failed_rate")
    )


def abnormal_orders(orders: DataFrame, items: DataFrame, as_of: Column, interval: str = "15 MINUTES", above: float = 400) -> DataFrame:
    """Users who recently ordered for more than a threshold."""
    recent = latest_orders(orders).where(within(F.col("created_at"), as_of, interval)).select("order_id", "user_id")
    return (
        recent.join(latest_items(items).select("order_id", _value().alias("value")), "order_id")
        .groupBy("user_id")
        .agg(F.sum("value").alias("total_order_value"))
        .where(F.col("total_order_value") > above)
    )


def abnormal_payments(payments: DataFrame, orders: DataFrame, at_least: int = 3) -> DataFrame:
    """Users with repeated failed payments in five minutes."""
    failed = latest_by_key(payments, ["payment_id"], PAYMENT_ORDER).where(F.col("status") == "failed")
    users = latest_orders(orders).select("order_id", "user_id")
    joined = failed.select("order_id", "payment_date").join(users, "order_id", "left")
    return bursts(joined, "user_id", "payment_date", F.lit(True), at_least)


def stale_orders(orders: DataFrame, as_of: Column, more_than: int = 1) -> DataFrame:
    """Orders still in their first state for more than some hours."""
    hours = hours_crossed(F.col("created_at"), as_of)
    return (
        latest_orders(orders)
        .where(F.col("order_status") == "created")
        .select("order_id", "created_at", as_of.alias("as_of"), hours.alias("hours_since_order"))
        .where(F.col("hours_since_order") > more_than)
        .orderBy(F.desc("hours_since_order"), "order_id")
    )


def register_marts(orders: DataFrame, items: DataFrame, products: DataFrame, payments: DataFrame, as_of: Column, day: str) -> list[str]:
    """Register the seven marts of one day as temporary views."""
    marts = {
        "order_revenue": order_revenue(orders, items, day),
        "unique_user": unique_users(orders, day),
        "top_selling_product": top_products(orders, items, products, day),
        "payment_failure_rate": payment_failures(payments, day),
        "abnormal_order": abnormal_orders(orders, items, as_of),
        "abnormal_payment": abnormal_payments(payments, orders),
        "order_created_abnormal": stale_orders(orders, as_of),
    }
    for name, mart in marts.items():
        mart.createOrReplaceTempView(name)
    return list(marts)
