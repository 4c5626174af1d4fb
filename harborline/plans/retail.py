"""Retail star schema: staging, product and country dimensions, sales facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.functions.security import md5_key

SEED_DATE_LAYOUT = "M/d/yyyy"  # fixed value


def stage_sales(sales: DataFrame) -> DataFrame:
    """Text dates of the seed file become timestamps."""
    parse = lambda c: F.try_to_timestamp(F.col(c), F.lit(SEED_DATE_LAYOUT)).cast("timestamp_ntz").alias(c)
    return sales.select(
        parse("order_date"), parse("stock_date"), "order_number", "product_key", "customer_key", "territory_key", "order_quantity"
    )


def dim_product(products: DataFrame, subcategories: DataFrame, categories: DataFrame) -> DataFrame:
    return (
        products.join(subcategories, "product_subcategory_key", "left")
        .join(categories, "product_category_key", "left")
        .select(
            md5_key(F.col("product_key")).alias("product_key"),
            "product_name", "product_sku", "product_color", "subcategory_name", "category_name",
        )
    )


def dim_country(territories: DataFrame) -> DataFrame:
    return territories.select(md5_key(F.col("country")).alias("country_key"), "country", "continent").distinct()


def fact_sale(sales: DataFrame, products: DataFrame, territories: DataFrame) -> DataFrame:
    revenue = F.col("order_quantity") * F.col("product_price")
    cost = F.col("order_quantity") * F.col("product_cost")
    return (
        sales.join(products.select("product_key", "product_price", "product_cost"), "product_key", "left")
        .join(territories.select(F.col("sales_territory_key").alias("territory_key"), "country"), "territory_key", "left")
        .select(
            "order_date", "order_number",
            md5_key(F.col("product_key")).alias("product_key"),
            md5_key(F.col("country")).alias("country_key"),
            revenue.alias("revenue"), cost.alias("cost"), (revenue - cost).alias("profit"),
        )
    )
