"""Shared building blocks: base joins reduced before they can fan out.

An order may have several items, reviews and payments. Joining two of those
through order_id makes all pairs, so each side is first reduced per order (and
per category or seller) and the counts are multiplied afterwards. The result is
the same number the row-by-row join gives, with at most one row per order and
group, however large a single order is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.functions.dates import month_key
from tallyport.functions.numbers import units
from tallyport.roles import Commerce


def delivered_months(c: Commerce) -> DataFrame:
    """Delivered orders as (order_id, customer_id, ym)."""
    return c.delivered_orders().select(
        "order_id", "customer_id", month_key("order_purchase_timestamp").alias("ym")
    )


def product_categories(c: Commerce) -> DataFrame:
    """(product_id, category): English name, else the original, else null."""
    return (
        c.products.select("product_id", "product_category_name")
        .join(c.translation, "product_category_name", "left")
        .select(
            "product_id",
            F.coalesce("product_category_name_english", "product_category_name").alias("category"),
        )
    )


def order_category_items(c: Commerce, wanted: DataFrame | None = None) -> DataFrame:
    """(order_id, category, item_rows, price_units) of items with a known product.

    With `wanted` (order_id) only of these orders; the others' items go no further than their scan.
    """
    items = c.order_items.select("order_id", "product_id", "price")
    return (
        (items if wanted is None else items.join(wanted, "order_id", "left_semi"))
        .join(product_categories(c), "product_id")
        .groupBy("order_id", "category")
        .agg(F.count(F.lit(1)).alias("item_rows"), F.sum(units("price")).alias("price_units"))
    )


def order_review_scores(reviews: DataFrame) -> DataFrame:
    """Per order: reviews, scored reviews, score sum, low and high score counts."""
    score = F.col("review_score")
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count(score).alias("scored"),
        F.sum(score.cast("long")).alias("score_sum"),
        F.count_if(score <= 2).alias("low"),
        F.count_if(score >= 4).alias("high"),
        F.sum(F.when(score <= 2, score.cast("long"))).alias("low_sum"),
    )


def category_review_items(c: Commerce, reviews: DataFrame, *order_columns) -> DataFrame:
    """Per order and category: item_rows beside the order's review counts.

    `order_columns` are extra columns of orders to carry along.
    """
    orders = c.orders.select("order_id", *order_columns)
    return (
        order_review_scores(reviews)
        .join(orders, "order_id")
        .join(order_category_items(c).drop("price_units"), "order_id")
    )
