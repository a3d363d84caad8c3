"""Metric queries over the monthly rollups.

Each takes a rollup frame (computed or read from storage) and returns a ranked or
filtered frame. Every top-k has the key as last sort column, so ties are stable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.functions.dates import next_month
from tallyport.functions.numbers import exact_avg, exact_sum, percent, ratio_rounded, round_half_up, units

MONTHLY = ["ym", "total_gmv", "total_orders", "avg_basket", "total_freight"]


def of_year(rollup: DataFrame, year: int | str) -> DataFrame:
    return rollup.filter(F.col("ym").startswith(str(year)))


def monthly_series(monthly: DataFrame) -> DataFrame:
    return monthly.select(*MONTHLY).orderBy("ym")


def monthly_last_n(monthly: DataFrame, n: int = 12) -> DataFrame:
    return monthly.select(*MONTHLY).orderBy(F.desc("ym")).limit(n)


def monthly_of_year(monthly: DataFrame, year: int) -> DataFrame:
    return of_year(monthly, year).select("ym", "total_gmv", "total_orders", "avg_basket").orderBy("ym")


def state_sales_of_year(states: DataFrame, year: int) -> DataFrame:
    """Customers are the sum of monthly distinct counts, as the rollup stores them."""
    return (
        of_year(states, year)
        .groupBy("customer_state")
        .agg(
            exact_sum("total_gmv").alias("total_gmv"),
            F.sum("total_orders").alias("total_orders"),
            F.sum("unique_customers").alias("unique_customers"),
        )
        .orderBy(F.desc("total_gmv"), "customer_state")
    )


def state_ranking(states: DataFrame, year: int) -> DataFrame:
    """Sales ranking of the states of a year without the customer count."""
    return (
        of_year(states, year)
        .groupBy("customer_state")
        .agg(exact_sum("total_gmv").alias("total_gmv"), F.sum("total_orders").alias("total_orders"))
        # A row per state: sorted in one task, without a sampling job and a shuffle for the order.
        .coalesce(1)
        .sortWithinPartitions(F.desc("total_gmv"), "customer_state")
    )


def top_states(states: DataFrame, year: int, n: int = 3) -> DataFrame:
    return (
        of_year(states, year)
        .groupBy(F.col("customer_state").alias("label"))
        .agg(exact_sum("total_gmv").alias("value"), F.sum("total_orders").alias("count"))
        .select(F.lit("state_sales").alias("metric"), "label", "value", "count")
        .orderBy(F.desc("value"), "label")
        .limit(n)
    )


def _delivery(delivery: DataFrame) -> DataFrame:
    # Plain mean of the monthly figures; one decimal each, so tenths add up exactly.
    return delivery.groupBy("customer_state").agg(
        exact_avg("on_time_rate", 1).alias("avg_on_time"),
        exact_avg("avg_delivery_days", 1).alias("avg_delivery_days"),
        F.sum("delayed_orders").alias("total_delayed"),
    )


def delivery_by_state(delivery: DataFrame) -> DataFrame:
    return (
        _delivery(delivery)
        .select(
            "customer_state",
            round_half_up(F.col("avg_on_time"), 1).alias("avg_on_time"),
            round_half_up(F.col("avg_delivery_days"), 1).alias("avg_delivery_days"),
            "total_delayed",
        )
        .orderBy(F.asc_nulls_first("avg_on_time"), "customer_state")
    )


def delivery_by_region_states(delivery: DataFrame, states: Sequence[str] | DataFrame) -> DataFrame:
    """Restricted to a list of states, or to the states of a frame."""
    if isinstance(states, DataFrame):
        kept = delivery.join(states.select("customer_state").distinct(), "customer_state", "left_semi")
    else:
        kept = delivery.filter(F.col("customer_state").isin(list(states)))
    return delivery_by_state(kept)


def worst_delivery_states(delivery: DataFrame, n: int = 10) -> DataFrame:
    return _delivery(delivery).orderBy(F.asc_nulls_first("avg_on_time"), "customer_state").limit(n)


def payment_popularity(payments: DataFrame) -> DataFrame:
    return (
        payments.groupBy("payment_type")
        .agg(
            F.sum("total_transactions").alias("total_orders"),
            round_half_up(exact_avg("avg_installments", 1), 1).alias("avg_installments"),
            exact_sum("total_value").alias("total_value"),
        )
        .orderBy(F.desc("total_orders"), "payment_type")
    )


def worst_seller_months(sellers: DataFrame, n: int = 20, min_orders: int = 5) -> DataFrame:
    return (
        sellers.filter(F.col("total_orders") >= min_orders)
        .select("seller_id", "seller_state", "ym", "total_gmv", "total_orders", "avg_review_score")
        .orderBy(F.asc_nulls_first("avg_review_score"), "ym", "seller_id")
        .limit(n)
    )


def scored_segments(rollup: DataFrame, segment: str, min_orders: int = 5) -> DataFrame:
    """Segments with an order-weighted review score over their months.

    Needs columns total_gmv, total_orders, avg_review_score; months without a score
    are left out, as are segments below `min_orders`.
    """
    return (
        rollup.filter(F.col("avg_review_score").isNotNull())
        .groupBy(segment)
        .agg(
            exact_sum("total_gmv").alias("total_gmv"),
            F.sum("total_orders").alias("total_orders"),
            F.sum(units("avg_review_score") * F.col("total_orders")).alias("weighted"),
            *([F.max("seller_state").alias("seller_state")] if "seller_state" in rollup.columns else []),
        )
        .filter(F.col("total_orders") >= min_orders)
        .withColumn("avg_review_score", ratio_rounded(F.col("weighted") / 100.0, F.col("total_orders"), 2))
        .drop("weighted")
    )


def worst_segments(rollup: DataFrame, segment: str, n: int = 20, min_orders: int = 5) -> DataFrame:
    return (
        scored_segments(rollup, segment, min_orders)
        .orderBy(F.asc_nulls_first("avg_review_score"), segment)
        .limit(n)
    )


def worst_sellers(sellers: DataFrame, n: int = 20, min_orders: int = 5) -> DataFrame:
    return worst_segments(sellers, "seller_id", n, min_orders).select(
        "seller_id", "seller_state", "total_gmv", "total_orders", "avg_review_score"
    )


def basket_by_state(states: DataFrame) -> DataFrame:
    return (
        states.groupBy("customer_state")
        .agg(exact_sum("total_gmv").alias("gmv"), F.sum("total_orders").alias("orders"))
        .select("customer_state", ratio_rounded(F.col("gmv"), F.col("orders"), 0).alias("avg_basket"))
        .orderBy(F.desc("avg_basket"), "customer_state")
    )


def top_categories(categories: DataFrame, n: int = 15) -> DataFrame:
    return (
        categories.groupBy(F.col("product_category_english").alias("category"))
        .agg(exact_sum("total_gmv").alias("total_gmv"), F.sum("total_orders").alias("total_orders"))
        .orderBy(F.desc("total_gmv"), "category")
        .limit(n)
    )


def geo_state_gmv(states: DataFrame) -> DataFrame:
    return (
        states.groupBy("customer_state")
        .agg(exact_sum("total_gmv").alias("total_gmv"))
        .orderBy("customer_state")
    )


def kpi_overview(monthly: DataFrame) -> DataFrame:
    """Basket is the plain mean of the months, not weighted by orders."""
    return monthly.agg(
        F.sum("total_orders").alias("total_orders"),
        round_half_up(exact_sum("total_gmv"), 0).alias("total_gmv"),
        round_half_up(exact_avg("avg_basket"), 0).alias("avg_basket"),
    )


def growth(series: DataFrame, key: str | None = None, value: str = "total_gmv") -> DataFrame:
    """Change against the previous calendar month, per series.

    Every month also reports its value to the following one, so one aggregation
    pairs neighbours; no window over a whole series is needed.
    """
    keys = [key] if key else []
    pair = F.inline(
        F.array(
            F.struct(F.col("ym").alias("month"), F.col(value).alias("now"), F.lit(None).cast("double").alias("before")),
            F.struct(next_month("ym").alias("month"), F.lit(None).cast("double").alias("now"), F.col(value).alias("before")),
        )
    )
    return (
        series.select(*keys, pair)
        .groupBy(*keys, F.col("month").alias("ym"))
        .agg(F.max("now").alias(value), F.max("before").alias("previous"))
        .filter(F.col(value).isNotNull())
        .select(
            *keys, "ym", value, "previous",
            percent(F.col(value) - F.col("previous"), F.col("previous"), 2).alias("growth_pct"),
        )
        .orderBy(*keys, "ym")
    )


def category_trends(categories: DataFrame, min_months: int = 3, only_declining: bool = True) -> DataFrame:
    """Linear GMV trend per category, falling ones first; by default only those."""
    months = F.expr("cast(substr(ym, 1, 4) as int) * 12 + cast(substr(ym, 6, 2) as int)")
    trends = (
        categories.filter(F.col("product_category_english").isNotNull())
        .select(F.col("product_category_english").alias("category"), months.alias("x"), "ym", "total_gmv")
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.regr_slope("total_gmv", "x").alias("slope"),
            F.max_by("total_gmv", "ym").alias("last_gmv"),
        )
        .filter(F.col("months") >= min_months)
    )
    return (
        (trends.filter("slope < 0") if only_declining else trends)
        .select(
            "category", "months", round_half_up(F.col("slope"), 2).alias("gmv_slope_per_month"), "last_gmv",
            (F.col("slope") < 0).alias("declining"),
        )
        .orderBy("gmv_slope_per_month", "category")
    )
