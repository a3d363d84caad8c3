"""Anomaly checks on monthly series: outlier months, falling states and categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyport.functions.dates import month_key
from tallyport.functions.numbers import fixed_text, from_units, ratio, round_half_up, units
from tallyport.operators.facts import category_review_items
from tallyport.roles import Commerce

# Hints of the three alert types.
GMV_HINT = "Check campaign, seasonality, data completeness, and category/state contributors for this month."
STATE_HINT = "Inspect recent orders, seller availability, delivery delays, and marketing exposure in this state."
SCORE_HINT = "Review recent complaints, sellers, delivery issues, and product quality for this category."

ALERT_COLUMNS = {
    "type": "string", "severity": "string", "ym": "string", "state": "string", "category": "string",
    "value": "double", "z_score": "double", "direction": "string", "recent_gmv": "double",
    "avg_gmv": "double", "drop_pct": "double", "recent_score": "double", "historical_avg": "double",
    "drop": "double", "detail": "string", "action_hint": "string",
}


def monthly_gmv_outliers(monthly: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Months whose GMV lies more than `threshold` sample deviations off the mean."""
    # One series with one row per calendar month, so the window stays small.
    series = Window.partitionBy(F.lit("platform"))
    deviation = F.stddev_samp("total_gmv").over(series)
    z = F.when(deviation > 0, (F.col("total_gmv") - F.avg("total_gmv").over(series)) / deviation).otherwise(0.0)
    above = F.col("z") > 0
    return (
        monthly.select("ym", "total_gmv", z.alias("z"))
        .filter(F.abs("z") > threshold)
        .select(
            F.lit("gmv_anomaly").alias("type"),
            F.when(F.abs("z") >= 3, "high").otherwise("medium").alias("severity"),
            "ym",
            F.col("total_gmv").alias("value"),
            round_half_up(F.col("z"), 2).alias("z_score"),
            F.when(above, "high").otherwise("low").alias("direction"),
            F.concat(
                F.lit("Month "), "ym", F.lit(" GMV is "), fixed_text(F.abs("z"), 1),
                F.lit(" std deviations "), F.when(above, "above").otherwise("below"), F.lit(" mean."),
            ).alias("detail"),
            F.lit(GMV_HINT).alias("action_hint"),
        )
    )


def state_sales_drops(states: DataFrame, threshold_pct: float = 30.0, min_months: int = 3) -> DataFrame:
    """States whose own last month fell below the mean of their earlier months."""
    gmv = units("total_gmv")
    per_state = (
        states.groupBy("customer_state")
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.max("ym").alias("ym"),
            F.max_by(gmv, "ym").alias("last"),
            F.sum(gmv).alias("total"),
        )
        .filter(F.col("customer_state").isNotNull() & (F.col("months") >= min_months))
        .withColumn("recent", from_units("last"))
        .withColumn("earlier", ratio(from_units(F.col("total") - F.col("last")), F.col("months") - 1))
        .filter("earlier > 0")
        .withColumn("fall", (F.col("earlier") - F.col("recent")) / F.col("earlier") * 100)
    )
    return per_state.filter(F.col("fall") > threshold_pct).select(
        F.lit("state_sales_drop").alias("type"),
        F.when(F.col("fall") >= 50, "high").otherwise("medium").alias("severity"),
        F.col("customer_state").alias("state"),
        "ym",
        F.col("recent").alias("recent_gmv"),
        round_half_up(F.col("earlier"), 2).alias("avg_gmv"),
        round_half_up(F.col("fall"), 1).alias("drop_pct"),
        F.concat(
            F.lit("State "), "customer_state", F.lit(" GMV dropped "),
            F.round(F.col("fall").cast("decimal(38,10)"), 0).cast("long").cast("string"),
            F.lit("% in "), "ym", F.lit(" compared to its historical average."),
        ).alias("detail"),
        F.lit(STATE_HINT).alias("action_hint"),
    )


def category_month_scores(c: Commerce, min_reviews: int = 10) -> DataFrame:
    """Mean review score per category and order month, for months with enough reviews."""
    rows = category_review_items(
        c, c.order_reviews, month_key("order_purchase_timestamp").alias("ym")
    )
    return (
        rows.groupBy("category", "ym")
        .agg(
            F.sum(F.col("score_sum") * F.col("item_rows")).alias("score"),
            F.sum(F.col("scored") * F.col("item_rows")).alias("scored"),
            F.sum(F.col("reviews") * F.col("item_rows")).alias("review_count"),
        )
        .filter(F.col("review_count") >= min_reviews)
        .select("category", "ym", ratio(F.col("score"), F.col("scored")).alias("avg_score"), "review_count")
    )


def review_score_drops(scores: DataFrame, threshold: float = 0.5, min_months: int = 3) -> DataFrame:
    """Categories whose last month scores lower than the mean of the earlier months."""
    own = Window.partitionBy("category")
    per_category = (
        scores.filter(F.col("category").isNotNull())
        .withColumn("last_ym", F.max("ym").over(own))
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.max("ym").alias("ym"),
            F.max_by("avg_score", "ym").alias("recent"),
            F.avg(F.when(F.col("ym") < F.col("last_ym"), F.col("avg_score"))).alias("earlier"),
        )
        .filter(F.col("months") >= min_months)
        .withColumn("fall", F.col("earlier") - F.col("recent"))
    )
    return per_category.filter(F.col("fall") > threshold).select(
        F.lit("review_score_drop").alias("type"),
        F.when(F.col("fall") >= 1.0, "high").otherwise("medium").alias("severity"),
        "category",
        "ym",
        round_half_up(F.col("recent"), 2).alias("recent_score"),
        round_half_up(F.col("earlier"), 2).alias("historical_avg"),
        round_half_up(F.col("fall"), 2).alias("drop"),
        F.concat(
            F.lit("Category '"), "category", F.lit("' review score dropped by "), fixed_text(F.col("fall"), 1),
            F.lit(" in "), "ym", F.lit("."),
        ).alias("detail"),
        F.lit(SCORE_HINT).alias("action_hint"),
    )


def all_alerts(*alerts: DataFrame) -> DataFrame:
    """Alerts of several checks in one long frame; absent figures are null."""
    merged = alerts[0]
    for other in alerts[1:]:
        merged = merged.unionByName(other, allowMissingColumns=True)
    present = set(merged.columns)
    return merged.select(
        *[(F.col(n) if n in present else F.lit(None).cast(t)).alias(n) for n, t in ALERT_COLUMNS.items()]
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    count = F.col("alert_count")
    return alerts.agg(
        F.count(F.lit(1)).alias("alert_count"),
        # Three alert types exist, so the set stays tiny.
        F.array_join(F.sort_array(F.collect_set("type")), ",").alias("alert_types"),
    ).select(
        "alert_count",
        "alert_types",
        F.when(
            count > 0,
            F.concat(
                F.lit("Detected "), count.cast("string"),
                F.lit(" anomalies across sales, state performance, and review scores."),
            ),
        )
        .otherwise("No significant anomalies detected. All metrics within normal range.")
        .alias("summary"),
    )
