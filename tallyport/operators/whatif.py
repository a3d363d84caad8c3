"""What-if: how the average review score changes when a segment is removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.functions.numbers import fixed_text, from_units, percent, ratio, round_half_up, units
from tallyport.operators.facts import order_category_items, order_review_scores
from tallyport.operators.metrics import worst_segments
from tallyport.roles import Commerce
from tallyport.sources.staging import Keep, in_place


def what_if_remove(
    reviews: DataFrame, touched_orders: DataFrame, removed: DataFrame, rollup: DataFrame
) -> DataFrame:
    """One row comparing all reviews with those of orders the segment never touched.

    touched_orders: order_id of every order with an item of a removed segment.
    removed:        the removed segments with total_gmv and total_orders.
    rollup:         the rollup they come from, for the platform totals.
    """
    score = F.col("review_score").cast("long")
    scored = reviews.filter(F.col("review_score").isNotNull())
    # One pass: mark the reviews that would go and sum both groups side by side.
    marked = scored.join(
        touched_orders.select("order_id").distinct().withColumn("goes", F.lit(True)), "order_id", "left"
    )
    stays = F.col("goes").isNull()
    removed_totals = removed.agg(
        F.struct(
            F.count(F.lit(1)).alias("segments"),
            F.coalesce(F.sum(units("total_gmv")), F.lit(0)).alias("gmv"),
            F.coalesce(F.sum("total_orders"), F.lit(0)).alias("orders"),
        )
    ).scalar()
    platform = rollup.agg(
        F.struct(F.sum(units("total_gmv")).alias("gmv"), F.sum("total_orders").alias("orders"))
    ).scalar()
    sums = (
        marked.agg(
            F.sum(score).alias("score"),
            F.count(F.lit(1)).alias("reviews"),
            F.sum(F.when(stays, score)).alias("kept_score"),
            F.count_if(stays).alias("kept_reviews"),
        )
        .withColumn("removed", removed_totals)
        .withColumn("platform", platform)
        .withColumn("current", ratio(F.col("score"), F.col("reviews")))
        .withColumn("new", F.coalesce(ratio(F.col("kept_score"), F.col("kept_reviews")), F.col("current")))
    )
    gain = F.col("new") - F.col("current")
    return sums.select(
        round_half_up(F.col("current"), 3).alias("current_avg_score"),
        round_half_up(F.col("new"), 3).alias("new_avg_score"),
        round_half_up(gain, 3).alias("improvement"),
        F.coalesce(percent(gain, F.col("current")), F.lit(0.0)).alias("improvement_pct"),
        F.col("removed.segments").alias("removed_count"),
        F.col("reviews").alias("current_reviews_count"),
        F.col("kept_reviews").alias("remaining_reviews_count"),
        from_units("removed.gmv").alias("impacted_gmv"),
        F.col("removed.orders").alias("impacted_orders"),
        F.coalesce(percent(F.col("removed.gmv"), F.col("platform.gmv"), 2), F.lit(0.0)).alias(
            "impacted_gmv_share_pct"
        ),
        F.coalesce(percent(F.col("removed.orders"), F.col("platform.orders"), 2), F.lit(0.0)).alias(
            "impacted_order_share_pct"
        ),
    )


def remove_worst_sellers(c: Commerce, seller_rollup: DataFrame, n: int = 20, keep: Keep = in_place) -> DataFrame:
    """Remove the n worst rated sellers and every review their orders received.

    `seller_rollup` is read more than once, so it should be a stored rollup; `keep` may
    write the n worst ones (see Staging).
    """
    worst = keep(worst_segments(seller_rollup, "seller_id", n), "worst_sellers")
    touched = c.order_items.select("order_id", "seller_id").join(worst.select("seller_id"), "seller_id", "left_semi")
    return what_if_remove(c.order_reviews, touched, worst, seller_rollup)


def category_scores(c: Commerce) -> DataFrame:
    """Per category: GMV, orders and mean review score, each sale counted once."""
    orders = c.delivered_orders().select("order_id")
    return (
        order_category_items(c)
        .filter(F.col("category").isNotNull())
        .join(orders, "order_id")
        .join(order_review_scores(c.order_reviews).select("order_id", "scored", "score_sum"), "order_id", "left")
        .groupBy("category")
        .agg(
            from_units(F.sum("price_units")).alias("total_gmv"),
            F.count(F.lit(1)).alias("total_orders"),
            round_half_up(ratio(F.sum("score_sum"), F.sum("scored")), 2).alias("avg_review_score"),
        )
    )


def remove_worst_categories(c: Commerce, n: int = 2, keep: Keep = in_place) -> DataFrame:
    """The same question for product categories; `keep` may write what is read several times (see Staging)."""
    scores = keep(category_scores(c), "category_scores")
    worst = keep(worst_segments(scores, "category", n), "worst_categories")
    touched = order_category_items(c).join(worst.select("category"), "category", "left_semi")
    return what_if_remove(c.order_reviews, touched, worst, scores)


def what_if_sentence(comparison: DataFrame) -> DataFrame:
    """The comparison row of `what_if_remove` as one sentence."""
    return comparison.select(
        F.concat(
            F.lit("What-if: removing/screening the worst "), F.col("removed_count").cast("string"),
            F.lit(" sellers changes average review score from "), fixed_text(F.col("current_avg_score"), 3),
            F.lit(" to "), fixed_text(F.col("new_avg_score"), 3),
            F.lit(" ("), fixed_text(F.col("improvement_pct"), 1), F.lit("%)."),
        ).alias("summary")
    )
