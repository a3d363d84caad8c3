"""Diagnostic queries on the base tables and the data behind the charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyport.functions.dates import days_between
from tallyport.functions.numbers import from_units, percent, ratio, ratio_rounded, round_half_up, units
from tallyport.operators.facts import (
    category_review_items,
    order_category_items,
    order_review_scores,
    product_categories,
)
from tallyport.operators.quantiles import exact_percentile
from tallyport.roles import Commerce
from tallyport.sources.staging import Keep, in_place

DONE, DUE, BOUGHT = (
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "order_purchase_timestamp",
)


def delivery_routes(c: Commerce, min_orders: int = 20, n: int = 30) -> DataFrame:
    """Slowest customer-state / seller-state routes.

    Days and on-time share are per item, the order count is per order.
    """
    orders = (
        c.delivered_orders()
        .filter(F.col(DONE).isNotNull() & F.col(DUE).isNotNull())
        .select(
            "order_id", "customer_id",
            days_between(DONE, BOUGHT).cast("long").alias("days"),
            (F.col(DONE) <= F.col(DUE)).alias("on_time"),
        )
        .join(c.customers.select("customer_id", "customer_state"), "customer_id")
        .drop("customer_id")
    )
    items = c.order_items.select("order_id", "seller_id").join(
        c.sellers.select("seller_id", "seller_state"), "seller_id"
    )
    legs = (
        items.join(orders, "order_id")
        .groupBy("order_id", "customer_state", "seller_state", "days", "on_time")
        .agg(F.count(F.lit(1)).alias("items"))
    )
    routes = (
        legs.groupBy("customer_state", "seller_state")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("items").alias("items"),
            F.sum(F.col("days") * F.col("items")).alias("days"),
            F.sum(F.when(F.col("on_time"), F.col("items")).otherwise(0)).alias("on_time"),
        )
        .filter(F.col("total_orders") >= min_orders)
    )
    same = F.col("customer_state") == F.col("seller_state")
    return (
        routes.select(
            "customer_state",
            "seller_state",
            F.when(same, "same_state").otherwise("cross_state").alias("route_type"),
            F.concat("seller_state", F.lit(" to "), "customer_state").alias("route"),
            "total_orders",
            ratio_rounded(F.col("days"), F.col("items"), 1).alias("avg_delivery_days"),
            percent(F.col("on_time"), F.col("items")).alias("on_time_rate"),
            (F.col("items") - F.col("on_time")).alias("delayed_orders"),
        )
        .orderBy(F.desc("avg_delivery_days"), "customer_state", "seller_state")
        .limit(n)
    )


def _below(rows: DataFrame, column: str, bound: float | None) -> DataFrame:
    return rows.filter(F.col(column).isNotNull() if bound is None else F.col(column) < bound)


def _weight_bins(c: Commerce, max_weight: float | None, max_freight: float | None) -> DataFrame:
    return (
        _below(c.order_items, "freight_value", max_freight)
        .select("order_id", "product_id", F.round("freight_value", 0).alias("freight"))
        .join(
            _below(c.products, "product_weight_g", max_weight).select(
                "product_id", F.round("product_weight_g", -2).alias("weight_g")
            ),
            "product_id",
        )
    )


def weight_freight_bins(
    c: Commerce, max_weight: float | None = None, max_freight: float | None = None, min_rows: int = 2
) -> DataFrame:
    """Item counts per weight (100 g) and freight (1 unit) bin; all bins unless bounds are given."""
    return (
        _weight_bins(c, max_weight, max_freight)
        .groupBy("weight_g", "freight")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .filter(F.col("cnt") >= min_rows)
    )


def weight_freight_ontime(
    c: Commerce, max_weight: float | None = None, max_freight: float | None = None, min_rows: int = 2
) -> DataFrame:
    """The same bins with their on-time share; a missing date counts as late."""
    orders = c.orders.select(
        "order_id", F.coalesce(F.col(DONE) <= F.col(DUE), F.lit(False)).alias("on_time")
    )
    return (
        _weight_bins(c, max_weight, max_freight)
        .join(orders, "order_id")
        .groupBy(F.col("weight_g").alias("product_weight_g"), F.col("freight").alias("freight_value"))
        .agg(F.count(F.lit(1)).alias("order_count"), F.count_if("on_time").alias("on_time"))
        .filter(F.col("order_count") >= min_rows)
        .select(
            "product_weight_g", "freight_value", "order_count",
            ratio(F.col("on_time"), F.col("order_count")).alias("on_time_rate"),
        )
    )


def negative_categories(c: Commerce, reviews: DataFrame | None = None, min_reviews: int = 10, n: int = 10) -> DataFrame:
    """Categories with most reviews of two stars or less, counted per item."""
    rows = category_review_items(c, c.order_reviews if reviews is None else reviews)
    return (
        rows.groupBy("category")
        .agg(
            F.sum(F.col("low") * F.col("item_rows")).alias("negative_reviews"),
            F.sum(F.col("low_sum") * F.col("item_rows")).alias("score"),
        )
        .filter(F.col("negative_reviews") >= min_reviews)
        .select(
            "category",
            ratio_rounded(F.col("score"), F.col("negative_reviews"), 2).alias("avg_score"),
            "negative_reviews",
        )
        .orderBy(F.desc("negative_reviews"), "category")
        .limit(n)
    )


def category_reviews(c: Commerce) -> DataFrame:
    rows = category_review_items(c, c.order_reviews)
    return (
        rows.groupBy("category")
        .agg(
            F.sum(F.col("score_sum") * F.col("item_rows")).alias("score"),
            F.sum(F.col("scored") * F.col("item_rows")).alias("scored"),
            F.sum(F.col("reviews") * F.col("item_rows")).alias("review_count"),
            F.sum(F.col("low") * F.col("item_rows")).alias("negative_count"),
            F.sum(F.col("high") * F.col("item_rows")).alias("positive_count"),
        )
        .select(
            "category",
            ratio_rounded(F.col("score"), F.col("scored"), 2).alias("avg_score"),
            "review_count", "negative_count", "positive_count",
        )
        .orderBy(F.desc("review_count"), "category")
    )


def installment_share(c: Commerce, low: int | None = None, high: int | None = None) -> DataFrame:
    """Share of each installment count within its payment type; of all counts unless bounds are given."""
    # The window runs over aggregated rows, one per type and installment count.
    within = Window.partitionBy("payment_type")
    count = F.col("payment_installments")
    wanted = count.isNotNull()
    wanted = wanted if low is None else wanted & (count >= low)
    wanted = wanted if high is None else wanted & (count <= high)
    return (
        c.payments.filter(wanted)
        .groupBy("payment_type", "payment_installments")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "payment_type", "payment_installments", "n",
            percent(F.col("n"), F.sum("n").over(within)).alias("share_pct"),
        )
    )


def pivot_sum(rows: DataFrame, row_key: str, column_key: str, value: str, columns: Sequence) -> DataFrame:
    """Matrix of sums with the given column values."""
    return rows.groupBy(row_key).pivot(column_key, list(columns)).agg(F.sum(value))


def installment_matrix(c: Commerce, low: int = 1, high: int = 12) -> DataFrame:
    """Shares by type, a column for each count from `low` to `high`, inst_other for all counts outside.

    Columns must be named before the data are read, so the bounds are arguments; the
    shares are of all payments.
    """
    share = installment_share(c)
    inside = F.col("payment_installments").between(low, high)
    column = F.when(inside, F.col("payment_installments").cast("string")).otherwise("other")
    wide = pivot_sum(
        share.withColumn("column", column), "payment_type", "column", "share_pct", [*map(str, range(low, high + 1)), "other"]
    )
    names = [*range(low, high + 1), "other"]
    return wide.select("payment_type", *[F.col(str(i)).alias(f"inst_{i}") for i in names])


def state_centroids(c: Commerce, values: DataFrame, state: str = "customer_state") -> DataFrame:
    """Attach the mean coordinates of each state; states without any are dropped."""
    points = c.geolocation.groupBy(F.col("geolocation_state").alias(state)).agg(
        F.avg("geolocation_lat").alias("lat"), F.avg("geolocation_lng").alias("lng")
    )
    return values.join(points, state, "left").dropna(subset=["lat"])


def state_ranking_base(c: Commerce, year: int) -> DataFrame:
    """State ranking of a year from the base tables, by a time range.

    The year selects few orders, so they are joined before items are summed: items
    of other years never get into an aggregation, and the selected orders are
    broadcast when they are small.
    """
    bought = F.col(BOUGHT)
    orders = (
        c.delivered_orders()
        .filter((bought >= F.lit(f"{year}-01-01")) & (bought < F.lit(f"{year + 1}-01-01")))
        .select("order_id", "customer_id")
    )
    return (
        c.order_items.select("order_id", "price")
        .join(orders, "order_id")
        .groupBy("order_id", "customer_id")
        .agg(F.sum(units("price")).alias("price_units"))
        .join(c.customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(from_units(F.sum("price_units")).alias("total_gmv"), F.count(F.lit(1)).alias("total_orders"))
        .orderBy(F.desc("total_gmv"), "customer_state")
    )


def platform_score(reviews: DataFrame) -> DataFrame:
    score = F.col("review_score")
    return (
        reviews.filter(score.isNotNull())
        .agg(
            F.sum(score.cast("long")).alias("score"),
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("review_id").alias("review_count"),
        )
        .select(ratio(F.col("score"), F.col("n")).alias("avg_score"), "review_count")
    )


def worst_example_per_category(c: Commerce, reviews: DataFrame, n: int = 10, keep: Keep = in_place) -> DataFrame:
    """The n lowest rated categories, each with its worst review as an example.

    `keep` may write the n picked rows, which are read twice (see Staging).
    """
    stats = (
        category_review_items(c, reviews)
        .groupBy("category")
        .agg(
            F.sum(F.col("score_sum") * F.col("item_rows")).alias("score"),
            F.sum(F.col("scored") * F.col("item_rows")).alias("scored"),
            F.sum("reviews").alias("total_reviews"),
            F.sum(F.col("low") * F.col("item_rows")).alias("bad_reviews"),
            F.count(F.lit(1)).alias("total_orders"),
        )
        .withColumn("exact_score", ratio(F.col("score"), F.col("scored")))
        .orderBy(F.asc_nulls_first("exact_score"), "category")
        .limit(n)
    )
    # Rank keys without their text; only the winners fetch it.
    order = Window.partitionBy("category").orderBy(
        "review_score", F.desc_nulls_last("review_answer_timestamp"), "review_id"
    )
    low = reviews.filter(F.col("review_score") <= 2)
    winners = (
        low.select("review_id", "order_id", "review_score", "review_answer_timestamp")
        .join(c.orders.select("order_id"), "order_id", "left_semi")
        .join(order_category_items(c).select("order_id", "category"), "order_id")
        .withColumn("rank", F.row_number().over(order))
        .filter("rank = 1")
        .select("category", "review_id")
    )
    picked = keep(stats.join(winners, "category", "left"), "worst_categories")
    # `picked` has at most n rows, so it may be broadcast and the texts stay in place.
    examples = low.select("review_id", F.col("review_comment_message").alias("example")).join(
        F.broadcast(picked.select("review_id").distinct()), "review_id"
    )
    return picked.join(examples, "review_id", "left").select(
        "category",
        round_half_up(F.col("exact_score"), 2).alias("avg_review_score"),
        "total_reviews",
        "bad_reviews",
        percent(F.col("bad_reviews"), F.col("total_reviews")).alias("bad_review_pct"),
        "total_orders",
        F.coalesce("example", F.lit("N/A")).alias("example_bad_comment"),
    )


def order_detail(c: Commerce, wanted: DataFrame) -> DataFrame:
    """All items of the wanted orders with product, seller and customer."""
    orders = c.orders.join(wanted.select("order_id").distinct(), "order_id", "left_semi")
    return (
        orders.select("order_id", "customer_id", "order_status", BOUGHT)
        .join(c.order_items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"), "order_id")
        .join(product_categories(c), "product_id")
        .join(c.sellers.select("seller_id", "seller_state"), "seller_id")
        .join(c.customers.select("customer_id", "customer_state"), "customer_id")
        .select(
            "order_id", "order_item_id", "order_status", F.date_format(BOUGHT, "yyyy-MM-dd HH:mm:ss").alias("bought_at"),
            "customer_state", "seller_state", "category", "price", "freight_value",
        )
    )


def slow_states(c: Commerce) -> DataFrame:
    """States whose mean delivery time lies above the national mean."""
    per_state = (
        c.delivered_orders()
        .filter(F.col(DONE).isNotNull())
        .select("customer_id", days_between(DONE, BOUGHT).cast("long").alias("days"))
        .join(c.customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(F.sum("days").alias("days"), F.count(F.lit(1)).alias("orders"))
    )
    # One row per state: the national mean comes from the same few rows.
    nation = Window.partitionBy(F.lit(0))
    return (
        per_state.withColumn("state_mean", ratio(F.col("days"), F.col("orders")))
        .withColumn("national_mean", ratio(F.sum("days").over(nation), F.sum("orders").over(nation)))
        .filter(F.col("state_mean") > F.col("national_mean"))
        .select(
            "customer_state", "orders",
            round_half_up(F.col("state_mean"), 2).alias("avg_delivery_days"),
            round_half_up(F.col("national_mean"), 2).alias("national_avg_days"),
        )
        .orderBy(F.desc("avg_delivery_days"), "customer_state")
    )


def seller_negative_rate(c: Commerce, min_reviews: int = 1) -> DataFrame:
    """Share of low reviews over all reviews of the orders a seller took part in."""
    scores = order_review_scores(c.order_reviews).select("order_id", "scored", "low")
    return (
        c.order_items.select("order_id", "seller_id")
        .distinct()
        .join(scores, "order_id")
        .groupBy("seller_id")
        .agg(F.sum("scored").alias("reviews"), F.sum("low").alias("negative_reviews"))
        .filter(F.col("reviews") >= min_reviews)
        .join(c.sellers.select("seller_id", "seller_state"), "seller_id")
        .select(
            "seller_id", "seller_state", "reviews", "negative_reviews",
            percent(F.col("negative_reviews"), F.col("reviews"), 2).alias("negative_pct"),
        )
    )


def weight_freight_corr(c: Commerce) -> DataFrame:
    """Correlation of freight with product weight and volume over all items."""
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    rows = c.order_items.select("product_id", "freight_value").join(
        c.products.select("product_id", "product_weight_g", volume.alias("volume")), "product_id"
    )
    return rows.agg(
        F.count(F.lit(1)).alias("items"),
        round_half_up(F.corr("product_weight_g", "freight_value"), 6).alias("weight_freight_corr"),
        round_half_up(F.corr("volume", "freight_value"), 6).alias("volume_freight_corr"),
    )


def trim_p95(points: DataFrame, x: str, y: str, min_points: int = 10) -> DataFrame:
    """Drop points above the 95th percentile of either axis.

    Needs more than `min_points` points, and falls back to all of them when fewer
    than `min_points` would stay. `points` are aggregated chart points; the percentiles
    are exact, found in rounds of bounded memory.
    """
    limit_x, limit_y = exact_percentile(points, x, 0.95), exact_percentile(points, y, 0.95)
    n = points.count()
    if limit_x is None or limit_y is None:
        return points
    inside = (F.col(x) <= F.lit(limit_x)) & (F.col(y) <= F.lit(limit_y))
    kept = points.agg(F.count_if(inside)).first()[0]
    if n > min_points and kept >= min_points:
        return points.filter(inside)
    return points


def axis_ranges(points: DataFrame, x: str, y: str) -> DataFrame:
    return points.agg(
        (F.min(x) * 0.9).alias("x_low"),
        (F.max(x) * 1.05).alias("x_high"),
        (F.min(y) * 0.9).alias("y_low"),
        (F.max(y) * 1.05).alias("y_high"),
    )


def long_form(rows: DataFrame, key: str, series: Sequence[str]) -> DataFrame:
    """Several measures as (key, series, value) rows."""
    typed = rows.select(key, *[F.col(s).cast("double").alias(s) for s in series])
    return typed.unpivot(key, list(series), "series", "value")
