"""The six monthly rollups over delivered orders.

Every builder returns the published columns followed by additive components
(sums and counts), so that averages and rates can be re-aggregated exactly. The
`mv_*` functions keep the published columns only.
"""

from __future__ import annotations

import json
import uuid

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.dates import days_between, month_key
from tallyport.functions.numbers import from_units, percent, ratio_rounded, units
from tallyport.operators.facts import delivered_months, order_review_scores, product_categories
from tallyport.roles import Commerce
from tallyport.schemas import ROLLUP_KEYS, ROLLUPS
from tallyport.sources.staging import Staging


def order_totals(c: Commerce) -> DataFrame:
    """Delivered orders with their month and item sums, one row per order.

    Items are summed per order before the join: orders then count as rows, and a
    huge order is folded on the map side.
    """
    per_order = c.order_items.groupBy("order_id").agg(
        F.sum(units("price")).alias("price_units"),
        F.sum(units("freight_value")).alias("freight_units"),
    )
    return delivered_months(c).join(per_order, "order_id")


def monthly_sales(c: Commerce, totals: DataFrame | None = None) -> DataFrame:
    sums = (
        (order_totals(c) if totals is None else totals)
        .groupBy("ym")
        .agg(
            F.sum("price_units").alias("price_units"),
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("freight_units").alias("freight_units"),
        )
    )
    gmv = from_units("price_units")
    return sums.select(
        "ym",
        gmv.alias("total_gmv"),
        "total_orders",
        ratio_rounded(gmv, F.col("total_orders"), 2).alias("avg_basket"),
        from_units("freight_units").alias("total_freight"),
    )


def state_sales(c: Commerce, totals: DataFrame | None = None) -> DataFrame:
    buyers = c.customers.select("customer_id", "customer_unique_id", "customer_state")
    return (
        (order_totals(c) if totals is None else totals)
        .join(buyers, "customer_id")
        .groupBy("ym", "customer_state")
        .agg(
            from_units(F.sum("price_units")).alias("total_gmv"),
            F.count(F.lit(1)).alias("total_orders"),
            F.count_distinct("customer_unique_id").alias("unique_customers"),
        )
    )


def category_sales(c: Commerce) -> DataFrame:
    # Orders are joined first; the (order, category) step reuses that partitioning.
    sums = (
        c.order_items.select("order_id", "product_id", "price")
        .join(product_categories(c), "product_id")
        .join(delivered_months(c).drop("customer_id"), "order_id")
        .groupBy("order_id", "ym", "category")
        .agg(F.sum(units("price")).alias("price_units"), F.count("price").alias("priced"))
        .groupBy("ym", F.col("category").alias("product_category_english"))
        .agg(
            F.sum("price_units").alias("price_units"),
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("priced").alias("item_count"),
        )
    )
    gmv = from_units("price_units")
    return sums.select(
        "ym",
        "product_category_english",
        gmv.alias("total_gmv"),
        "total_orders",
        ratio_rounded(gmv, F.col("item_count"), 2).alias("avg_price"),
        "item_count",
    )


def delivery_perf(c: Commerce) -> DataFrame:
    done, due = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    sums = (
        c.delivered_orders()
        .filter(done.isNotNull() & due.isNotNull())
        .select(
            "customer_id",
            month_key("order_purchase_timestamp").alias("ym"),
            days_between(done, "order_purchase_timestamp").cast("long").alias("days"),
            (done <= due).alias("on_time"),
        )
        .join(c.customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("ym", "customer_state")
        .agg(
            F.sum("days").alias("delivery_days"),
            F.count(F.lit(1)).alias("delivered_orders"),
            F.count_if("on_time").alias("on_time_orders"),
        )
    )
    return sums.select(
        "ym",
        "customer_state",
        ratio_rounded(F.col("delivery_days"), F.col("delivered_orders"), 1).alias("avg_delivery_days"),
        percent(F.col("on_time_orders"), F.col("delivered_orders")).alias("on_time_rate"),
        (F.col("delivered_orders") - F.col("on_time_orders")).alias("delayed_orders"),
        "delivery_days",
        "delivered_orders",
        "on_time_orders",
    )


def seller_perf(c: Commerce) -> DataFrame:
    """Seller months, in two readings of an order with several reviews.

    total_gmv / avg_review_score count a sale once per review of its order (what a
    plain join of items and reviews gives); exact_gmv / exact_review_score count
    each sale and each review once.
    """
    items = c.order_items.select("order_id", "seller_id", "price")
    scores = order_review_scores(c.order_reviews).select("order_id", "reviews", "scored", "score_sum")
    sums = (
        items.join(delivered_months(c).drop("customer_id"), "order_id")
        .groupBy("order_id", "ym", "seller_id")
        .agg(F.sum(units("price")).alias("price_units"), F.count(F.lit(1)).alias("item_rows"))
        .join(scores, "order_id", "left")
        .groupBy("ym", "seller_id")
        .agg(
            F.sum(F.col("price_units") * F.greatest(F.coalesce("reviews", F.lit(1)), F.lit(1))).alias("fanned_units"),
            F.sum("price_units").alias("price_units"),
            F.count(F.lit(1)).alias("total_orders"),
            F.sum(F.col("score_sum") * F.col("item_rows")).alias("fanned_score"),
            F.sum(F.col("scored") * F.col("item_rows")).alias("fanned_scored"),
            F.sum("score_sum").alias("score_sum"),
            F.sum("scored").alias("scored"),
        )
        .join(c.sellers.select("seller_id", "seller_state"), "seller_id")
    )
    return sums.select(
        "ym",
        "seller_id",
        "seller_state",
        from_units("fanned_units").alias("total_gmv"),
        "total_orders",
        ratio_rounded(F.col("fanned_score"), F.col("fanned_scored"), 2).alias("avg_review_score"),
        from_units("price_units").alias("exact_gmv"),
        ratio_rounded(F.col("score_sum"), F.col("scored"), 2).alias("exact_review_score"),
        "score_sum",
        "scored",
    )


def payment_dist(c: Commerce) -> DataFrame:
    sums = (
        c.payments.select("order_id", "payment_type", "payment_installments", "payment_value")
        .join(delivered_months(c).drop("customer_id"), "order_id")
        .groupBy("ym", "payment_type")
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            F.sum(F.col("payment_installments").cast("long")).alias("installments"),
            F.count("payment_installments").alias("with_installments"),
            from_units(F.sum(units("payment_value"))).alias("total_value"),
        )
    )
    return sums.select(
        "ym",
        "payment_type",
        "total_transactions",
        ratio_rounded(F.col("installments"), F.col("with_installments"), 1).alias("avg_installments"),
        "total_value",
        "installments",
        "with_installments",
    )


BUILDERS: dict[str, Callable[[Commerce], DataFrame]] = {
    "mv_monthly_sales": monthly_sales,
    "mv_state_sales": state_sales,
    "mv_category_sales": category_sales,
    "mv_delivery_perf": delivery_perf,
    "mv_seller_perf": seller_perf,
    "mv_payment_dist": payment_dist,
}


def published(c: Commerce, name: str) -> DataFrame:
    """A rollup with its published columns."""
    return BUILDERS[name](c).select(*ROLLUPS[name].fieldNames())


def build_all(c: Commerce) -> dict[str, DataFrame]:
    """All six rollups with components, lazy."""
    return {name: build(c) for name, build in BUILDERS.items()}


def seller_perf_exact(c: Commerce) -> DataFrame:
    return seller_perf(c).select(
        "ym",
        "seller_id",
        "seller_state",
        F.col("exact_gmv").alias("total_gmv"),
        "total_orders",
        F.col("exact_review_score").alias("avg_review_score"),
    )


COMPLETE = "_COMPLETE"


def _files(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path, path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[str]:
    """Complete versions below `root`, oldest first."""
    path, files = _files(spark, root)
    if not files.exists(path(root)):
        return []
    names = sorted(s.getPath().getName() for s in files.listStatus(path(root)) if s.isDirectory())
    return [n for n in names if n.startswith("v") and files.exists(path(f"{root}/{n}/{COMPLETE}"))]


def _manifest(spark: SparkSession, root: str, version: str) -> dict[str, str]:
    """Rollup name -> data folder of a complete version; a version of the first layout lists its own folders."""
    path, files = _files(spark, root)
    marker = path(f"{root}/{version}/{COMPLETE}")
    stream = files.open(marker)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    if text.strip():
        return json.loads(text)
    return {n: f"{root}/{version}/{n}" for n in BUILDERS if files.exists(path(f"{root}/{version}/{n}"))}


def _publish(spark: SparkSession, root: str, written: dict[str, str], attempts: int = 20) -> str:
    """Commit `written` over the newest manifest as the next version; the rest is carried over.

    The marker is created only if absent, so of two writers that take the same number one
    fails to create it, reads the newer manifest and tries the number after it.
    """
    path, files = _files(spark, root)
    for _ in range(attempts):
        done = versions(spark, root)
        carried = _manifest(spark, root, done[-1]) if done else {}
        version = f"v{int(done[-1][1:]) + 1 if done else 1:010d}"
        try:
            out = files.create(path(f"{root}/{version}/{COMPLETE}"), False)
        except Exception as error:  # another writer took this number
            if "AlreadyExists" not in str(error) and "already exists" not in str(error):
                raise
            continue
        try:
            out.write(bytearray(json.dumps(carried | written, sort_keys=True).encode()))
        finally:
            out.close()
        return version
    raise RuntimeError(f"could not publish rollups below {root} after {attempts} attempts")


def refresh(spark: SparkSession, c: Commerce, root: str, names: Sequence[str] = (), kept_versions: int = 2) -> DataFrame:
    """Rebuild all rollups (or those in `names`) under `root` and report (rollup, row_count).

    Each rollup goes to a data folder of its own; a manifest, the version's marker, then
    names the folder of every rollup: the rebuilt ones and, carried over from the
    previous version, all others. Readers take the newest manifest, so a partial refresh
    hides nothing, and a refresh that fails before its manifest is never seen. Versions
    beyond the newest `kept_versions` are deleted, and data folders that no kept manifest
    names and that are older than the oldest kept one.
    """
    wanted = [n for n in BUILDERS if not names or n in names]
    batch = uuid.uuid4().hex
    written = {n: f"{root}/data/{n}-{batch}" for n in wanted}
    with Staging(spark, root) as stage:
        frames = {n: BUILDERS[n](c) for n in wanted}
        if {"mv_monthly_sales", "mv_state_sales"} <= set(wanted):
            # The sums per order are computed once for the two rollups that need them.
            totals = stage.keep(order_totals(c), "order_totals")
            frames |= {"mv_monthly_sales": monthly_sales(c, totals), "mv_state_sales": state_sales(c, totals)}
        for name, frame in frames.items():
            # Ranges over the whole key keep the ym statistics of each file tight and
            # split a month that holds most rows.
            keys = ROLLUP_KEYS[name]
            frame.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(written[name])
    _publish(spark, root, written)
    _tidy(spark, root, kept_versions)
    return row_counts({n: spark.read.parquet(written[n]) for n in wanted})


def _tidy(spark: SparkSession, root: str, kept_versions: int) -> None:
    path, files = _files(spark, root)
    done = versions(spark, root)
    for old in done[:-kept_versions]:
        files.delete(path(f"{root}/{old}"), True)
    kept = done[-kept_versions:]
    if not kept or not files.exists(path(f"{root}/data")):
        return
    named = {p for v in kept for p in _manifest(spark, root, v).values()}
    oldest = files.getFileStatus(path(f"{root}/{kept[0]}/{COMPLETE}")).getModificationTime()
    for status in files.listStatus(path(f"{root}/data")):
        folder = f"{root}/data/{status.getPath().getName()}"
        if folder not in named and status.getModificationTime() < oldest:
            files.delete(status.getPath(), True)


def read_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored rollups named by the newest complete version, as a dict of lazy frames."""
    done = versions(spark, root)
    if not done:
        raise FileNotFoundError(f"no complete rollups below {root}")
    return {n: spark.read.parquet(folder) for n, folder in sorted(_manifest(spark, root, done[-1]).items())}


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(rollup, row_count) of several frames in one job."""
    counts = None
    for name, frame in frames.items():
        one = frame.agg(F.lit(name).alias("rollup"), F.count(F.lit(1)).alias("row_count"))
        counts = one if counts is None else counts.unionByName(one)
    return counts
