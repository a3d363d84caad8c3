"""View-first metric queries.

`metric` answers "these measures by these dimensions" from the smallest rollup that
covers the request and from the base tables otherwise. The catalogue below says
which measures may be added up over which dimensions; it only picks a frame, the
query itself is a filter and a groupBy.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.dates import days_between, month_key
from tallyport.functions.numbers import exact_sum, from_units, percent, ratio_rounded, units
from tallyport.operators.facts import order_review_scores, product_categories
from tallyport.roles import Commerce


@dataclass(frozen=True)
class Measure:
    """An aggregate; `keep` lists dimensions it may not be added up over."""

    build: Callable[[], Column]
    keep: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Source:
    """A rollup or base fact that metrics can be computed from, small ones first."""

    name: str
    strategy: str
    dimensions: Mapping[str, str]
    measures: Mapping[str, Measure]

    def covers(self, dims: Sequence[str], measures: Sequence[str], filtered: Sequence[str]) -> bool:
        known = all(d in self.dimensions for d in [*dims, *filtered])
        return known and all(
            m in self.measures and self.measures[m].keep <= set(dims) for m in measures
        )


def _sum(name: str, *keep: str) -> Measure:
    return Measure(lambda: F.sum(name), frozenset(keep))


def _money(name: str) -> Measure:
    return Measure(lambda: exact_sum(name))


def _ratio(num: Callable[[], Column], den: Callable[[], Column], digits: int, *keep: str) -> Measure:
    return Measure(lambda: ratio_rounded(num(), den(), digits), frozenset(keep))


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


# A sum of monthly distinct customers is no distinct count, so unique_customers
# needs every dimension of its rollup; an order with two categories or two sellers
# counts in both, so total_orders needs that dimension.
ROLLUP_SOURCES = (
    Source(
        "mv_monthly_sales", "view", _same("ym"),
        {
            "total_gmv": _money("total_gmv"),
            "total_orders": _sum("total_orders"),
            "total_freight": _money("total_freight"),
            "avg_basket": _ratio(lambda: exact_sum("total_gmv"), lambda: F.sum("total_orders"), 2),
        },
    ),
    Source(
        "mv_payment_dist", "view", _same("ym", "payment_type"),
        {
            "total_transactions": _sum("total_transactions"),
            "total_value": _money("total_value"),
            "avg_installments": _ratio(lambda: F.sum("installments"), lambda: F.sum("with_installments"), 1),
        },
    ),
    Source(
        "mv_state_sales", "view", _same("ym", "customer_state"),
        {
            "total_gmv": _money("total_gmv"),
            "total_orders": _sum("total_orders"),
            "avg_basket": _ratio(lambda: exact_sum("total_gmv"), lambda: F.sum("total_orders"), 2),
            "unique_customers": _sum("unique_customers", "ym", "customer_state"),
        },
    ),
    Source(
        "mv_delivery_perf", "view", _same("ym", "customer_state"),
        {
            "delayed_orders": _sum("delayed_orders"),
            "avg_delivery_days": _ratio(lambda: F.sum("delivery_days"), lambda: F.sum("delivered_orders"), 1),
            "on_time_rate": Measure(lambda: percent(F.sum("on_time_orders"), F.sum("delivered_orders"))),
        },
    ),
    Source(
        "mv_category_sales", "view", {"ym": "ym", "category": "product_category_english"},
        {
            "total_gmv": _money("total_gmv"),
            "total_orders": _sum("total_orders", "category"),
            "avg_price": _ratio(lambda: exact_sum("total_gmv"), lambda: F.sum("item_count"), 2),
        },
    ),
    Source(
        "mv_seller_perf", "view", _same("ym", "seller_id", "seller_state"),
        {
            "total_gmv": _money("exact_gmv"),
            "total_orders": _sum("total_orders", "seller_id"),
            "avg_review_score": _ratio(lambda: F.sum("score_sum"), lambda: F.sum("scored"), 2, "seller_id"),
        },
    ),
)


# Facts of base tables are reduced to a row per order and dimensions before measures are
# built, so orders are counted as rows.
def _orders() -> Column:
    return F.count(F.lit(1))


def _price() -> Column:
    return from_units(F.sum("price_units"))


BASE_SOURCES = (
    Source(
        "delivered_orders", "base_table",
        _same("ym", "customer_state", "customer_city"),
        {
            "delayed_orders": Measure(lambda: F.count_if(~F.col("on_time"))),
            "avg_delivery_days": _ratio(lambda: F.sum("days"), lambda: F.count("days"), 1),
            "on_time_rate": Measure(lambda: percent(F.count_if("on_time"), F.count("on_time"))),
        },
    ),
    Source(
        "delivered_payments", "base_table",
        _same("ym", "customer_state", "customer_city", "payment_type", "payment_installments"),
        {
            "total_transactions": Measure(lambda: F.count(F.lit(1))),
            "total_value": _money("payment_value"),
            "avg_installments": _ratio(
                lambda: F.sum(F.col("payment_installments").cast("long")), lambda: F.count("payment_installments"), 1
            ),
        },
    ),
    Source(
        "delivered_items", "base_table",
        _same("ym", "customer_state", "customer_city", "seller_id", "seller_state", "category", "product_id"),
        {
            "total_gmv": Measure(_price),
            "total_freight": Measure(lambda: from_units(F.sum("freight_units"))),
            "total_orders": Measure(_orders),
            "unique_customers": Measure(lambda: F.count_distinct("customer_unique_id")),
            "avg_basket": _ratio(_price, _orders, 2),
            "avg_price": _ratio(_price, lambda: F.sum("items"), 2),
        },
    ),
    # A review counts once for each value of a dimension that its order has.
    Source(
        "order_reviews", "base_table",
        _same("ym", "customer_state", "customer_city", "seller_id", "seller_state", "category", "product_id"),
        {
            "avg_review_score": _ratio(lambda: F.sum("score_sum"), lambda: F.sum("scored"), 2),
            "review_count": Measure(lambda: F.sum("reviews")),
            "negative_reviews": Measure(lambda: F.sum("low")),
            "negative_review_rate": Measure(lambda: percent(F.sum("low"), F.sum("scored"))),
        },
    ),
)


def choose(dims: Sequence[str], measures: Sequence[str], filtered: Sequence[str] = ()) -> Source:
    """The first source that covers a request; rollups come before base tables."""
    for source in (*ROLLUP_SOURCES, *BASE_SOURCES):
        if source.covers(dims, measures, filtered):
            return source
    raise ValueError(f"no source has measures {list(measures)} by {list(dims)} filtered on {list(filtered)}")


def time_range(wanted) -> tuple[str, str] | None:
    """First and last day beyond of a month filter: 'YYYY*', 'YYYY-MM' or a list of months; None for others."""
    months = [wanted] if isinstance(wanted, str) else list(wanted) if isinstance(wanted, (list, tuple, set)) else []
    if len(months) == 1 and re.fullmatch(r"\d{4}(-\d{2})?\*", months[0]):
        months = [months[0][:-1]]
        low, high = (f"{months[0]}-01", f"{months[0]}-12") if len(months[0]) == 4 else (months[0], months[0])
    elif months and all(isinstance(m, str) and re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", m) for m in months):
        low, high = min(months), max(months)
    else:
        return None
    year, month = int(high[:4]), int(high[5:7])
    return f"{low}-01", f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"


def _base_fact(c: Commerce, name: str, needed: set[str], months=None) -> DataFrame:
    """A base fact with the dimension tables the request needs, and no others.

    A month filter reaches the scan of orders as a range of purchase times. Lines are
    summed per order before dimension tables are joined.
    """
    done, due, bought = (
        "order_delivered_customer_date", "order_estimated_delivery_date", "order_purchase_timestamp",
    )
    span = time_range(months) if months is not None else None
    delivered = c.delivered_orders() if name != "order_reviews" else c.orders
    if span:
        start, end = (F.lit(day).cast("timestamp") for day in span)
        delivered = delivered.filter((F.col(bought) >= start) & (F.col(bought) < end))
    orders = delivered.withColumn("ym", month_key(bought))
    item_keys = [k for k, of in (("seller_id", {"seller_id", "seller_state"}), ("product_id", {"product_id", "category"})) if needed & of]
    if name == "delivered_orders":
        fact = orders.filter(F.col(done).isNotNull() & F.col(due).isNotNull()).select(
            "order_id", "customer_id", "ym",
            days_between(done, bought).cast("long").alias("days"),
            (F.col(done) <= F.col(due)).alias("on_time"),
        )
    elif name == "delivered_payments":
        fact = c.payments.join(orders.select("order_id", "customer_id", "ym"), "order_id")
    elif name == "delivered_items":
        lines = c.order_items.groupBy("order_id", *item_keys).agg(
            F.sum(units("price")).alias("price_units"), F.sum(units("freight_value")).alias("freight_units"), F.count("price").alias("items"))
        fact = lines.join(orders.select("order_id", "customer_id", "ym"), "order_id")
    else:
        fact = order_review_scores(c.order_reviews).join(orders.select("order_id", "customer_id", "ym"), "order_id")
        if item_keys:
            fact = fact.join(c.order_items.select("order_id", *item_keys).distinct(), "order_id")
    if needed & {"customer_state", "customer_city", "customer_unique_id"}:
        fact = fact.join(
            c.customers.select("customer_id", "customer_unique_id", "customer_state", "customer_city"), "customer_id"
        )
    if "seller_state" in needed:
        fact = fact.join(c.sellers.select("seller_id", "seller_state"), "seller_id")
    if "category" in needed:
        fact = fact.join(product_categories(c), "product_id")
    if name not in ("delivered_items", "order_reviews"):
        return fact
    # One row per order and value of the dimensions: two products of one category are one.
    keys = ["order_id", *sorted(needed)]
    if name == "delivered_items":
        return fact.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in ("price_units", "freight_units", "items")])
    return fact.select(*keys, "reviews", "scored", "score_sum", "low").distinct()


def _condition(column: str, wanted) -> Column:
    """A value, a list of values, or 'prefix*' for text."""
    if isinstance(wanted, (list, tuple, set)):
        return F.col(column).isin(list(wanted))
    if isinstance(wanted, str) and wanted.endswith("*"):
        return F.col(column).startswith(wanted[:-1])
    return F.col(column) == wanted


def metric(
    c: Commerce, rollups: Mapping[str, DataFrame], dims: Sequence[str], measures: Sequence[str],
    where: Mapping[str, object] | None = None,
) -> DataFrame:
    """Measures by dimensions, with the chosen source and strategy as columns.

    Where no source has all measures, each comes from the first source that has it, and
    the results meet on the dimensions; `source` then names all of them, and the
    strategy is a view only if all of them are.
    """
    where = where or {}
    try:
        source = choose(dims, measures, list(where))
    except ValueError:
        return _from_several(c, rollups, dims, measures, where)
    return _from_one(c, rollups, source, dims, measures, where)


def _from_several(c, rollups, dims, measures, where) -> DataFrame:
    by_source: dict[str, list[str]] = {}
    chosen = {m: choose(dims, [m], list(where)) for m in measures}
    for m, source in chosen.items():
        by_source.setdefault(source.name, []).append(m)
    parts = [_from_one(c, rollups, chosen[ms[0]], dims, ms, where).drop("source", "strategy") for ms in by_source.values()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    # Each part has a row per value of the dimensions, so max() only picks the one there is; null is a value like others.
    met = whole.groupBy(*dims).agg(*[F.max(m).alias(m) for m in measures])
    strategy = "view" if all(s.strategy == "view" for s in chosen.values()) else "base_table"
    return met.select(*dims, *measures, F.lit("+".join(by_source)).alias("source"), F.lit(strategy).alias("strategy"))


def _from_one(c, rollups, source: Source, dims, measures, where) -> DataFrame:
    if source.strategy == "view":
        frame = rollups[source.name]
    else:
        needed = {*dims, *where, *(["customer_unique_id"] if "unique_customers" in measures else [])}
        frame = _base_fact(c, source.name, needed, where.get("ym"))
    for dim, wanted in where.items():
        frame = frame.filter(_condition(source.dimensions[dim], wanted))
    keys = [F.col(source.dimensions[d]).alias(d) for d in dims]
    result = frame.groupBy(*keys).agg(*[source.measures[m].build().alias(m) for m in measures])
    return result.select(
        *dims, *measures, F.lit(source.name).alias("source"), F.lit(source.strategy).alias("strategy")
    )


def catalogue(spark: SparkSession) -> DataFrame:
    """What can be asked: one row per source and measure."""
    rows = [
        (s.name, s.strategy, list(s.dimensions), measure, sorted(m.keep))
        for s in (*ROLLUP_SOURCES, *BASE_SOURCES)
        for measure, m in s.measures.items()
    ]
    return spark.createDataFrame(
        rows, "source string, strategy string, dimensions array<string>, measure string, needs array<string>"
    )
