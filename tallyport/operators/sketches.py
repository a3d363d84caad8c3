"""Mergeable distinct counts: theta sketches of customers in a monthly rollup.

A rollup row (ym, customer_state) holds a theta sketch of the unique customers who
bought then and there. Sketches of any set of rows merge by union, so distinct
customers come out for any subset of months and states without reading orders again,
and customers common to two sets of rows come out by intersection. Up to 2^lg_k
distinct customers a sketch is exact; above, the relative standard error is about
1 / sqrt(2^lg_k) (1.6 % for lg_k 12), for intersections relative to the union.

Defined cases: rows without customer are skipped; a group without customers has no
sketch row and counts zero where it is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyport.operators.rollups import order_totals
from tallyport.roles import Commerce

LG_K = 12
# Accepted distance from the exact count: this many standard errors.
SIGMAS = 3


def customer_sketches(c: Commerce, lg_k: int = LG_K, totals: DataFrame | None = None) -> DataFrame:
    """(ym, customer_state, customers): sketch of the unique customers of delivered orders."""
    buyers = c.customers.select("customer_id", "customer_unique_id", "customer_state")
    rows = (order_totals(c) if totals is None else totals).join(buyers, "customer_id")
    return rows.where(F.col("customer_unique_id").isNotNull()).groupBy("ym", "customer_state").agg(
        F.theta_sketch_agg("customer_unique_id", lg_k).alias("customers"))


def bound(estimate: Column, lg_k: int = LG_K) -> Column:
    return F.lit(SIGMAS) * estimate / F.sqrt(F.lit(float(1 << lg_k)))


def distinct_customers(sketches: DataFrame, by: list[str], lg_k: int = LG_K) -> DataFrame:
    """`by` columns, unique_customers (estimate) and its error bound, from the sketches alone."""
    merged = sketches.groupBy(*by).agg(F.theta_union_agg("customers", lg_k).alias("u"))
    estimate = F.theta_sketch_estimate("u")
    return merged.select(*by, estimate.alias("unique_customers"), bound(estimate, lg_k).alias("error_bound"))


def returning_customers(sketches: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """ym, next_ym (the next month with sales), returning: customers of both months, by intersection."""
    months = sketches.groupBy("ym").agg(F.theta_union_agg("customers", lg_k).alias("u"))
    # One row per month: a window over months only.
    paired = months.withColumn("next_ym", F.lead("ym").over(Window.orderBy("ym"))) \
        .withColumn("next_u", F.lead("u").over(Window.orderBy("ym"))).where(F.col("next_ym").isNotNull())
    both = F.theta_sketch_estimate(F.theta_intersection("u", "next_u"))
    union = F.theta_sketch_estimate(F.theta_union("u", "next_u", lg_k))
    return paired.select("ym", "next_ym", both.alias("returning"), bound(union, lg_k).alias("error_bound"))
