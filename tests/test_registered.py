"""Registered queries against their SQL counterparts in DuckDB, small scale.

A sample of every module; `python tests/compare.py DIR` runs all of them.
"""

import os

import pytest

import __spark_entry__ as entry
from compare import check, duck

from tallyport.plans import star, star_sql

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "mv_seller_perf", "mv_category_sales", "state_sales_of_year", "worst_sellers", "gmv_growth", "delivery_routes",
    "category_reviews", "installment_matrix", "worst_example_per_category", "trim_p95", "metric_base_fallback",
    "anomaly_alerts", "what_if_remove_worst", "forecast_weekly", "forecast_summary", "review_themes_neg",
    "sentiment_summary", "review_sample", "split_items", "zip_directory_union", "question_reports",
    "followup_context", "focus_entities", "parse_responses", "parse_plans", "screen_sql_log", "metric_view_hit",
    "metric_gmv_and_payments", "metric_review_score_by_category", "reconcile_state_sales",
]


def test_every_query_has_sql():
    assert set(star.QUERIES) == set(star_sql.SQL)
    assert set(star.QUERIES) <= set(entry.queries()) and set(star_sql.SQL) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no star-schema test data here")
    return duck(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, con, name):
    error, _, _ = check(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert error is None


def test_entry(spark):
    if not os.path.isdir(SF):
        pytest.skip("no star-schema test data here")
    assert entry.entry(spark).columns == ["ym", "total_gmv", "total_orders", "avg_basket"]
