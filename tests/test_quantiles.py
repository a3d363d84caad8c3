"""Exact percentiles in rounds against Spark's percentile, with a buffer far below the rows."""

import random

import pytest
from pyspark.sql import functions as F

from tallyport.operators import quantiles


@pytest.mark.parametrize("p", [0.0, 0.01, 0.5, 0.95, 0.999, 1.0])
def test_equals_percentile(spark, p):
    rng = random.Random(7)
    rows = [(rng.choice([rng.random() * 1000, float(rng.randint(0, 5)), None, float("nan")]),) for _ in range(20_000)]
    frame = spark.createDataFrame(rows, "x double")
    clean = frame.where(~F.isnan("x"))
    want = clean.agg(F.percentile("x", F.lit(p))).first()[0]
    assert quantiles.exact_percentile(frame, "x", p, buffer=64) == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_all_equal_and_empty(spark):
    same = spark.createDataFrame([(3.5,)] * 5000, "x double")
    assert quantiles.exact_percentile(same, "x", 0.95, buffer=10) == 3.5
    assert quantiles.exact_percentile(spark.createDataFrame([], "x double"), "x", 0.5) is None
    one = spark.createDataFrame([(2.0,), (None,)], "x double")
    assert quantiles.exact_percentile(one, "x", 0.3) == 2.0
