"""Trend with changes of slope: elimination against numpy, bends followed, lines unchanged."""

from datetime import date

import numpy as np
from pyspark.sql import functions as F

from tallyport.operators import forecast


def months(n, start=(2016, 1)):
    y, m = start
    out = []
    for _ in range(n):
        out.append(date(y, m, 1))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def fit(spark, rows):
    history = spark.createDataFrame(rows, "series string, ds date, y double")
    return {r.series: r for r in forecast.fit_changepoints(history).collect()}


def test_solve_matches_numpy(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(7, 7))
    a = m @ m.T + 7 * np.eye(7)
    b = rng.normal(size=7)
    frame = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<array<double>>, b array<double>")
    got = frame.select(forecast.solve(F.col("a"), F.col("b"), 7).alias("x")).first().x
    assert np.allclose(got, np.linalg.solve(a, b))


def test_straight_line_unchanged(spark):
    days = months(36)
    got = fit(spark, [("line", d, 1000.0 + 50.0 * i) for i, d in enumerate(days)])["line"]
    assert abs(got.slope_start - 50) < 1e-6 and abs(got.slope_end - 50) < 1e-6
    assert abs(got.yhat_last - (1000 + 50 * 35)) < 1e-6 and abs(got.yhat_next - (1000 + 50 * 36)) < 1e-6


def test_bend_followed(spark):
    days = months(48)
    ys = [1000.0 + 100 * i if i < 24 else 1000.0 + 100 * 24 - 80 * (i - 24) for i in range(48)]
    got = fit(spark, [("bend", d, y) for d, y in zip(days, ys)])["bend"]
    # A single straight line would rise over these four years; the hinge fit ends falling.
    assert got.slope_start > 50 and got.slope_end < -40
    assert abs(got.yhat_next - (ys[-1] - 80)) < 0.1 * abs(ys[-1])


def test_cases(spark):
    rows = [("short", d, 1.0) for d in months(3)] + [("zeros", d, 0.0) for d in months(10)]
    rows += [("nulls", d, None if i % 2 else 5.0) for i, d in enumerate(months(12))] + [("nulls", None, 9.0)]
    got = fit(spark, rows)
    assert "short" not in got
    assert got["zeros"].slope_end == 0.0 and got["zeros"].yhat_next == 0.0
    assert abs(got["nulls"].yhat_next - 5.0) < 1e-6
    assert fit(spark, []) == {}
