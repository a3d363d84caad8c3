"""Anomalies, what-if, forecast."""

from datetime import date

from conftest import rows_of
from pyspark.sql import functions as F

from tallyport.operators import anomaly, forecast, rollups, whatif

MONTHLY = "ym string, total_gmv double"


def history(spark, values, start=(2018, 1)):
    rows = []
    year, month = start
    for i, y in enumerate(values):
        total = year * 12 + month - 1 + i
        ym = f"{total // 12}-{total % 12 + 1:02}"
        rows.append(("s", ym, date.fromisoformat(ym + "-01"), float(y)))
    return spark.createDataFrame(rows, "series string, ym string, ds date, y double")


def test_outlier_month_is_flagged_with_sample_deviation(spark):
    values = [100.0] * 11 + [400.0]
    frame = spark.createDataFrame([(f"2017-{i + 1:02}", v) for i, v in enumerate(values)], MONTHLY)
    alerts = anomaly.monthly_gmv_outliers(frame).collect()
    assert [(a.ym, a.severity, a.direction, a.z_score) for a in alerts] == [("2017-12", "high", "high", 3.18)]
    flat = frame.withColumn("total_gmv", F.lit(5.0))
    assert anomaly.monthly_gmv_outliers(flat).isEmpty()


def test_state_drop_uses_the_states_own_last_month(spark):
    rows = [("AL", "2017-01", 100.0), ("AL", "2017-02", 100.0), ("AL", "2017-03", 40.0),
            ("SP", "2017-04", 100.0), ("SP", "2017-05", 100.0), ("SP", "2017-07", 90.0), ("RJ", "2017-01", 9.0)]
    frame = spark.createDataFrame(rows, "customer_state string, ym string, total_gmv double")
    got = anomaly.state_sales_drops(frame).collect()
    assert [(a.state, a.ym, a.severity, a.drop_pct, a.avg_gmv) for a in got] == [("AL", "2017-03", "high", 60.0, 100.0)]
    assert got[0].detail == "State AL GMV dropped 60% in 2017-03 compared to its historical average."


def test_score_drop_ignores_null_category(spark):
    rows = [(c, f"2017-0{m}", s) for c in ("toys", None) for m, s in ((1, 4.0), (2, 4.0), (3, 2.5))]
    frame = spark.createDataFrame(rows, "category string, ym string, avg_score double")
    got = anomaly.review_score_drops(frame).collect()
    assert [(a.category, a.severity, a.drop) for a in got] == [("toys", "high", 1.5)]


def test_alert_summary(spark):
    frame = spark.createDataFrame([(f"2017-{i + 1:02}", v) for i, v in enumerate([1.0] * 11 + [50.0])], MONTHLY)
    alerts = anomaly.all_alerts(anomaly.monthly_gmv_outliers(frame))
    assert alerts.columns == list(anomaly.ALERT_COLUMNS)
    row = anomaly.alert_summary(alerts).first()
    assert (row.alert_count, row.alert_types) == (1, "gmv_anomaly")
    none = anomaly.alert_summary(alerts.limit(0)).first()
    assert none.summary == "No significant anomalies detected. All metrics within normal range."


def test_what_if_drops_all_reviews_of_touched_orders(spark, shop):
    rollup = spark.createDataFrame(
        [("s1", "SP", "2017-01", 300.0, 6, 2.0), ("s2", "AL", "2017-01", 100.0, 10, 4.0), ("s9", "AL", "2017-01", 5.0, 1, 1.0)],
        "seller_id string, seller_state string, ym string, total_gmv double, total_orders long, avg_review_score double",
    )
    row = whatif.remove_worst_sellers(shop, rollup, 1).first()
    # s1 sold in o1, o2, o5; the only scored reviews are on those orders.
    assert row.removed_count == 1 and row.remaining_reviews_count == 0
    assert row.current_avg_score == 3.0 and row.new_avg_score == 3.0 and row.improvement_pct == 0.0
    assert row.impacted_gmv_share_pct == 74.07 and row.impacted_order_share_pct == 35.29
    other = whatif.remove_worst_sellers(shop, rollup.filter("seller_id = 's2'"), 1).first()
    # s2 sold in o1 (and o3, unscored; o4, no review): r3 and r5 stay.
    assert (other.remaining_reviews_count, other.new_avg_score, other.improvement) == (2, 3.0, 0.0)


def test_golden_calendar_of_six_weeks(spark):
    frame = history(spark, range(100, 124), (2016, 9))
    assert frame.agg(F.max("ds")).first()[0] == date(2018, 8, 1)
    got = [r.ds for r in forecast.forecast(frame, 6).orderBy("period").collect()]
    assert got == ["2018-08-02", "2018-08-06", "2018-08-13", "2018-08-20", "2018-08-27", "2018-09-03"]


def test_forecast_never_negative_and_upper_not_below_estimate(spark):
    frame = history(spark, [100, 60, 20, 1])
    for weeks in (1, 6, 26, 130):
        rows = forecast.forecast(frame, weeks).collect()
        assert rows and all(r.yhat >= 0 and r.yhat_lower >= 0 and r.yhat_upper >= r.yhat for r in rows)


def test_short_series_have_no_forecast(spark):
    assert forecast.forecast(history(spark, [1, 2, 3]), 6).isEmpty()


def test_straight_line_is_continued_exactly(spark):
    base = history(spark, [0] * 12)
    line = base.withColumn("y", F.unix_date("ds") * 2.0 + 10)
    rows = forecast.forecast(line, 20).orderBy("period").collect()
    # 20 weeks report 5 months; a perfect line has a zero-width interval.
    expected = [((date(2019, m, 1) - date(1970, 1, 1)).days * 2.0 + 10) for m in range(1, 6)]
    assert [r.yhat for r in rows] == expected
    assert [r.ds for r in rows] == [f"2019-0{m}" for m in range(1, 6)]
    assert all(abs(r.yhat_upper - r.yhat) < 0.05 for r in rows)


def test_granularity_and_periods_of_column_and_horizon_agree(spark):
    weeks = [1, 2, 6, 12, 13, 26, 48, 49, 78, 130, 300]
    frame = spark.createDataFrame([(float(w),) for w in weeks], "w double")
    got = frame.select("w", forecast.granularity(F.col("w")), forecast.periods(F.col("w"))).collect()
    for w, step, n in got:
        h = forecast.Horizon(w)
        assert (step, n) == (h.granularity, h.periods), w


def test_direction(spark):
    up = forecast.direction(history(spark, [10, 20, 30, 40, 50]), 26).first()
    assert up.trend_direction == "up" and up.forecast_periods == 6
    few = forecast.direction(history(spark, [10, 20, 30, 40, 50]), 2).first()
    assert few.trend_direction == "flat" and few.forecast_periods == 2


def test_series_come_from_rollups(shop):
    series = forecast.series_of(rollups.published(shop, "mv_state_sales"), "state", F.col("customer_state"))
    assert ("state:SP", "2017-01", date(2017, 1, 1), 250.25) in rows_of(series)
