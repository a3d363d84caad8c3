import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallyport.operators import diagnostics, metrics, reconcile, rollups
from tallyport.schemas import ROLLUP_KEYS, ROLLUPS


def test_monthly_sales_counts_only_delivered_orders(shop):
    assert rows_of(rollups.published(shop, "mv_monthly_sales")) == [
        ("2017-01", 250.25, 2, 125.13, 27.5),
        ("2017-02", 20.0, 1, 20.0, 3.0),
        ("2017-03", 50.05, 1, 50.05, 6.0),
    ]


def test_state_sales_counts_people_not_customer_ids(shop):
    assert rows_of(rollups.published(shop, "mv_state_sales"))[0] == ("2017-01", "SP", 250.25, 2, 1)


def test_category_falls_back_to_original_and_keeps_null(shop):
    got = rows_of(rollups.published(shop, "mv_category_sales"), "ym", "product_category_english", "total_gmv", "avg_price")
    assert ("2017-01", "beauty_health", 200.2, 100.1) in got
    assert ("2017-01", "coisas_raras", 50.05, 50.05) in got
    assert ("2017-02", None, 20.0, 20.0) in got


def test_delivery_on_the_due_date_is_on_time_and_missing_dates_are_left_out(shop):
    assert rows_of(rollups.published(shop, "mv_delivery_perf")) == [
        ("2017-01", "SP", 18.0, 50.0, 1),
        ("2017-02", "RJ", 20.0, 100.0, 0),
    ]


def test_seller_rollup_fans_out_by_review_and_exact_does_not(shop):
    fanned = rows_of(rollups.published(shop, "mv_seller_perf"))
    exact = rows_of(rollups.seller_perf_exact(shop))
    # o1 has two reviews: 100.10 counts twice, o2 once.
    assert ("2017-01", "s1", "SP", 300.3, 2, 2.67) in fanned
    assert ("2017-01", "s1", "SP", 200.2, 2, 2.67) in exact
    assert ("2017-02", "s2", "AL", 20.0, 1, None) in exact


def test_payment_rollup(shop):
    got = rows_of(rollups.published(shop, "mv_payment_dist"))
    assert ("2017-01", "credit_card", 2, 2.5, 200.25) in got
    assert ("2017-01", "voucher", 1, 1.0, 50.0) in got


def test_every_rollup_has_declared_columns_and_unique_keys(shop):
    for name, schema in ROLLUPS.items():
        frame = rollups.published(shop, name)
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in schema], name
        assert frame.groupBy(*ROLLUP_KEYS[name]).count().filter("count > 1").isEmpty(), name


def test_refresh_writes_counts_and_reads_back(spark, shop, tmp_path):
    counts = {r.rollup: r.row_count for r in rollups.refresh(spark, shop, str(tmp_path)).collect()}
    again = {r.rollup: r.row_count for r in rollups.refresh(spark, shop, str(tmp_path)).collect()}
    assert counts == again and counts["mv_monthly_sales"] == 3 and len(counts) == 6
    stored = rollups.read_all(spark, str(tmp_path))
    assert rows_of(metrics.monthly_series(stored["mv_monthly_sales"])) == rows_of(
        metrics.monthly_series(rollups.published(shop, "mv_monthly_sales"))
    )


def test_view_and_base_agree(shop):
    view = metrics.state_ranking(rollups.published(shop, "mv_state_sales"), 2017)
    base = diagnostics.state_ranking_base(shop, 2017)
    row = reconcile.reconcile(view, base, ["customer_state"], ["total_gmv", "total_orders"]).first()
    assert (row.view_rows, row.base_rows, row.unmatched_keys) == (2, 2, 0)
    assert (row.max_diff_total_gmv, row.max_diff_total_orders) == (0.0, 0.0)


def test_growth_skips_missing_months(spark):
    series = spark.createDataFrame(
        [("2017-12", 100.0), ("2018-01", 150.0), ("2018-03", 90.0)], "ym string, total_gmv double"
    )
    got = [(r.ym, r.previous, r.growth_pct) for r in metrics.growth(series).collect()]
    assert got == [("2017-12", None, None), ("2018-01", 100.0, 50.0), ("2018-03", None, None)]


def test_installment_shares_add_up(shop):
    columns = ("payment_type", "payment_installments", "share_pct")
    assert rows_of(diagnostics.installment_share(shop, 1, 12), *columns) == [
        ("boleto", 1, 100.0), ("credit_card", 2, 50.0), ("credit_card", 3, 50.0), ("voucher", 1, 100.0),
    ]
    # By default a payment in 13 parts counts as well.
    assert rows_of(diagnostics.installment_share(shop), *columns) == [
        ("boleto", 1, 100.0), ("credit_card", 13, 33.3), ("credit_card", 2, 33.3), ("credit_card", 3, 33.3), ("voucher", 1, 100.0),
    ]


def test_trim_keeps_everything_when_few_points_or_few_would_stay(spark):
    few = spark.createDataFrame([(float(i), float(i)) for i in range(10)], "x double, y double")
    assert diagnostics.trim_p95(few, "x", "y").count() == 10
    crossing = spark.createDataFrame([(float(i), float(10 - i)) for i in range(11)], "x double, y double")
    assert diagnostics.trim_p95(crossing, "x", "y").count() == 11
    many = spark.createDataFrame([(float(i), float(i)) for i in range(100)], "x double, y double")
    assert diagnostics.trim_p95(many, "x", "y").count() == 95


def test_only_falling_categories_are_listed(spark):
    rows = [(f"2017-0{m}", c, float(v)) for c, vs in (("up", (1, 2, 3)), ("down", (9, 5, 4)), ("new", (9, 1))) for m, v in enumerate(vs, 1)]
    frame = spark.createDataFrame(rows, "ym string, product_category_english string, total_gmv double")
    assert rows_of(metrics.category_trends(frame)) == [("down", 3, -2.5, 4.0, True)]
    assert len(rows_of(metrics.category_trends(frame, only_declining=False))) == 2


def test_readers_see_complete_refreshes_only(spark, shop, tmp_path):
    root = str(tmp_path)
    for _ in range(3):
        rollups.refresh(spark, shop, root, ["mv_state_sales"])
    assert rollups.versions(spark, root) == ["v0000000002", "v0000000003"]
    # A refresh that broke off has no marker and is not read.
    (tmp_path / "v0000000004" / "mv_state_sales").mkdir(parents=True)
    assert rollups.read_all(spark, root)["mv_state_sales"].count() > 0
    with pytest.raises(FileNotFoundError):
        rollups.read_all(spark, str(tmp_path / "nothing"))


def test_reconcile_finds_a_stale_view(spark, shop, tmp_path):
    rollups.refresh(spark, shop, str(tmp_path), ["mv_state_sales"])
    view = metrics.state_ranking(rollups.read_all(spark, str(tmp_path))["mv_state_sales"], 2017)
    base = diagnostics.state_ranking_base(shop, 2017)
    keys, measures = ["customer_state"], ["total_gmv", "total_orders"]
    fresh = reconcile.reconcile(view, base, keys, measures).first()
    assert (fresh.unmatched_keys, fresh.max_diff_total_gmv, fresh.max_diff_total_orders) == (0, 0, 0)
    # Orders that came after the refresh: one state changes, another is new.
    later = base.withColumn("total_orders", F.when(F.col("customer_state") == "SP", F.col("total_orders") + 1).otherwise(F.col("total_orders")))
    later = later.unionByName(base.limit(1).withColumn("customer_state", F.lit("ZZ")))
    stale = reconcile.reconcile(view, later, keys, measures).first()
    assert stale.unmatched_keys == 1 and stale.max_diff_total_orders >= 1


def test_partial_refresh_carries_the_others_over(spark, shop, tmp_path):
    root = str(tmp_path)
    rollups.refresh(spark, shop, root)
    every = set(rollups.read_all(spark, root))
    assert every == set(rollups.BUILDERS)
    for _ in range(3):
        rollups.refresh(spark, shop, root, ["mv_state_sales"], kept_versions=2)
    stored = rollups.read_all(spark, root)
    assert set(stored) == every
    assert all(frame.count() >= 0 for frame in stored.values())


def test_two_writers_of_one_number_both_publish(spark, shop, tmp_path):
    root = str(tmp_path)
    rollups.refresh(spark, shop, root, ["mv_monthly_sales"])
    first = rollups._manifest(spark, root, "v0000000001")
    # Another writer took number 2 in between: ours becomes number 3 over it.
    (tmp_path / "v0000000002").mkdir()
    (tmp_path / "v0000000002" / rollups.COMPLETE).write_text(
        '{"mv_monthly_sales": "%s", "mv_payment_dist": "%s"}' % (first["mv_monthly_sales"], first["mv_monthly_sales"]))
    version = rollups._publish(spark, root, {"mv_state_sales": first["mv_monthly_sales"]})
    assert version == "v0000000003"
    assert set(rollups._manifest(spark, root, version)) == {"mv_monthly_sales", "mv_payment_dist", "mv_state_sales"}


def test_crash_before_commit_is_not_read(spark, shop, tmp_path):
    root = str(tmp_path)
    rollups.refresh(spark, shop, root, ["mv_state_sales"])
    before = rollups._manifest(spark, root, "v0000000001")
    (tmp_path / "data" / "mv_state_sales-broken").mkdir(parents=True)
    (tmp_path / "v0000000002").mkdir()
    assert rollups.versions(spark, root) == ["v0000000001"]
    assert rollups._manifest(spark, root, rollups.versions(spark, root)[-1]) == before


def test_reconcile_counts_null_against_value_and_matches_null_keys(spark):
    view = spark.createDataFrame([("A", None), (None, 5.0), ("B", 1.0)], "k string, m double")
    base = spark.createDataFrame([("A", 500.0), (None, 7.0), ("C", 2.0)], "k string, m double")
    row = reconcile.reconcile(view, base, ["k"], ["m"]).first()
    assert (row.view_rows, row.base_rows, row.unmatched_keys) == (3, 3, 2)
    assert row.max_diff_m == 2.0 and row.null_mismatch_m == 1
