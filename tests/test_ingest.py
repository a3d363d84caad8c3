import csv
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import CUSTOMERS, ITEMS, ORDERS, PAYMENTS, PRODUCTS, REVIEWS, SELLERS, rows_of
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType

from tallyport.functions.dates import lenient_timestamp
from tallyport.functions.numbers import exact_sum
from tallyport.operators import ingest
from tallyport.operators import rollups
from tallyport.plans.metric import catalogue, choose, metric
from tallyport.roles import from_catalog, from_parquet
from tallyport.schemas import BASE_TABLES, KEYS
from tallyport.sources import files


@pytest.fixture(scope="module")
def export(tmp_path_factory):
    """A wide export (order x item x payment), reviews and geolocation as CSV files."""
    root = tmp_path_factory.mktemp("export")
    header = [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
        "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
        "payment_sequential", "payment_type", "payment_installments", "payment_value", "customer_unique_id",
        "customer_zip_code_prefix", "customer_city", "customer_state", "product_category_name",
        "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm", "seller_zip_code_prefix", "seller_city",
        "seller_state",
    ]
    customers, products, sellers = ({r[0]: r for r in t} for t in (CUSTOMERS, PRODUCTS, SELLERS))
    lines = []
    for oid, cid, status, bought, done, due in ORDERS:
        for o, n, p, s, price, freight in ITEMS:
            for po, seq, kind, parts, value in PAYMENTS:
                if o == oid == po:
                    c = customers[cid]
                    lines.append([
                        oid, cid, status, bought, "not a date", bought, done or "", due, n, p, s, "2017-01-10 00:00:00",
                        price, freight, seq, kind, parts, value, *c[1:], products[p][1] or "", 10, 20, 1,
                        products[p][2], 10, 5, 2, *sellers[s][1:],
                    ])
    # A repeated order item whose city differs: the first row must win.
    copy = list(lines[0])
    copy[header.index("customer_city")] = "OTHER CITY"
    lines.append(copy)
    with open(root / "wide.csv", "w", newline="") as f:
        csv.writer(f).writerows([header, *lines])
    with open(root / "order_reviews.csv", "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(BASE_TABLES["order_reviews"].fieldNames())
        for r, o, score, title, message in REVIEWS:
            writer.writerow([r, o, "" if score is None else score, title or "", message, "2017-03-01 00:00:00", "soon"])
        writer.writerow(["r1", "o9", 1, "later copy", "line one\nline two", "", ""])
    with open(root / "geolocation.csv", "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(BASE_TABLES["geolocation"].fieldNames())
        writer.writerows([[1000, -23, -46, "a", "SP"], [1000, -99, -99, "b", "SP"], [2000, -22, -43, "c", "RJ"]])
    return root


def test_load_all_builds_nine_tables(spark, export, tmp_path):
    tables = files.load_all(
        spark, str(export / "wide.csv"), [str(export / "none*.csv"), str(export / "order_rev*.csv")],
        [str(export / "geolocation.csv")], str(tmp_path), {"beleza_saude": "beauty_health"},
    )
    assert set(tables) == set(BASE_TABLES)
    assert from_parquet(spark, str(tmp_path)).orders.count() == 4
    for name, frame in tables.items():
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in BASE_TABLES[name]], name
        assert frame.groupBy(*KEYS[name]).count().filter("count > 1").isEmpty(), name
    # o4 has no payment, so the export has no row of it.
    assert tables["orders"].count() == 4 and tables["order_items"].count() == 5 and tables["payments"].count() == 5
    cities = dict(rows_of(tables["customers"], "customer_id", "customer_city"))
    assert cities["c1"] == "sao paulo"
    orders = {r.order_id: r for r in tables["orders"].collect()}
    assert orders["o1"].order_approved_at is None
    assert orders["o1"].order_purchase_timestamp == datetime(2017, 1, 5, 10)
    reviews = {r.review_id: r for r in tables["order_reviews"].collect()}
    assert reviews["r1"].order_id == "o1" and reviews["r4"].review_score is None
    assert reviews["r3"].review_comment_title == "" and reviews["r5"].review_comment_message == ""
    assert reviews["r1"].review_answer_timestamp is None
    assert rows_of(tables["geolocation"], "geolocation_zip_code_prefix", "geolocation_lat") == [(1000, -23.0), (2000, -22.0)]
    assert rows_of(tables["product_category_name_translation"]) == [
        ("beleza_saude", "beauty_health"), ("coisas_raras", "coisas raras"),
    ]


def test_first_existing_prefers_earlier_patterns(spark, export):
    got = files.first_existing(spark, [str(export / "zzz*"), str(export / "*.csv")])
    assert [g.rsplit("/", 1)[1] for g in got] == ["geolocation.csv"]
    every = files.first_existing(spark, [str(export / "zzz*"), str(export / "*.csv")], every=True)
    assert [g.rsplit("/", 1)[1] for g in every] == ["geolocation.csv", "order_reviews.csv", "wide.csv"]
    assert files.first_existing(spark, [str(export / "zzz*")]) == []


def test_lenient_timestamp(spark):
    frame = spark.createDataFrame([("2017-01-05 10:00:00",), ("yesterday",), ("",), (None,)], "t string")
    assert [r[0] for r in frame.select(lenient_timestamp("t")).collect()] == [datetime(2017, 1, 5, 10), None, None, None]


def test_nan_becomes_null(spark):
    frame = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, i int")
    assert [r.x for r in ingest.nan_to_null(frame).orderBy("i").collect()] == [None, 2.0]


def test_normalise_types_reaches_into_containers(spark):
    frame = spark.createDataFrame(
        [Row(d=Decimal("1.23"), nested=[Row(value=Decimal("3.14"), at=datetime(2018, 1, 2, 3, 4, 5))])],
        "d decimal(10,2), nested array<struct<value decimal(10,2), at timestamp>>",
    )
    row = ingest.normalise_types(frame).first()
    assert row.d == 1.23 and row.nested[0].value == 3.14 and row.nested[0].at == "2018-01-02T03:04:05"


def test_zip_directory_and_centres(shop):
    directory = ingest.zip_directory(shop.customers, shop.sellers)
    got = rows_of(ingest.with_state_centre(directory))
    assert got == [
        (1000, "sao paulo", "SP", -23.55, -46.64), (1001, "sao paulo", "SP", -23.55, -46.64),
        (2000, "rio", "RJ", -22.84, -43.15), (3000, "maceio", "AL", -9.71, -35.73),
    ]
    odd = directory.withColumn("state", F.lit("XX"))
    assert rows_of(ingest.with_state_centre(odd), "lat", "lng")[0] == (-15.0, -47.0)


def test_catalogue_tables_and_reports(spark, shop, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop_db LOCATION '{tmp_path}/db'")
    try:
        files.create_tables(spark, "shop_db")
        files.create_tables(spark, "shop_db")
        assert files.table_names(spark, "shop_db") == sorted(BASE_TABLES)
        files.write_table(shop.orders, "shop_db.orders")
        files.write_table(shop.orders, "shop_db.orders")
        assert spark.table("shop_db.orders").count() == 5
        assert from_catalog(spark, "shop_db").delivered_orders().count() == 4
    finally:
        spark.sql("DROP DATABASE shop_db CASCADE")
    files.write_csv_report(shop.sellers, str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 2


def test_metric_prefers_rollups_and_falls_back(shop):
    assert choose(["ym"], ["total_gmv"]).name == "mv_monthly_sales"
    assert choose(["customer_state"], ["total_gmv"], ["ym"]).name == "mv_state_sales"
    assert choose(["category"], ["total_orders"]).name == "mv_category_sales"
    # Orders may not be added up over categories, customers not over months.
    assert choose(["ym"], ["total_orders", "avg_price"]).strategy == "base_table"
    assert choose(["customer_state"], ["unique_customers"]).strategy == "base_table"
    assert choose(["seller_state"], ["total_gmv"]).name == "mv_seller_perf"
    with pytest.raises(ValueError):
        choose(["moon_phase"], ["total_gmv"])


def test_metric_gives_the_same_from_view_and_base(shop):
    stored = rollups.build_all(shop)
    view = metric(shop, stored, ["customer_state"], ["total_gmv", "total_orders"], {"ym": "2017*"})
    base = metric(shop, stored, ["customer_state", "customer_city"], ["total_gmv", "total_orders"], {"ym": ["2017-01", "2017-02", "2017-03"]})
    assert rows_of(view, "customer_state", "total_gmv", "total_orders") == rows_of(
        base, "customer_state", "total_gmv", "total_orders"
    )
    assert {r.strategy for r in view.collect()} == {"view"} and {r.strategy for r in base.collect()} == {"base_table"}
    people = metric(shop, stored, ["customer_state"], ["unique_customers"])
    assert rows_of(people, "customer_state", "unique_customers") == [("RJ", 1), ("SP", 1)]
    pay = metric(shop, stored, ["customer_state", "payment_type"], ["total_transactions", "avg_installments"])
    assert ("SP", "credit_card", 2, 2.5) in rows_of(pay, "customer_state", "payment_type", "total_transactions", "avg_installments")
    late = metric(shop, stored, ["customer_state"], ["on_time_rate", "delayed_orders", "avg_delivery_days"])
    assert rows_of(late)[0][:4] == ("RJ", 100.0, 0, 20.0)


def test_catalogue_lists_every_measure(spark):
    got = {(r.source, r.measure) for r in catalogue(spark).collect()}
    assert ("mv_monthly_sales", "avg_basket") in got and ("delivered_items", "unique_customers") in got


def test_exports_with_decimals_and_nan_lose_nothing(spark, export, tmp_path):
    """Whole numbers written as 1.0 keep their keys; NaN and null spellings are null and break no sum."""
    rows = list(csv.reader(open(export / "wide.csv")))
    header, lines = rows[0], rows[1:]
    at = header.index
    for line in lines:
        for name in ("order_item_id", "payment_sequential", "payment_installments", "customer_zip_code_prefix"):
            line[at(name)] = f"{line[at(name)]}.0"
    lines[0][at("freight_value")], lines[1][at("customer_city")] = "NaN", "NULL"
    lines.append([*lines[1]])
    lines[-1][at("order_item_id")] = "1.5"
    with open(tmp_path / "wide.csv", "w", newline="") as f:
        csv.writer(f).writerows([header, *lines])
    wide = files.read_wide_csv(spark, str(tmp_path / "wide.csv"))
    tables = ingest.split_wide(wide)
    items, pay = tables["order_items"].collect(), tables["payments"].collect()
    assert len(items) == 5 and len(pay) == 5 and all(i.order_item_id is not None for i in items)
    assert sorted(p.payment_installments for p in pay) == [1, 1, 2, 3, 13]
    assert sum(i.freight_value is None for i in items) == 1
    total = tables["order_items"].agg(exact_sum("freight_value")).first()[0]
    assert total == round(sum(i.freight_value or 0 for i in items), 2)
    lost = ingest.lost_values(ingest.rename_misspelt(wide), "order_items").first()
    assert lost.order_item_id == 1 and lost.freight_value == 0 and lost.price == 0  # NaN spells a missing value


def test_whole_numbers_and_finite_values(spark):
    frame = spark.createDataFrame([("1",), ("1.0",), (" 2 ",), ("1e2",), ("1.5",), ("NaN",), ("inf",), ("x",), ("9007199254740993",), (None,)], "t string")
    cast = lambda kind: [r[0] for r in frame.select(ingest.cast_to(F.col("t"), kind)).collect()]
    assert cast(IntegerType()) == [1, 1, 2, 100, None, None, None, None, None, None]
    assert cast(LongType())[8] == 9007199254740993
    assert cast(DoubleType())[4:8] == [1.5, None, None, None]


def test_normalise_types_in_maps_and_fractions(spark):
    frame = spark.sql("SELECT map('a', cast(1.5 AS decimal(4,1))) m, timestamp'2018-01-02 03:04:05.456' t, timestamp'2018-01-02 03:04:05' u")
    row = ingest.normalise_types(frame).first()
    assert row.m == {"a": 1.5} and row.t == "2018-01-02T03:04:05.456000" and row.u == "2018-01-02T03:04:05"
