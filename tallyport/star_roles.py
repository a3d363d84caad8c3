"""Commerce roles derived from a directory of star-schema Parquet tables.

The star schema has no delivery dates, payments or review texts of its own, so
these follow from its columns by fixed rules; every role stays a lazy query over
whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.numbers import units
from tallyport.roles import Commerce
from tallyport.schemas import BASE_TABLES
from tallyport.session import Tables

# English names of the part types; STANDARD has none on purpose, so the fallback to
# the original name is exercised.
TRANSLATION = [
    ("ECONOMY", "economy_goods"),
    ("LARGE", "large_goods"),
    ("MEDIUM", "medium_goods"),
    ("PROMO", "promotion_goods"),
    ("SMALL", "small_goods"),
]

ESTIMATED_DAYS = 30
LEAD_DAYS = 45  # delivery takes 0-43 days, the last value means "no date"

# Narrow rows are stored compactly: a step per order reads up to 1.6 times the stored bytes of its tables from shuffles.
INPUT_PER_PARTITION = 32 * 1024 * 1024


def _orders(orders: DataFrame) -> DataFrame:
    bought = F.col("o_orderdate")
    lead = F.pmod(units("o_totalprice"), F.lit(LEAD_DAYS)).cast("int")

    def after(days: Column) -> Column:
        return F.timestamp_add("DAY", days, bought)

    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        bought.alias("order_approved_at"),
        after(F.lit(1)).alias("order_delivered_carrier_date"),
        F.when(lead != LEAD_DAYS - 1, after(lead)).alias("order_delivered_customer_date"),
        after(F.lit(ESTIMATED_DAYS)).alias("order_estimated_delivery_date"),
    )


def _order_items(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") * F.rint(F.col("l_tax") * 100) * 0.5).alias("freight_value"),
    )


def _products(parts: DataFrame) -> DataFrame:
    size = F.col("p_size")
    return parts.select(
        F.col("p_partkey").alias("product_id"),
        F.when(size != 50, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").cast("double").alias("product_name_length"),
        F.lit(None).cast("double").alias("product_description_length"),
        (size % 5).cast("double").alias("product_photos_qty"),
        (size * 250).cast("double").alias("product_weight_g"),
        (size + 10).cast("double").alias("product_length_cm"),
        (size % 20 + 2).cast("double").alias("product_height_cm"),
        (size % 30 + 6).cast("double").alias("product_width_cm"),
    )


def _customers(customers: DataFrame, nations: DataFrame) -> DataFrame:
    """Two customer ids share a unique id."""
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.expr("c_custkey div 2").alias("customer_unique_id"),
        F.pmod("c_custkey", F.lit(1000)).cast("int").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def _sellers(suppliers: DataFrame, nations: DataFrame) -> DataFrame:
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("seller_id"),
        F.pmod("s_suppkey", F.lit(1500)).cast("int").alias("seller_zip_code_prefix"),
        F.lit("SELLER CITY").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def _payments(orders: DataFrame) -> DataFrame:
    """One payment per order, and a voucher beside it for every fifth customer."""
    main = F.struct(
        F.lit(1).alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        (F.pmod("o_custkey", F.lit(14)) + 1).cast("int").alias("payment_installments"),
        F.col("o_totalprice").alias("payment_value"),
    )
    voucher = F.struct(
        F.lit(2).alias("payment_sequential"),
        F.lit("VOUCHER").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.lit(10.0).alias("payment_value"),
    )
    both = F.when(F.col("o_custkey") % 5 == 0, F.array(main, voucher)).otherwise(F.array(main))
    return orders.select(F.col("o_orderkey").alias("order_id"), F.inline(both))


def _order_reviews(lines: DataFrame) -> DataFrame:
    """One scored review per order and return flag."""
    flag = F.col("flag")
    return (
        lines.groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_returnflag").alias("flag"))
        .agg(F.max("l_shipdate").alias("seen"))
        .select(
            F.concat_ws("-", "order_id", "flag").alias("review_id"),
            "order_id",
            F.when(flag == "R", 1).when(flag == "A", 3).otherwise(5).alias("review_score"),
            F.lit("").alias("review_comment_title"),
            F.lit("").alias("review_comment_message"),
            F.col("seen").alias("review_creation_date"),
            F.timestamp_add("DAY", F.lit(2), F.col("seen")).alias("review_answer_timestamp"),
        )
    )


def _text_reviews(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents review the order of the same number; labels give the stars."""
    stars = F.col("quality") * 2 + (1 - F.col("toxic")) * 2 + 1
    return documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("review_id"),
        F.col("doc_id").alias("order_id"),
        stars.cast("int").alias("review_score"),
        F.col("source").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.lit(None).cast("timestamp").alias("review_creation_date"),
        F.lit(None).cast("timestamp").alias("review_answer_timestamp"),
    )


def _geolocation(customers: DataFrame, nations: DataFrame) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return customers.join(nations, nation == F.col("n_nationkey")).select(
        F.pmod(key, F.lit(1000)).cast("int").alias("geolocation_zip_code_prefix"),
        (nation - 20 + F.pmod(key, F.lit(4)) * 0.25).cast("double").alias("geolocation_lat"),
        (nation * 2 - 70 + F.pmod(key, F.lit(8)) * 0.125).cast("double").alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )


def from_star(spark: SparkSession, root: str, tables: Tables | None = None) -> Commerce:
    tables = tables or Tables(spark, INPUT_PER_PARTITION)
    spark = tables.spark

    def table(name: str) -> DataFrame:
        return tables.parquet(f"{root}/{name}.parquet")

    return Commerce(
        {
            "orders": lambda: _orders(table("orders")),
            "order_items": lambda: _order_items(table("lineitem")),
            "products": lambda: _products(table("part")),
            "customers": lambda: _customers(table("customer"), table("nation")),
            "sellers": lambda: _sellers(table("supplier"), table("nation")),
            "payments": lambda: _payments(table("orders")),
            "order_reviews": lambda: _order_reviews(table("lineitem")),
            "text_reviews": lambda: _text_reviews(table("documents"), table("labels")),
            "geolocation": lambda: _geolocation(table("customer"), table("nation")),
            "translation": lambda: spark.createDataFrame(
                TRANSLATION, BASE_TABLES["product_category_name_translation"]
            ),
        },
        delivered_status="F",
    )
