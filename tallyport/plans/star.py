"""The registered queries: every operator applied to the star-schema tables.

Each query is a function of (spark, directory) that reads whole tables. Arrays are
joined to text so that results compare column by column with plain SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyport.functions.dates import lenient_timestamp
from tallyport.functions.numbers import round_half_up
from tallyport.functions.text import normalise, tokens
from tallyport.operators import anomaly, diagnostics, forecast, ingest, logs, metrics, questions, reviews, rollups
from tallyport.operators import reconcile as compare
from tallyport.operators import sketches
from tallyport.operators import whatif
from tallyport.operators.reviews import Theme
from tallyport.plans.metric import metric
from tallyport.roles import Commerce
from tallyport.session import Tables
from tallyport.star_roles import from_star

Query = Callable[[SparkSession, str], DataFrame]
TableQuery = Callable[[Tables, str], DataFrame]
QUERIES: dict[str, Query] = {}

YEAR = 1997
TIME = "yyyy-MM-dd HH:mm:ss"

# The star schema's texts are invented words in four languages, so stop words,
# themes and signal words are short letter groups that occur in them.
STOP_WORDS = ("the", "and", "und", "die", "les", "los", "que")
THEMES = (
    Theme("Th words", ("thand", "thing", "ththe"), "Look at th."),
    Theme("Tion words", ("tioning", "ntion", "mention"), "Look at tion."),
    Theme("Heit words", ("heit", "keit", "ungen"), "Look at heit."),
    Theme("Eau words", ("eaux", "ouan", "elle"), "Look at eau."),
    Theme("Never words", ("zzzzqqq",), "Nothing to see."),
)
RULES = questions.Rules(
    types=(
        ("predictive", ("forecast", "eaux")),
        ("prescriptive", ("how to", "heit")),
        ("diagnostic", ("why", "tion")),
        ("prescriptive", ("recommend", "ando")),
    ),
    parts={"state_sales": ("ing", "ung"), "delivery": ("the", "der"), "payment": ("ion", "ich")},
    reports={
        "line": ("trend", "ou"), "geo_map": ("state", "ha"), "wordcloud": ("review", "ble"),
        "scatter": ("freight", "ein"),
    },
    reviews=("review", "ati"),
    forecast=("forecast", "ent"),
    what_if=("what if", "ere"),
    what_if_targets=("seller", "wh"),
    anomaly=("drop", "ish"),
    follow_up=("these", "that", "diese"),
    short_cues=("why", "und"),
)


def query(make: Callable[[Commerce], DataFrame]) -> Callable[[Commerce], DataFrame]:
    """Register a query over the commerce roles under the function's name."""
    QUERIES[make.__name__] = lambda spark, root: make(from_star(spark, root))
    return make


def table_query(make: TableQuery) -> TableQuery:
    """Register a query that reads star tables directly."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        return make(Tables(spark), root)

    QUERIES[make.__name__] = run
    return make


def on_rollup(name: str, rollup: str, apply: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, root: apply(rollups.published(from_star(spark, root), rollup))


def joined(name: str, separator: str = ", ") -> Column:
    return F.array_join(name, separator).alias(name)


# --- rollups -----------------------------------------------------------------

for _name in rollups.BUILDERS:
    QUERIES[_name] = lambda spark, root, _name=_name: rollups.published(from_star(spark, root), _name)


@query
def mv_seller_perf_exact(c):
    return rollups.seller_perf_exact(c)


@query
def rollup_row_counts(c):
    return rollups.row_counts(rollups.build_all(c))


# --- metrics on rollups ------------------------------------------------------

MONTHLY, STATES, CATEGORIES, DELIVERY, SELLERS, PAYMENTS = (
    "mv_monthly_sales", "mv_state_sales", "mv_category_sales", "mv_delivery_perf", "mv_seller_perf",
    "mv_payment_dist",
)

on_rollup("monthly_series", MONTHLY, metrics.monthly_series)
on_rollup("monthly_last_n", MONTHLY, metrics.monthly_last_n)
on_rollup("monthly_of_year", MONTHLY, lambda r: metrics.monthly_of_year(r, YEAR))
on_rollup("state_sales_of_year", STATES, lambda r: metrics.state_sales_of_year(r, YEAR))
on_rollup("top_states", STATES, lambda r: metrics.top_states(r, YEAR))
on_rollup("delivery_by_state", DELIVERY, metrics.delivery_by_state)
on_rollup("worst_delivery_states", DELIVERY, metrics.worst_delivery_states)
on_rollup("payment_popularity", PAYMENTS, metrics.payment_popularity)
on_rollup("worst_seller_months", SELLERS, lambda r: metrics.worst_seller_months(r, min_orders=2))
on_rollup("worst_sellers", SELLERS, metrics.worst_sellers)
on_rollup("basket_by_state", STATES, metrics.basket_by_state)
on_rollup("top_categories", CATEGORIES, metrics.top_categories)
on_rollup("geo_state_gmv", STATES, metrics.geo_state_gmv)
on_rollup("kpi_overview", MONTHLY, metrics.kpi_overview)
on_rollup("declining_categories", CATEGORIES, metrics.category_trends)
on_rollup("category_trends", CATEGORIES, lambda r: metrics.category_trends(r, only_declining=False))
on_rollup("what_if_sellers", SELLERS, lambda r: metrics.worst_sellers(r, n=5))
on_rollup("monthly_series_long", MONTHLY, lambda r: diagnostics.long_form(r, "ym", ["total_gmv", "total_orders"]))
on_rollup("anomaly_monthly_gmv", MONTHLY, lambda r: anomaly.monthly_gmv_outliers(r, 1.5))
on_rollup("anomaly_state_drop", STATES, anomaly.state_sales_drops)


@query
def gmv_growth(c):
    return metrics.growth(rollups.published(c, STATES), "customer_state")


@table_query
def delivery_by_region_states(tables, root):
    region = (
        tables.parquet(f"{root}/nation.parquet")
        .join(tables.parquet(f"{root}/region.parquet").filter("r_name = 'AMERICA'"),
              F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("customer_state"))
    )
    delivery = rollups.published(from_star(tables.spark, root, tables), DELIVERY)
    return metrics.delivery_by_region_states(delivery, region)


@table_query
def adhoc_cte_sql(tables, root):
    c = from_star(tables.spark, root, tables)
    for name in ("orders", "customers"):
        getattr(c, name).createOrReplaceTempView(f"commerce_{name}")
    return tables.spark.sql("""
        WITH spread AS (
            SELECT customer_state, order_status, COUNT(*) AS orders,
                   LISTAGG(DISTINCT CAST(year(order_purchase_timestamp) AS STRING), ',')
                     WITHIN GROUP (ORDER BY CAST(year(order_purchase_timestamp) AS STRING)) AS years
            FROM commerce_orders JOIN commerce_customers USING (customer_id)
            GROUP BY 1, 2
        )
        SELECT customer_state, order_status, orders, years
        FROM spread WHERE orders >= 2
        ORDER BY customer_state, order_status
    """)


# --- base-table diagnostics --------------------------------------------------


@query
def delivery_routes(c):
    return diagnostics.delivery_routes(c, min_orders=2)


@query
def weight_freight_bins(c):
    return diagnostics.weight_freight_bins(c)


@query
def weight_freight_bins_bounded(c):
    return diagnostics.weight_freight_bins(c, max_weight=50000, max_freight=200)


@query
def weight_freight_ontime(c):
    return diagnostics.weight_freight_ontime(c)


@query
def negative_categories(c):
    return diagnostics.negative_categories(c)


@query
def category_reviews(c):
    return diagnostics.category_reviews(c)


@query
def installment_share(c):
    return diagnostics.installment_share(c)


@query
def installment_share_bounded(c):
    return diagnostics.installment_share(c, 1, 12)


@query
def installment_matrix(c):
    return diagnostics.installment_matrix(c)


@query
def review_category_rows(c):
    return reviews.by_category(reviews.review_rows(c)).select(
        "review_id", "review_score", "category", "weight", "review_comment_message"
    )


@query
def state_centroids(c):
    return diagnostics.state_centroids(c, metrics.geo_state_gmv(rollups.published(c, STATES)))


@query
def state_sales_of_year_base(c):
    return diagnostics.state_ranking_base(c, YEAR)


@query
def platform_score(c):
    return diagnostics.platform_score(c.order_reviews)


@query
def worst_example_per_category(c):
    return diagnostics.worst_example_per_category(c, c.text_reviews)


@query
def order_detail(c):
    return diagnostics.order_detail(c, c.text_reviews)


@query
def slow_states(c):
    return diagnostics.slow_states(c)


@query
def seller_negative_rate(c):
    return diagnostics.seller_negative_rate(c)


@query
def weight_freight_corr(c):
    return diagnostics.weight_freight_corr(c)


@query
def trim_p95(c):
    return diagnostics.trim_p95(diagnostics.weight_freight_bins(c), "weight_g", "freight")


@query
def axis_ranges(c):
    return diagnostics.axis_ranges(diagnostics.weight_freight_bins(c), "weight_g", "freight")


# --- view-first metrics and reconciliation -----------------------------------


def _stored(tables: Tables, root: str, *names: str) -> tuple[Commerce, dict[str, DataFrame]]:
    """Rollups refreshed into the warehouse and read back from there, and the base tables."""
    c = from_star(tables.spark, root, tables)
    folder = f"{tables.spark.conf.get('spark.sql.warehouse.dir')}/tallyport-rollups-{hashlib.md5(root.encode()).hexdigest()}"
    rollups.refresh(tables.spark, c, folder, names)
    return c, rollups.read_all(tables.spark, folder)


@table_query
def metric_view_hit(tables, root):
    c, stored = _stored(tables, root, STATES)
    return metric(c, stored, ["customer_state"], ["total_gmv", "total_orders", "avg_basket"], {"ym": f"{YEAR}*"})


@query
def metric_base_fallback(c):
    return metric(
        c, rollups.build_all(c), ["customer_state", "category"], ["total_gmv", "total_orders", "unique_customers"]
    )


@query
def metric_base_fallback_of_year(c):
    """No rollup has cities: base tables, the year as a range of purchase times."""
    return metric(c, {}, ["customer_state", "customer_city"], ["total_gmv", "total_orders", "avg_price"], {"ym": f"{YEAR}*"})


@query
def metric_review_score_by_state(c):
    return metric(c, {}, ["customer_state"], ["avg_review_score", "review_count", "negative_review_rate"])


@query
def metric_review_score_by_category(c):
    return metric(c, {}, ["category"], ["avg_review_score", "review_count"])


@query
def metric_gmv_and_on_time(c):
    """Two rollups meet on the state."""
    return metric(c, rollups.build_all(c), ["customer_state"], ["total_gmv", "on_time_rate"])


@query
def metric_gmv_and_payments(c):
    return metric(c, rollups.build_all(c), ["ym"], ["total_gmv", "total_value", "avg_review_score"])


@table_query
def reconcile_state_sales(tables, root):
    c, stored = _stored(tables, root, STATES)
    view = metrics.state_ranking(stored[STATES], YEAR)
    base = diagnostics.state_ranking_base(c, YEAR)
    return compare.reconcile(view, base, ["customer_state"], ["total_gmv", "total_orders"])


# --- anomalies and what-if ---------------------------------------------------


def _alerts(c: Commerce) -> DataFrame:
    return anomaly.all_alerts(
        anomaly.monthly_gmv_outliers(rollups.published(c, MONTHLY), 1.5),
        anomaly.state_sales_drops(rollups.published(c, STATES)),
        anomaly.review_score_drops(anomaly.category_month_scores(c), 0.01),
    )


@query
def anomaly_score_drop(c):
    return anomaly.review_score_drops(anomaly.category_month_scores(c), 0.01)


@query
def anomaly_alerts(c):
    return _alerts(c).select("type", "severity", "ym", "state", "category", "detail", "action_hint")


@query
def anomaly_summary(c):
    return anomaly.alert_summary(_alerts(c))


@query
def what_if_remove_worst(c):
    return whatif.remove_worst_sellers(c, rollups.published(c, SELLERS))


@query
def what_if_summary(c):
    return whatif.what_if_sentence(whatif.remove_worst_sellers(c, rollups.published(c, SELLERS)))


@query
def what_if_remove_categories(c):
    return whatif.remove_worst_categories(c)


# --- forecasts ---------------------------------------------------------------


def _history(c: Commerce) -> DataFrame:
    """All series: the platform, every state and every category."""
    return (
        forecast.series_of(rollups.published(c, MONTHLY), "total", F.lit("all"))
        .unionByName(forecast.series_of(rollups.published(c, STATES), "state", F.col("customer_state")))
        .unionByName(
            forecast.series_of(rollups.published(c, CATEGORIES), "category", F.col("product_category_english"))
        )
    )


@query
def forecast_history(c):
    return _history(c).withColumn("ds", F.date_format("ds", "yyyy-MM-dd"))


@query
def forecast_trend_fit(c):
    return forecast.fit_trend(_history(c)).select(
        "series", "points",
        round_half_up(F.col("slope"), 4).alias("slope"),
        round_half_up(F.col("mean_y"), 2).alias("mean_y"),
        round_half_up(F.col("sigma"), 2).alias("sigma"),
    )


@query
def forecast_calendar(c):
    return forecast.calendar(_history(c), 6)


FORECASTS = {"forecast_daily": 1, "forecast_weekly": 6, "forecast_monthly": 26, "forecast_annual": 130}
for _name, _weeks in FORECASTS.items():
    QUERIES[_name] = lambda spark, root, _weeks=_weeks: forecast.forecast(
        _history(from_star(spark, root)), _weeks
    ).drop("ci_range")


@query
def forecast_interval_text(c):
    return forecast.forecast(_history(c), 6).select("series", "period", "ds", "ci_range")


@query
def forecast_direction(c):
    return forecast.direction(_history(c), 26)


@query
def forecast_summary(c):
    return forecast.summary(_history(c), 6)


# --- review texts ------------------------------------------------------------


@query
def text_normalise(c):
    return c.text_reviews.select("review_id", F.md5(normalise("review_comment_message")).alias("text_md5"))


@query
def text_tokens(c):
    words = tokens("review_comment_message", STOP_WORDS)
    return c.text_reviews.select(
        "review_id", F.size(words).cast("long").alias("n_tokens"), F.md5(F.array_join(words, " ")).alias("tokens_md5")
    )


@query
def review_keywords(c):
    return reviews.review_keywords(reviews.review_rows(c), STOP_WORDS)


@query
def word_frequencies(c):
    return reviews.review_keywords(reviews.review_rows(c), STOP_WORDS, 100)


def _themes(c: Commerce, kind: str) -> DataFrame:
    return (
        reviews.review_themes(reviews.review_rows(c), THEMES)
        .filter(F.col("sentiment") == kind)
        .select(
            "rank", "theme", "review_count", "share_pct", "avg_score", joined("top_keywords"),
            joined("top_categories"), "action_hint",
        )
    )


@query
def review_themes_neg(c):
    return _themes(c, "negative")


@query
def review_themes_pos(c):
    return _themes(c, "positive")


@query
def score_distribution(c):
    return reviews.score_distribution(reviews.review_rows(c))


@query
def review_summary(c):
    return reviews.review_summary(reviews.review_rows(c))


@query
def category_sentiment(c):
    return reviews.category_sentiment(reviews.review_rows(c))


@query
def worst_sentiment_categories(c):
    return reviews.worst_sentiment_categories(reviews.review_rows(c), below=4.5)


@query
def primary_negative_theme(c):
    return reviews.primary_negative_theme(c, THEMES, min_reviews=1)


@query
def decision_signals(c):
    return reviews.decision_signals(reviews.review_rows(c), THEMES)


@query
def sentiment_summary(c):
    # Scores, keywords and themes each read the rows.
    return reviews.sentiment_summary(reviews.review_rows(c), THEMES, STOP_WORDS)


@query
def merge_keyword_lists(c):
    ranked = reviews.ranked_words(reviews.review_keywords(reviews.review_rows(c), STOP_WORDS))
    both = ranked.agg(
        F.max(F.when(F.col("sentiment") == "positive", F.col("words"))).alias("positive"),
        F.max(F.when(F.col("sentiment") == "negative", F.col("words"))).alias("negative"),
    )
    merged = reviews.merge_keyword_lists(F.col("positive"), F.col("negative"))
    return both.select(F.array_join(merged, ",").alias("keywords"))


@query
def review_sample(c):
    return reviews.review_sample(reviews.review_rows(c))


# --- ingest ------------------------------------------------------------------


def _wide(c: Commerce) -> DataFrame:
    """A wide export: one row per order, item and payment, all columns of six entities."""
    return (
        c.order_items.join(c.orders, "order_id")
        .join(c.payments, "order_id")
        .join(c.customers, "customer_id")
        .join(c.products, "product_id")
        .join(c.sellers, "seller_id")
    )


ORDER_KEYS = ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value")


def _split(c: Commerce, entity: str) -> DataFrame:
    return ingest.split_entity(_wide(c), entity, (*ORDER_KEYS, "payment_sequential"))


@query
def split_orders(c):
    return ingest.normalise_types(_split(c, "orders"))


@query
def split_items(c):
    return ingest.normalise_types(_split(c, "order_items"))


@query
def split_products(c):
    return _split(c, "products")


@query
def split_customers(c):
    return _split(c, "customers")


@query
def split_sellers(c):
    return _split(c, "sellers")


@query
def split_payments(c):
    return _split(c, "payments")


@table_query
def dedupe_keep_first(tables, root):
    lines = tables.parquet(f"{root}/lineitem.parquet")
    order = [
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    ]
    return ingest.keep_first(lines, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        F.date_format("l_shipdate", TIME).alias("l_shipdate"),
    )


@query
def parse_ts_lenient(c):
    text = F.date_format("order_purchase_timestamp", TIME)
    broken = (
        F.when(F.col("order_id") % 5 == 0, F.concat(F.lit("on "), text))
        .when(F.col("order_id") % 7 == 0, F.replace(text, F.lit("-"), F.lit("/-")))
        .when(F.col("order_id") % 11 == 0, F.lit(""))
        .otherwise(text)
    )
    return c.orders.select("order_id", F.date_format(lenient_timestamp(broken), TIME).alias("bought_at"))


@query
def fill_text_nulls(c):
    sparse = c.text_reviews.select(
        "review_id",
        F.when(F.col("review_score") >= 3, F.col("review_comment_title")).alias("review_comment_title"),
        F.when(F.col("review_score") < 3, F.col("review_comment_message")).alias("review_comment_message"),
    )
    filled = ingest.fill_text_nulls(sparse)
    return filled.select(
        "review_id", "review_comment_title", F.length("review_comment_message").cast("long").alias("message_length")
    )


@query
def zip_directory_union(c):
    return ingest.zip_directory(c.customers, c.sellers)


@query
def state_centroid_lookup(c):
    centres = {f"NATION_{i}": (-20.0 + i, -70.0 + 2 * i) for i in range(20)}
    return ingest.with_state_centre(ingest.zip_directory(c.customers, c.sellers), centres=centres)


@query
def category_translation(c):
    lower = c.products.select(
        F.concat(F.lower("product_category_name"), F.lit("_goods")).alias("product_category_name")
    )
    return ingest.category_translation(lower, {"economy_goods": "budget", "promo_goods": "promotion"})


@query
def normalise_types(c):
    nested = c.orders.select(
        "order_id",
        F.struct(
            F.col("order_purchase_timestamp").alias("bought"),
            F.to_date("order_estimated_delivery_date").alias("due"),
        ).alias("dates"),
        F.array(F.col("order_id").cast("decimal(20,2)") / F.lit(4).cast("decimal(4,0)")).alias("quarters"),
    )
    plain = ingest.normalise_types(nested)
    return plain.select(
        "order_id", F.col("dates.bought").alias("bought"), F.col("dates.due").alias("due"),
        F.get("quarters", F.lit(0)).alias("quarter"),
    )


# --- questions ---------------------------------------------------------------


def _questions(tables: Tables, root: str) -> DataFrame:
    """Conversation turns as questions; the turn number adds an amount to extract."""
    text = F.col("text")
    amount = F.when(F.col("turn") % 4 == 0, F.concat(text, F.lit(" top "), "conv_id"))
    amount = amount.when(F.col("turn") % 4 == 1, F.concat(text, F.lit(" "), "turn", F.lit(" 周")))
    amount = amount.when(F.col("turn") % 4 == 2, F.concat(text, F.lit(" "), "conv_id", F.lit("天")))
    return tables.parquet(f"{root}/conversations.parquet").select("conv_id", "turn", amount.otherwise(text).alias("question"))


@table_query
def question_type(tables, root):
    tagged = questions.needed_jobs(questions.tag_type(_questions(tables, root), RULES), RULES)
    return tagged.drop("question")


@table_query
def question_params(tables, root):
    return questions.with_params(_questions(tables, root)).drop("question")


@table_query
def question_params_bounded(tables, root):
    q = _questions(tables, root)
    return q.select("conv_id", "turn", questions.top_n(F.col("question"), at_most=100).alias("top_n"))


@table_query
def forecast_granularity(tables, root):
    weeks = F.col("horizon_weeks")
    return questions.with_params(_questions(tables, root)).select(
        "conv_id", "turn", weeks, forecast.granularity(weeks).alias("granularity"),
        forecast.periods(weeks).alias("periods"),
    )


@table_query
def question_parts(tables, root):
    return questions.split_parts(_questions(tables, root), RULES).drop("question")


@table_query
def question_reports(tables, root):
    return questions.select_reports(questions.tag_type(_questions(tables, root), RULES), RULES).drop("question")


@table_query
def followup_context(tables, root):
    turns = tables.parquet(f"{root}/conversations.parquet")
    return questions.follow_up_context(turns, rules=RULES)


@table_query
def resolved_questions(tables, root):
    """Follow-ups with their thread's memory: states are the first words of the answers, findings the whole last answer."""
    turns = tables.parquet(f"{root}/conversations.parquet")
    answers = turns.filter("role <> 'user'").select("conv_id", "turn", "text", F.split("text", " ")[0].alias("state"))
    last = F.max_by("text", F.struct("turn", "text"))
    findings = answers.groupBy("conv_id").agg(last.alias("findings"), F.lit(None).cast("string").alias("anomalies"))
    entities = questions.focus_entities(answers, "conv_id", questions.ENTITY_COLUMNS, k=2)
    asked = questions.follow_up_context(turns, rules=RULES)
    return questions.resolve_with_entities(asked, entities, "conv_id", findings)


@query
def focus_entities(c):
    results = (
        c.order_items.select("order_id", "seller_id", "product_id")
        .join(c.orders.select("order_id", "customer_id", "order_status"), "order_id")
        .join(c.customers.select("customer_id", "customer_state"), "customer_id")
        .join(c.products.select("product_id", F.col("product_category_name").alias("category")), "product_id")
    )
    found = questions.focus_entities(results, "order_status", questions.ENTITY_COLUMNS)
    return found.select("order_status", "kind", joined("values"))


# --- logs --------------------------------------------------------------------


def _responses(tables: Tables, root: str) -> DataFrame:
    """Model responses with every kind of damage, one per event."""
    kind = F.pmod("event_id", F.lit(11))
    sql = F.format_string("SELECT * FROM olist_orders_dataset WHERE k = %d", "event_id")
    good = F.format_string('{"strategy": "view", "sql": "%s", "summary": "%s"}', sql, "event_type")
    keys = F.format_string('{strategy: "base_table", sql: "%s", summary: "%s"}', sql, "event_type")
    return tables.parquet(f"{root}/events.parquet").select(
        "event_id",
        F.when(kind == 0, good)
        .when(kind == 1, F.concat(F.lit("Here:\n```json\n"), good, F.lit("\n```\nDone.")))
        .when(kind == 2, F.regexp_replace(good, r"\}$", ", }"))
        .when(kind == 3, keys)
        .when(kind == 4, F.regexp_replace(good, r'"(\w+)":', "'$1':"))
        .when(kind == 5, F.replace(good, F.lit('"'), F.lit('\\"')))
        .when(kind == 6, F.regexp_replace(good, r"\}$", ""))
        .when(kind == 7, F.concat(F.lit("The answer is "), good, F.lit(" as asked.")))
        .when(kind == 8, F.replace(good, F.lit("SELECT *"), F.lit("DROP TABLE")))
        .when(kind == 9, F.concat(F.lit("other fields: "), "props"))
        .otherwise(F.concat(F.lit("no json, "), "event_type"))
        .alias("response"),
    )


@table_query
def parse_responses(tables, root):
    return logs.parse_responses(_responses(tables, root)).drop("response")


def _typed_responses(tables: Tables, root: str) -> DataFrame:
    """Responses of four more types built from each event's type and number, some with damage."""
    third = F.pmod("event_id", F.lit(3))
    end = F.when(third == 0, ", }").when(third == 1, "").otherwise("}")
    text = lambda fmt, *cols: F.concat(F.format_string(fmt, *cols), end)
    kind = F.when(F.col("event_type") == "view", "predictive").otherwise(F.col("event_type"))
    agent = F.when(F.pmod("event_id", F.lit(2)) == 0, "data_analyst").otherwise(F.col("event_type"))
    verb = F.when(F.pmod("event_id", F.lit(5)) == 0, "DELETE FROM").otherwise("SELECT * FROM")
    plan = '{"question_summary": "%s", "analysis_type": "%s", "tasks": [{"agent": "%s", "task": "t%d"}]'
    return tables.parquet(f"{root}/events.parquet").select(
        "event_id",
        text(plan, "event_type", kind, agent, "event_id").alias("plan"),
        text('{"strategy": "view", "sql": "%s olist_orders_dataset", "reasoning": "%s"', verb, "event_type").alias("correction"),
        text('{"charts": ["line", "%s", "scatter"]', "event_type").alias("reports"),
        text('{"sentiment_summary": "%s", "top_positive_keywords": ["a%d"]', "event_type", "event_id").alias("sentiment"),
    )


def _typed(tables: Tables, root: str, name: str) -> DataFrame:
    return logs.parse_responses(_typed_responses(tables, root), name, logs.RESPONSE_TYPES[name])


@table_query
def parse_plans(tables, root):
    parsed = logs.parse_plans(_typed_responses(tables, root), "plan")
    tasks = F.array_join(F.transform("tasks", lambda t: F.concat_ws(":", t["agent"], t["task"])), "; ")
    return parsed.select("event_id", "question_summary", "analysis_type", tasks.alias("tasks"), "final_synthesis", "parsed")


@table_query
def parse_corrections(tables, root):
    return _typed(tables, root, "correction").select("event_id", "strategy", "sql", F.col("reasoning").alias("why"), "parsed")


@table_query
def parse_report_choices(tables, root):
    return _typed(tables, root, "reports").select("event_id", joined("charts"), "parsed")


@table_query
def parse_sentiments(tables, root):
    return _typed(tables, root, "sentiment").select(
        "event_id", "sentiment_summary", joined("top_positive_keywords"), joined("top_negative_keywords"), "key_insights", "parsed")


def _sql_log(c: Commerce) -> DataFrame:
    """Generated SQL, one per order: good, fenced, commented, misnamed, harmful, stacked, hidden in a WITH list."""
    kind = F.pmod("order_id", F.lit(12))
    plain = F.format_string("SELECT * FROM olist_order_items_dataset WHERE customer_id = %d", "customer_id")
    text = (
        F.when(kind == 0, plain)
        .when(kind == 1, F.concat(F.lit("```sql\n"), plain, F.lit(";\n```")))
        .when(kind == 2, F.concat(F.lit("-- generated\n"), plain, F.lit(" ;")))
        .when(kind == 3, F.lit("with x as (select 1 from OLIST_order_item) select * from x;"))
        .when(kind == 4, F.lit("drop table orders"))
        .when(kind == 5, F.lit("EXPLAIN SELECT 1"))
        .when(kind == 6, F.lit("SELECT * FROM order_payments JOIN order_review USING (order_id)"))
        .when(kind == 8, F.concat(plain, F.lit("; DROP TABLE orders")))
        .when(kind == 9, F.lit("WITH x AS (SELECT 1) DELETE FROM orders"))
        .when(kind == 10, F.concat(plain, F.lit(" AND note = 'olist_a; drop table x'")))
        .when(kind == 11, F.concat(F.lit("/* delete; */ "), plain, F.lit(" -- drop")))
        .otherwise(F.lit("  "))
    )
    return c.orders.select("order_id", text.alias("sql"))


@query
def screen_sql_log(c):
    return logs.screen_sql(_sql_log(c)).drop("sql")


@query
def dedupe_results(c):
    return logs.dedupe_results(_sql_log(c).filter("trim(sql) != ''"), "sql", "order_id")


@query
def dedupe_results_by_prefix(c):
    return logs.dedupe_results(_sql_log(c).filter("trim(sql) != ''"), "sql", "order_id", width=60).select("order_id")


@table_query
def strategy_summary(tables, root):
    kind = F.col("event_type")
    results = tables.parquet(f"{root}/events.parquet").select(
        F.concat_ws("-", "user_id", F.date_format("ts", "MMddHH")).alias("question_id"),
        "event_id",
        (kind == "error").alias("failed"),
        F.when(kind == "view", "view").when(kind == "purchase", "base_table").otherwise("unknown").alias("strategy"),
    )
    return logs.overall_strategy(results, "question_id", "event_id")


@query
def forecast_changepoints(c):
    """Trend with changes of slope for every series: slopes at both ends, last and next month fitted."""
    fits = forecast.fit_changepoints(_history(c))
    return fits.select("series", "points", *[round_half_up(F.col(x), 2).alias(x)
                                             for x in ("slope_start", "slope_end", "yhat_last", "yhat_next")])


# --- mergeable distinct counts ------------------------------------------------------


def _buyers(c):
    return rollups.order_totals(c).join(c.customers.select("customer_id", "customer_unique_id", "customer_state"),
                                        "customer_id").where(F.col("customer_unique_id").isNotNull())


@query
def unique_customers_sketched(c):
    """Unique customers of each state over all months from the sketch rollup, exact count beside it."""
    got = sketches.distinct_customers(sketches.customer_sketches(c), ["customer_state"])
    exact = _buyers(c).groupBy("customer_state").agg(F.count_distinct("customer_unique_id").alias("exact_customers"))
    return got.join(exact, "customer_state").select(
        "customer_state", "unique_customers", "exact_customers",
        (F.abs(F.col("unique_customers") - F.col("exact_customers")) <= F.col("error_bound")).alias("within_bound"))


@query
def returning_customers(c):
    """Customers of a month who bought again in the next month with sales, by sketch intersection, exact beside it."""
    got = sketches.returning_customers(sketches.customer_sketches(c))
    seen = _buyers(c).select("ym", "customer_unique_id").distinct()
    months = seen.select("ym").distinct().withColumn("next_ym", F.lead("ym").over(Window.orderBy("ym")))
    again = seen.alias("a").join(months, "ym").join(
        seen.select(F.col("ym").alias("next_ym"), "customer_unique_id"), ["next_ym", "customer_unique_id"])
    exact = again.groupBy("ym").agg(F.count(F.lit(1)).alias("exact_returning"))
    return got.join(exact, "ym", "left").select(
        "ym", "next_ym", "returning", F.coalesce("exact_returning", F.lit(0)).alias("exact_returning"),
        (F.abs(F.col("returning") - F.coalesce("exact_returning", F.lit(0))) <= F.col("error_bound")).alias("within_bound"))


@query
def price_quantiles(c):
    """Median, 95th and 99th percentile of all item prices, exact, found in rounds of bounded memory."""
    from tallyport.operators.quantiles import exact_percentile

    items = c.order_items.select("price")
    values = [exact_percentile(items, "price", p) for p in (0.5, 0.95, 0.99)]
    row = c.order_items.sparkSession.createDataFrame([tuple(values)], "p50 double, p95 double, p99 double")
    return row.select(*[round_half_up(F.col(x), 2).alias(x) for x in ("p50", "p95", "p99")])


@query
def items_with_seller_state(c):
    """Every item with its seller's state; a seller with a large share of items is joined where its items lie."""
    from tallyport.operators import hotkeys

    items = c.order_items.select("order_id", "order_item_id", "seller_id", "price")
    sellers = c.sellers.select("seller_id", "seller_state")
    return hotkeys.skew_join(items, sellers, "seller_id").select("order_id", "order_item_id", "seller_id", "seller_state", "price")
