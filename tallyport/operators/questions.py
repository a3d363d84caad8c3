"""Tag and enrich a table of business questions.

Input rows have a `question` text column; rule lists are parameters, the defaults
below are the fixed English and Chinese signal words. The same functions work on a
streaming frame, except those that look at earlier turns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyport.functions.text import contains_any

# Signal words. Patterns such as 'on.time' are literal text.
TYPE_SIGNALS = (
    ("predictive", ("预测", "predict", "forecast", "未来")),
    ("prescriptive", ("如何降低", "如何提升", "如何改善", "怎样降低", "如何优化", "如何改进")),
    ("diagnostic", ("为什么", "原因", "why", "哪些.*差评", "差评率", "退货")),
    ("prescriptive", ("建议", "优化", "改进", "策略", "recommend", "how to", "方案")),
)
DEFAULT_TYPE = "descriptive"

PART_SIGNALS = {
    "state_sales": ("哪个州", "销售额最高", "各州", "州排名"),
    "delivery": ("准时", "配送", "交付", "延迟"),
    "payment": ("支付", "分期"),
}

REPORT_SIGNALS = {
    "line": (
        "trend", "趋势", "monthly", "月度", "sales trend", "销售趋势", "overview", "概览", "预测", "predict",
        "forecast", "未来", "时间序列",
    ),
    "geo_map": ("state", "州", "geo", "地理", "region", "区域", "map", "地图", "巴西", "brazil", "分布"),
    "payment_bar": ("payment", "支付", "installment", "分期"),
    "payment_heatmap": ("payment", "支付", "installment", "分期"),
    "wordcloud": ("review", "评论", "评价", "差评", "好评", "sentiment", "情感", "评分", "反馈", "退货"),
    "category_bar": ("category", "品类", "类别", "product category"),
    "scatter": (
        "weight", "重量", "freight", "运费", "shipping", "尺寸", "size", "关系", "关联", "correlation", "相关性",
    ),
    "delivery_bar": (
        "delivery", "配送", "delay", "延迟", "on.time", "准时", "物流", "deliver", "ontime", "送达", "时效",
    ),
    "basket_bar": ("basket", "客单价", "avg order", "average basket"),
}
DEFAULT_REPORTS = (
    "line", "geo_map", "state_bar", "payment_bar", "payment_heatmap", "category_bar", "scatter",
)

REVIEW_SIGNALS = (
    "review", "reviews", "comment", "comments", "complaint", "complaints", "sentiment", "theme", "themes",
    "topic", "topics", "feedback", "refund", "return", "评论", "评价", "差评", "好评", "情感", "主题", "投诉",
    "抱怨", "反馈", "满意", "不满意", "退货", "客服", "口碑",
)
FORECAST_SIGNALS = ("预测", "predict", "forecast", "未来", "趋势预测")
WHAT_IF_SIGNALS = (
    "what-if", "what if", "scenario", "simulate", "simulation", "hypothetical", "remove", "exclude",
    "screening", "假设", "如果", "模拟", "情景", "下架", "移除", "剔除", "筛选",
)
WHAT_IF_TARGETS = (
    "seller", "卖家", "remove", "exclude", "screening", "下架", "移除", "剔除", "what", "如果", "假设", "模拟",
)
ANOMALY_SIGNALS = (
    "anomaly", "anomalies", "abnormal", "outlier", "alert", "scan", "spike", "drop", "异常", "告警", "预警",
    "扫描", "突增", "暴跌", "异常检测", "波动",
)
FOLLOW_UP_SIGNALS = (
    "these", "those", "them", "that", "same", "above", "previous", "continue", "follow up", "再", "继续",
    "进一步", "这些", "那些", "上述", "上面", "它们", "他们", "这些州", "这些品类", "这些卖家", "刚才",
)
SHORT_CUES = ("why", "原因", "建议", "优化", "show", "compare")
SHORT_LENGTH = 36


@dataclass(frozen=True)
class Rules:
    types: Sequence[tuple[str, Sequence[str]]] = TYPE_SIGNALS
    parts: Mapping[str, Sequence[str]] = field(default_factory=lambda: PART_SIGNALS)
    reports: Mapping[str, Sequence[str]] = field(default_factory=lambda: REPORT_SIGNALS)
    reviews: Sequence[str] = REVIEW_SIGNALS
    forecast: Sequence[str] = FORECAST_SIGNALS
    what_if: Sequence[str] = WHAT_IF_SIGNALS
    what_if_targets: Sequence[str] = WHAT_IF_TARGETS
    anomaly: Sequence[str] = ANOMALY_SIGNALS
    follow_up: Sequence[str] = FOLLOW_UP_SIGNALS
    short_cues: Sequence[str] = SHORT_CUES


DEFAULT_RULES = Rules()


def analysis_type(question: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """First rule with a signal word in the question wins."""
    q = F.lower(question)
    chain = None
    for name, words in rules.types:
        hit = contains_any(q, words)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain.otherwise(DEFAULT_TYPE)


def tag_type(questions: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return questions.withColumn("analysis_type", analysis_type(F.col("question"), rules))


def top_n(question: Column, default: int = 20, at_most: int | None = None) -> Column:
    """First whole number in the question, at least 1 and at most `at_most` if given.

    A number beyond a long is null: no row count can mean it.
    """
    digits = F.regexp_extract(question, r"(\d+)", 1)
    number = F.when(digits != "", F.greatest(F.lit(1).cast("long"), digits.try_cast("long")))
    number = F.when(digits.try_cast("long").isNotNull(), number)
    if at_most is not None:
        number = F.least(F.lit(at_most).cast("long"), F.when(digits != "", F.coalesce(number, F.lit(at_most).cast("long"))))
    return F.when(digits == "", F.lit(default).cast("long")).otherwise(number)


def horizon_weeks(question: Column, default: int = 6) -> Column:
    """Forecast length in weeks; weeks win over days over months."""

    def amount(pattern: str) -> Column:
        digits = F.regexp_extract(question, pattern, 1)
        # A number beyond a quarter of a long names no horizon.
        number = digits.try_cast("long")
        return F.when(number <= F.lit((2**63 - 1) // 4), number)

    weeks, days, months = amount(r"(\d+)\s*周"), amount(r"(\d+)\s*天"), amount(r"(\d+)\s*个?月")
    # greatest() skips nulls, so an absent number of days must stay absent.
    from_days = F.when(days.isNotNull(), F.greatest(F.lit(1).cast("long"), F.floor(days / 7)))
    return F.coalesce(weeks, from_days, months * 4, F.lit(default).cast("long"))


def with_params(questions: DataFrame) -> DataFrame:
    q = F.col("question")
    return questions.withColumn("top_n", top_n(q)).withColumn("horizon_weeks", horizon_weeks(q))


def split_parts(questions: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per part of a question; a question with one topic stays whole."""
    q = F.lower("question")
    topics = F.array_compact(
        F.array(*[F.when(contains_any(q, words), F.lit(name)) for name, words in rules.parts.items()])
    )
    return (
        questions.withColumn("_parts", topics)
        .withColumn("_parts", F.when(F.size("_parts") >= 2, F.col("_parts")).otherwise(F.array(F.lit("whole"))))
        .withColumn("part", F.explode("_parts"))
        .drop("_parts")
    )


def needed_jobs(questions: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Flags for the jobs a question calls for. Needs analysis_type."""
    q, kind = F.lower("question"), F.col("analysis_type")
    return (
        questions.withColumn(
            "needs_reviews", contains_any(q, rules.reviews) | kind.isin("diagnostic", "prescriptive")
        )
        .withColumn("needs_forecast", (kind == "predictive") | contains_any(q, rules.forecast))
        .withColumn("needs_what_if", contains_any(q, rules.what_if) & contains_any(q, rules.what_if_targets))
        .withColumn("needs_anomaly", contains_any(q, rules.anomaly))
    )


def select_reports(questions: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per question and report that fits it. Needs analysis_type."""
    q, kind = F.lower("question"), F.col("analysis_type")
    none = F.array().cast("array<string>")
    named = F.array_compact(
        F.array(*[F.when(contains_any(q, words), F.lit(name)) for name, words in rules.reports.items()])
    )
    default = F.array(*[F.lit(name) for name in DEFAULT_REPORTS])

    def plus(condition: Column, *names: str) -> Column:
        return F.when(condition, F.array(*[F.lit(n) for n in names])).otherwise(none)

    base = questions.withColumn("_named", named).withColumn(
        "_chosen", F.when(F.size("_named") > 0, F.col("_named")).otherwise(default)
    )
    typed = base.withColumn(
        "_chosen",
        F.concat(
            "_chosen",
            plus(kind.isin("diagnostic", "prescriptive"), "wordcloud", "delivery_bar"),
            plus(kind == "predictive", "line"),
        ),
    )
    linked = typed.withColumn(
        "_chosen",
        F.concat(
            "_chosen",
            plus(F.array_contains("_chosen", "geo_map"), "state_bar"),
            plus(F.array_contains("_chosen", "wordcloud"), "category_bar"),
        ),
    )
    return linked.withColumn("report", F.explode(F.array_distinct("_chosen"))).drop("_named", "_chosen")


def is_follow_up(question: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Names earlier context, or is short and only makes sense with it."""
    q = F.lower(F.trim(question))
    short = F.length(q) <= SHORT_LENGTH
    return contains_any(q, rules.follow_up) | (short & contains_any(q, rules.short_cues))


def previous_in_group(rows: DataFrame, group: str, position: str, value: str, block: int = 10_000) -> DataFrame:
    """Add `previous`: the value of the row before, by position, within its group.

    A window over a whole group would put a huge group into one task. Positions are
    cut into blocks instead: a window runs inside each block of at most `block`
    positions, and the first row of a block takes the last value of the nearest
    earlier block, found on one small row per block.
    """
    blocked = rows.withColumn("_block", F.floor(F.col(position) / F.lit(block)))
    # The value itself breaks ties between rows at the same position.
    inside = Window.partitionBy(group, "_block").orderBy(position, value)
    lagged = blocked.withColumn("_in_block", F.lag(value).over(inside)).withColumn(
        "_first", F.row_number().over(inside) == 1
    )
    ends = blocked.groupBy(group, "_block").agg(F.max_by(value, F.struct(position, value)).alias("_last"))
    before = ends.select(
        group, "_block", F.lag("_last").over(Window.partitionBy(group).orderBy("_block")).alias("_before")
    ).filter(F.col("_before").isNotNull())
    # Only first rows match, so a huge group meets one row per block.
    return (
        lagged.join(before.withColumn("_first", F.lit(True)), [group, "_block", "_first"], "left")
        .withColumn("previous", F.coalesce("_in_block", "_before"))
        .drop("_block", "_first", "_in_block", "_before")
    )


def follow_up_context(
    turns: DataFrame, group: str = "conv_id", position: str = "turn", rules: Rules = DEFAULT_RULES,
    block: int = 10_000,
) -> DataFrame:
    """Questions with the previous question of the same conversation attached.

    A question that refers back gets the earlier one as context; others keep their
    wording.
    """
    asked = turns.filter(F.col("role") == "user").select(group, position, F.col("text").alias("question"))
    chained = previous_in_group(asked, group, position, "question", block)
    follows = is_follow_up(F.col("question"), rules) & F.col("previous").isNotNull()
    context = F.concat(F.lit("Previous question: "), F.trim("previous"))
    return chained.select(
        group,
        position,
        "question",
        follows.alias("is_follow_up"),
        F.when(follows, context).otherwise("").alias("memory_context"),
    )


def focus_entities(
    results: DataFrame, thread: str, entities: Mapping[str, Sequence[str]], k: int = 8,
    first_rows: int | None = None, position: str | None = None, result: str | None = None,
) -> DataFrame:
    """The k most common values of each entity kind in earlier results of a thread.

    `entities` maps a kind to the columns that carry it. With `first_rows` only the
    first rows of each result by `position` count, as a chat memory would do; `result`
    is the column that tells the results of a thread apart.
    """
    if first_rows is not None:
        order = Window.partitionBy(thread, *([result] if result else [])).orderBy(position)
        results = results.withColumn("_row", F.row_number().over(order)).filter(F.col("_row") <= first_rows)
    present = [(kind, col) for kind, cols in entities.items() for col in cols if col in results.columns]
    pairs = F.array(
        *[F.struct(F.lit(kind).alias("kind"), F.trim(F.col(col).cast("string")).alias("value")) for kind, col in present]
    )
    counts = (
        results.select(thread, F.inline(pairs))
        .filter(F.col("value").isNotNull() & (F.col("value") != ""))
        .groupBy(thread, "kind", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy(thread, "kind").orderBy(F.desc("n"), "value")
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .groupBy(thread, "kind")
        .agg(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda x: x["value"]).alias("values")
        )
    )


# Labels of the entity kinds in a memory context, and its wording.
ENTITY_LABELS = {
    "states": "Previous focus states: ",
    "categories": "Previous focus categories: ",
    "sellers": "Previous focus sellers: ",
    "payments": "Previous payment methods: ",
}
ENTITY_COLUMNS = {
    "states": ("customer_state", "seller_state", "state"),
    "categories": ("category", "product_category_english", "product_category_name"),
    "sellers": ("seller_id",),
    "payments": ("payment_type",),
}
FINDING_LABELS = {"findings": "Previous findings: ", "anomalies": "Previous anomaly scan: "}
MEMORY_HEADER = "[Conversation memory for resolving references]"
MEMORY_CLOSING = (
    "If the user says these/those/above/same, interpret it using the previous focus entities and findings."
)


def resolve_with_entities(
    follow_ups: DataFrame, entities: DataFrame, thread: str, findings: DataFrame | None = None
) -> DataFrame:
    """Extend the context of follow-up questions by what is known of their thread.

    `follow_ups` comes from `follow_up_context`, `entities` from `focus_entities`;
    `findings` has a row per thread with the text columns `findings` and `anomalies`,
    either of which may be null or empty. All carry the thread column. Adds
    `resolved_question`.
    """
    if findings is None:
        none = F.lit(None).cast("string")
        known = follow_ups.select("*", none.alias("findings"), none.alias("anomalies"))
    else:
        known = follow_ups.join(findings.select(thread, *FINDING_LABELS), thread, "left")
    per_thread = entities.groupBy(thread).pivot("kind", list(ENTITY_LABELS)).agg(F.first("values"))
    lines = [
        F.concat(F.lit(label), F.array_join(kind, ", ")) for kind, label in ENTITY_LABELS.items()
    ]
    mapping = F.concat_ws(
        "; ", *[F.concat(F.lit(kind + "="), F.array_join(kind, ", ")) for kind in ENTITY_LABELS]
    )
    found = [F.when(F.trim(name) != "", F.concat(F.lit(label), F.trim(name))) for name, label in FINDING_LABELS.items()]
    context = F.concat_ws("\n", "memory_context", *lines, *found)
    resolved = F.concat_ws(
        "\n",
        "question",
        F.lit(""),
        F.lit(MEMORY_HEADER),
        context,
        F.when(mapping != "", F.concat(F.lit("Reference mapping: "), mapping)),
        F.lit(MEMORY_CLOSING),
    )
    return (
        known.join(per_thread, thread, "left")
        .withColumn("resolved_question", F.when(F.col("is_follow_up"), resolved).otherwise(F.col("question")))
        .withColumn("memory_context", F.when(F.col("is_follow_up"), context).otherwise(""))
        .drop(*ENTITY_LABELS, *FINDING_LABELS)
    )
