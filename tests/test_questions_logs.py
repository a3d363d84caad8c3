import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallyport.operators import logs, questions
from tallyport.streaming import questions as stream

# The validation questions with the analysis type the rules give.
QUESTIONS = [
    ("2017年哪个州的销售额最高？交付准时率是多少？哪种支付方式最受欢迎？", "descriptive"),
    ("为什么某些州的平均配送时长显著高于全国均值？哪些卖家的差评率最高？", "diagnostic"),
    ("根据历史订单趋势，预测未来6周的销售额", "predictive"),
    ("如何降低巴西东北部地区的高退货率？请给出具体的运营改进方案。", "prescriptive"),
    ("Why do these states fall behind?", "diagnostic"),
]


@pytest.fixture(scope="module")
def asked(spark):
    rows = [(i, q, t) for i, (q, t) in enumerate(QUESTIONS)]
    return spark.createDataFrame(rows, "id int, question string, expected string")


def test_analysis_type(asked):
    wrong = questions.tag_type(asked).filter("analysis_type <> expected")
    assert wrong.isEmpty()


def test_parts(asked):
    got = rows_of(questions.split_parts(asked), "id", "part")
    assert {p for i, p in got if i == 0} == {"state_sales", "delivery", "payment"}
    assert [p for i, p in got if i == 2] == ["whole"]


def test_params(spark):
    frame = spark.createDataFrame(
        [("Top 5 sellers",), ("no number",), ("2017 sales",), ("top 0",), ("预测未来 8 周",), ("未来15天",), ("3个月内",), ("2周和30天",),
         ("9" * 15,)],
        "question string",
    )
    got = [(r.top_n, r.horizon_weeks) for r in questions.with_params(frame).collect()]
    assert got == [(5, 6), (20, 6), (2017, 6), (1, 6), (8, 8), (15, 2), (3, 12), (2, 2), (10**15 - 1, 6)]
    bounded = [r[0] for r in frame.select(questions.top_n(F.col("question"), at_most=100)).collect()]
    assert bounded == [5, 20, 100, 1, 8, 15, 3, 2, 100]


def test_long_numbers_are_not_cut(spark):
    frame = spark.createDataFrame([("12345678901234567890 周",), ("99999999999999999999999999 sellers",), ("1234567890123456789 周",)], "question string")
    got = frame.select(questions.top_n(F.col("question")), questions.horizon_weeks(F.col("question")),
                       questions.top_n(F.col("question"), at_most=100)).collect()
    assert [tuple(r) for r in got] == [(None, 6, 100), (None, 6, 100), (1234567890123456789, 1234567890123456789, 100)]


def test_reports_and_overrides(asked):
    tagged = questions.tag_type(asked)
    got = rows_of(questions.select_reports(tagged), "id", "report")
    first = {r for i, r in got if i == 0}
    assert first == {"geo_map", "state_bar", "payment_bar", "payment_heatmap", "delivery_bar"}
    fallback = {r for i, r in rows_of(questions.select_reports(tagged.withColumn("question", F.lit("hm"))), "id", "report") if i == 2}
    assert fallback == set(questions.DEFAULT_REPORTS)


def test_jobs(asked):
    got = {r.id: r for r in questions.needed_jobs(questions.tag_type(asked)).collect()}
    assert got[2].needs_forecast and not got[2].needs_reviews
    assert got[1].needs_reviews and not got[1].needs_what_if
    assert not got[0].needs_anomaly


def test_follow_up_context_attaches_previous_question_and_entities(spark):
    turns = spark.createDataFrame(
        [("c", 0, "user", "Which states have the worst delivery on-time rates?"), ("c", 1, "assistant", "AL and MA"),
         ("c", 2, "user", "For these states, what should we improve?"), ("c", 4, "user", "Total sales of last year in every region please"),
         ("d", 0, "user", "For these states?")],
        "conv_id string, turn long, role string, text string",
    )
    results = spark.createDataFrame([("c", "AL"), ("c", "MA"), ("c", "MA")], "conv_id string, customer_state string")
    context = questions.follow_up_context(turns)
    entities = questions.focus_entities(results, "conv_id", questions.ENTITY_COLUMNS)
    got = {(r.conv_id, r.turn): r for r in questions.resolve_with_entities(context, entities, "conv_id").collect()}
    follow = got["c", 2]
    assert follow.is_follow_up and "AL" in follow.memory_context and "MA" in follow.memory_context
    assert follow.memory_context.startswith("Previous question: Which states")
    assert "[Conversation memory" in follow.resolved_question
    assert "states=MA, AL" in follow.resolved_question
    assert not got["c", 4].is_follow_up and got["c", 4].resolved_question.startswith("Total sales")
    assert not got["d", 0].is_follow_up


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_previous_in_group_equals_a_plain_window(spark, block):
    rows = [(g, p, f"{g}{p}") for g in "ab" for p in (0, 1, 2, 5, 9, 10, 31, 32)]
    frame = spark.createDataFrame(rows, "g string, p long, v string")
    got = {(r.g, r.p): r.previous for r in questions.previous_in_group(frame, "g", "p", "v", block).collect()}
    for g in "ab":
        positions = [p for q, p, _ in rows if q == g]
        assert [got[g, p] for p in positions] == [None] + [f"{g}{p}" for p in positions[:-1]]


def test_focus_entities_of_first_rows_only(spark):
    results = spark.createDataFrame([("t", i, "SP" if i < 3 else "RJ") for i in range(10)], "thread string, pos int, state string")
    every = questions.focus_entities(results, "thread", questions.ENTITY_COLUMNS).first()
    first = questions.focus_entities(results, "thread", questions.ENTITY_COLUMNS, first_rows=3, position="pos").first()
    assert every["values"] == ["RJ", "SP"] and first["values"] == ["SP"]


GOOD = {"strategy": "view", "reasoning": "r", "sql": "SELECT 1 FROM olist_orders", "summary": "s"}


@pytest.mark.parametrize(
    "text, strategy, sql",
    [
        (json.dumps(GOOD), "view", "SELECT 1 FROM orders"),
        ("Sure:\n```json\n" + json.dumps(GOOD, indent=1) + "\n```", "view", "SELECT 1 FROM orders"),
        ('{"strategy": "view", "sql": "SELECT 1",}', "view", "SELECT 1"),
        ('{strategy: "view", sql: "SELECT 1"}', "view", "SELECT 1"),
        ("{'strategy': \"view\", 'sql': \"SELECT 1\"}", "view", "SELECT 1"),
        ('{\\"strategy\\": \\"view\\", \\"sql\\": \\"SELECT 1\\"}', "view", "SELECT 1"),
        ('{"strategy": "view", "sql": "SELECT 1"', "view", "SELECT 1"),
        ('prefix {"sql": "SELECT 1"} suffix', "base_table", "SELECT 1"),
        ("{}", "base_table", ""),
        ('\n\n{"sql": "SELECT 1"}\n', "base_table", "SELECT 1"),
        ("{'strategy': 'view'}", None, None),
        ('{"sql": "\\n drop table x"}', None, None),
        ('{"strategy": "magic"}', None, None),
        ('{"sql": "drop table x"}', None, None),
        ("no json here", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_parse_responses(spark, text, strategy, sql):
    row = logs.parse_responses(spark.createDataFrame([(text,)], "response string")).first()
    assert (row.strategy, row.sql, row.parsed) == (strategy, sql, strategy is not None)


@pytest.mark.parametrize(
    "sql, clean, verdict",
    [
        ("SELECT * FROM olist_order_items_dataset", "SELECT * FROM order_items", "ok"),
        ("SELECT * FROM olist_products", "SELECT * FROM products", "ok"),
        ("SELECT * FROM OLIST_orders", "SELECT * FROM orders", "ok"),
        ("SELECT * FROM order_reviews_dataset", "SELECT * FROM order_reviews", "ok"),
        ("SELECT * FROM olist_order_item", "SELECT * FROM order_items", "ok"),
        ("SELECT * FROM order_payments p", "SELECT * FROM payments p", "ok"),
        ("```sql\nWITH x AS (SELECT 1) SELECT * FROM x;\n```", "WITH x AS (SELECT 1) SELECT * FROM x", "ok"),
        ("-- note\nselect 1 ;  ", "select 1", "ok"),
        ("  delete from orders", "delete from orders", "blocked"),
        ("\n\tupdate orders set x = 1", "update orders set x = 1", "blocked"),
        ("SHOW TABLES", "SHOW TABLES", "not_select"),
        ("SELECT 1; DROP TABLE orders", "SELECT 1; DROP TABLE orders", "blocked"),
        ("SELECT 1; SELECT 2", "SELECT 1; SELECT 2", "blocked"),
        ("WITH x AS (SELECT 1) DELETE FROM orders", "WITH x AS (SELECT 1) DELETE FROM orders", "blocked"),
        ("WITH x AS (DELETE FROM orders RETURNING 1) SELECT * FROM x", "WITH x AS (DELETE FROM orders RETURNING 1) SELECT * FROM x", "blocked"),
        ("SELECT 'olist_a; drop table x' FROM olist_a", "SELECT 'olist_a; drop table x' FROM a", "ok"),
        ("SELECT 'it''s -- ; (delete' AS t", "SELECT 'it''s -- ; (delete' AS t", "ok"),
        ("/* drop */ SELECT updated, created_at FROM orders -- end;", "SELECT updated, created_at FROM orders", "ok"),
        ("SELECT 5 - 3 / 2", "SELECT 5 - 3 / 2", "ok"),
        ("(SELECT 1)", "(SELECT 1)", "ok"),
        (None, None, "empty"),
        ("", "", "empty"),
    ],
)
def test_screen_sql(spark, sql, clean, verdict):
    row = logs.screen_sql(spark.createDataFrame([(sql,)], "sql string")).first()
    assert (row.clean_sql, row.verdict) == (clean, verdict)


def test_dedupe_results_by_leading_sql(spark):
    long = "SELECT " + "a" * 100
    rows = [(1, long + "1"), (2, long + "2"), (3, "SELECT 2"), (4, None), (5, None), (6, "SELECT 2")]
    frame = spark.createDataFrame(rows, "id int, sql string")
    assert rows_of(logs.dedupe_results(frame, "sql", "id", width=100), "id") == [(1,), (3,), (4,), (5,)]
    # By default the whole text counts.
    assert rows_of(logs.dedupe_results(frame, "sql", "id"), "id") == [(1,), (2,), (3,), (4,), (5,)]


def test_overall_strategy(spark):
    rows = [("a", 1, "view", False), ("a", 2, "base_table", False), ("b", 1, "view", True), ("b", 2, "view", False),
            ("c", 1, "unknown", False), ("c", 2, "view", False), ("d", 1, "unknown", False), ("e", 1, "base_table", True)]
    frame = spark.createDataFrame(rows, "q string, seq int, strategy string, failed boolean")
    got = dict(rows_of(logs.overall_strategy(frame, "q", "seq"), "q", "strategy"))
    assert got == {"a": "base_table", "b": "error", "c": "view", "d": "unknown", "e": "error"}


def test_stream_tags_each_question_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first = spark.createDataFrame([("1", "预测未来 4 周")], "question_id string, question string")
    first.coalesce(1).write.json(source)
    stream.run_available(spark, source, target, state).awaitTermination(120)
    spark.createDataFrame([("2", "why top 3?")], "question_id string, question string").coalesce(1).write.mode("append").json(source)
    stream.run_available(spark, source, target, state).awaitTermination(120)
    got = rows_of(spark.read.parquet(target), "question_id", "analysis_type", "top_n", "horizon_weeks")
    assert got == [("1", "predictive", 4, 4), ("2", "diagnostic", 3, 6)]


@pytest.mark.parametrize(
    "kind, text, want",
    [
        ("plan", '{"question_summary": "q", "analysis_type": "odd", "tasks": [{"agent": "x", "task": "y"}]', {"analysis_type": "descriptive"}),
        ("correction", '{"sql": "SELECT 1 FROM olist_orders;"}', {"sql": "SELECT 1 FROM orders", "strategy": "base_table"}),
        ("correction", '{"strategy": "view"}', None),
        ("reports", 'Here: {"charts": ["line", "pie", "scatter"],}', {"charts": ["line", "scatter"]}),
        ("reports", "{}", {"charts": []}),
        ("sentiment", '{"sentiment_summary": "good", "top_positive_keywords": ["a"]}', {"top_positive_keywords": ["a"], "top_negative_keywords": []}),
        ("sentiment", "[1, 2]", None),
    ],
)
def test_other_response_types(spark, kind, text, want):
    row = logs.parse_responses(spark.createDataFrame([(text,)], "response string"), kind=logs.RESPONSE_TYPES[kind]).first()
    assert row.parsed == (want is not None)
    assert want is None or {k: row[k] for k in want} == want


def test_focus_entities_take_the_first_rows_of_each_result(spark):
    rows = [("t", q, i, "SP" if q == 1 else "RJ") for q in (1, 2) for i in range(30)]
    results = spark.createDataFrame(rows, "thread string, result int, pos int, state string")
    got = questions.focus_entities(results, "thread", questions.ENTITY_COLUMNS, first_rows=20, position="pos", result="result").first()
    assert got["values"] == ["RJ", "SP"]


def test_follow_ups_carry_findings_and_a_closing_line(spark):
    asked = spark.createDataFrame(
        [("c", 2, "For these states?", True, "Previous question: Which"), ("c", 4, "Total", False, "")],
        "conv_id string, turn int, question string, is_follow_up boolean, memory_context string")
    entities = spark.createDataFrame([("c", "states", ["AL"])], "conv_id string, kind string, `values` array<string>")
    findings = spark.createDataFrame([("c", "Late in AL", "No spikes")], "conv_id string, findings string, anomalies string")
    got = {r.turn: r for r in questions.resolve_with_entities(asked, entities, "conv_id", findings).collect()}
    assert got[2].memory_context.split("\n") == [
        "Previous question: Which", "Previous focus states: AL", "Previous findings: Late in AL", "Previous anomaly scan: No spikes"]
    assert got[2].resolved_question.endswith(questions.MEMORY_CLOSING) and "states=AL" in got[2].resolved_question
    assert got[4].resolved_question == "Total" and got[4].memory_context == ""


SCREEN_CASES = [
    ("SELECT '\\''; DROP TABLE orders; -- '", "blocked"), ("WITH x AS (SELECT 1) MERGE INTO t USING x ON 1 = 1", "blocked"),
    ("WITH x AS (SELECT 1) REPLACE INTO t VALUES (1)", "blocked"), ("SELECT * INTO backup FROM orders", "blocked"),
    ("SELECT count(update) FROM t", "ok"), ("SELECT replace(a, 'x', 'y') FROM t", "ok"),
    ("WITH x AS (DELETE FROM t) SELECT 1", "blocked"), ("SELECT 'it''s; drop' FROM t", "ok"),
]


def test_screen_literals_verbs_and_into(spark):
    from tallyport.operators import logs

    frame = spark.createDataFrame(SCREEN_CASES, "sql string, want string")
    got = {r.sql: r.verdict for r in logs.screen_sql(frame).collect()}
    assert got == dict(SCREEN_CASES)


def test_only_table_names_are_repaired(spark):
    from tallyport.operators import logs

    frame = spark.createDataFrame([("SELECT a AS my_dataset, olist_orders_dataset.b FROM olist_orders_dataset",)], "sql string")
    assert logs.screen_sql(frame).first().clean_sql == "SELECT a AS my_dataset, orders.b FROM orders"


@pytest.mark.parametrize("kind", list(logs.RESPONSE_TYPES))
def test_a_response_is_read_once_as_it_stands_and_once_mended(spark, kind):
    rows = spark.createDataFrame([("{}",)], "response string")
    plan = logs.parse_responses(rows, kind=logs.RESPONSE_TYPES[kind])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2
    # The object is cut out of the text once for each reading.
    assert plan.count(r"(?s)\{.*,") == 1 and plan.count(r"(?s)\{.*\},") == 1


def test_the_outline_of_a_statement_is_made_once(spark):
    plan = spark.range(1).select(logs.changes_data(F.concat(F.col("id").cast("string"), F.lit("x"))).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1
