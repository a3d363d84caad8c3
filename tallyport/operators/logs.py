"""Checks over logs: model responses, generated SQL text and query results."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyport.functions.text import let

# Verbs that change data or run code, and INTO, which writes wherever it stands.
BLOCKED_VERBS = ("DROP", "DELETE", "INSERT", "UPDATE", "TRUNCATE", "ALTER", "CREATE", "MERGE", "REPLACE", "GRANT",
                 "REVOKE", "RENAME", "CALL", "LOAD")

# Source prefix and suffix of table names, and names to correct.
TABLE_PREFIX = "olist_"
TABLE_SUFFIX = "_dataset"
TABLE_NAMES = {
    "order_payments": "payments",
    "order_review": "order_reviews",
    "order_item": "order_items",
}

# What SQL text is made of: literals (a backslash escapes the next character, as in
# MySQL), quoted names, comments, and all else.
SQL_PIECES = r"""(?s)'(?:[^'\\]|\\.|'')*'|"(?:[^"]|"")*"|--[^\n]*|/\*.*?\*/|[^'"/-]+|."""


def stripped(text: Column) -> Column:
    """Without white space, line breaks included, at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def unfenced(text: Column, language: str) -> Column:
    """The inside of the first code fence, or the whole text where there is none."""
    parts = F.split(text, "```")
    return F.when(F.size(parts) >= 3, F.regexp_replace(parts[1], rf"(?i)^{language}\b", "")).otherwise(text)


def table_names(code: Column) -> Column:
    """Table names without the source's prefix and suffix, known wrong ones corrected, in any case.

    Only names after FROM or JOIN and qualifiers before a dot are tables; column names and
    aliases stay as they are.
    """
    name = rf"(?:{TABLE_PREFIX})?([a-z_]\w*?)(?:{TABLE_SUFFIX})?"
    after_from = F.regexp_replace(code, rf"(?i)\b(FROM|JOIN)(\s+){name}\b", "$1$2$3")
    # The cheap look first: most code has no qualifier and no wrong name.
    bare = F.when(code.contains("."), F.regexp_replace(after_from, rf"(?i)\b{name}\.", "$1.")).otherwise(after_from)

    def corrected(bare: Column) -> Column:
        right_names = bare
        for wrong, right in TABLE_NAMES.items():
            right_names = F.regexp_replace(right_names, rf"(?i)\b(FROM|JOIN)(\s+){wrong}\b", f"$1$2{right}")
            right_names = F.regexp_replace(right_names, rf"(?i)\b{wrong}\.", f"{right}.")
        return F.when(bare.rlike("(?i)" + "|".join(TABLE_NAMES)), right_names).otherwise(bare)

    return let(bare, corrected)


def sql_pieces(sql: Column) -> Column:
    """The text cut into pieces, comments blanked, names in code corrected, literals untouched."""
    def mend(piece: Column) -> Column:
        comment = piece.startswith("--") | (piece.startswith("/*") & piece.endswith("*/"))
        return F.when(piece.startswith("'"), piece).when(comment, " ").otherwise(table_names(piece))

    return F.transform(F.regexp_extract_all(sql, F.lit(SQL_PIECES), F.lit(0)), mend)


def repaired_sql(sql: Column) -> Column:
    """SQL without comments, white space at its ends and a final semicolon, table names corrected."""
    return F.regexp_replace(F.array_join(sql_pieces(sql), ""), r"^\s+|[\s;]+$", "")


def outline(sql: Column) -> Column:
    """SQL with every literal and quoted name emptied, for looking at its structure."""
    empty = lambda p: F.when(p.startswith("'"), "''").when(p.startswith('"'), '""').otherwise(p)
    return F.array_join(F.transform(sql_pieces(sql), empty), "")


def changes_data(sql: Column) -> Column:
    """More than one statement, INTO, or a verb that changes data where a statement begins.

    A statement begins at the start, after a semicolon, after the WITH list (a closing
    bracket) and inside a bracket that is no function call, so `count(update)` and
    `replace(a, b, c)` pass while `WITH x AS (...) MERGE INTO ...` does not.
    """
    start = r"(?:^|[;)]|(?<![\w\s])\s*\(|\b(?:AS|FROM|JOIN|IN|EXISTS)\s*\()"
    verb = r"(?i)" + start + r"\s*(?:" + "|".join(BLOCKED_VERBS) + r")\b(?!\s*\()"
    return let(outline(sql), lambda bones: bones.rlike(verb) | bones.rlike(r"(?i)\bINTO\b") | bones.rlike(r";\s*[^\s;]"))


def screen_sql(log: DataFrame, column: str = "sql") -> DataFrame:
    """Add clean_sql and verdict: ok, empty, blocked (changes data or several statements) or not_select."""
    clean = F.col("clean_sql")
    return log.withColumn("clean_sql", repaired_sql(unfenced(F.col(column), "sql"))).withColumn(
        "verdict",
        F.when(clean.isNull() | (clean == ""), "empty")
        .when(changes_data(clean), "blocked")
        .when(clean.rlike(r"(?i)^\(*\s*(SELECT|WITH)\b"), "ok")
        .otherwise("not_select"),
    )


@dataclass(frozen=True)
class ResponseType:
    """Fields of one kind of response, in Spark's schema language, and what they must be.

    `defaults` fill absent fields, `choices` are the values a field may have: others
    make the response unusable, or become the default for fields in `lenient`; lists
    keep only their allowed members. Fields in `sql` are screened and repaired,
    `required` fields must be there.
    """

    fields: Mapping[str, str]
    defaults: Mapping[str, str] = field(default_factory=dict)
    choices: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    lenient: tuple[str, ...] = ()
    sql: tuple[str, ...] = ()
    required: tuple[str, ...] = ()


# The kinds of responses, their fields, defaults and allowed values.
STRATEGIES = ("view", "base_table", "error", "unknown")
ANALYSIS_TYPES = ("descriptive", "diagnostic", "predictive", "prescriptive")
REPORTS = (
    "line", "geo_map", "state_bar", "payment_bar", "payment_heatmap", "wordcloud", "category_bar", "scatter", "delivery_bar",
    "basket_bar",
)
RESPONSE_TYPES = {
    "query": ResponseType(
        fields={"strategy": "string", "reasoning": "string", "sql": "string", "summary": "string"},
        defaults={"strategy": "base_table", "reasoning": "", "sql": "", "summary": ""},
        choices={"strategy": STRATEGIES}, sql=("sql",),
    ),
    "plan": ResponseType(
        fields={"question_summary": "string", "analysis_type": "string", "tasks": "array<struct<agent string, task string>>",
                "final_synthesis": "string"},
        defaults={"question_summary": "", "analysis_type": "descriptive", "final_synthesis": ""},
        choices={"analysis_type": ANALYSIS_TYPES}, lenient=("analysis_type",),
    ),
    "correction": ResponseType(
        fields={"strategy": "string", "sql": "string", "reasoning": "string"},
        defaults={"strategy": "base_table", "reasoning": ""}, sql=("sql",), required=("sql",),
    ),
    "reports": ResponseType(fields={"charts": "array<string>"}, choices={"charts": REPORTS}),
    "sentiment": ResponseType(
        fields={"sentiment_summary": "string", "top_positive_keywords": "array<string>",
                "top_negative_keywords": "array<string>", "key_insights": "string"},
        defaults={"sentiment_summary": "", "key_insights": ""},
    ),
}
# The task every plan has.
FIRST_AGENT, FIRST_TASK = "data_analyst", "Analyze the user question"


def mended_json(text: Column) -> Column:
    """The object in the text with commas before a bracket dropped and missing brackets added.

    Quotes that are all escaped are taken as quotes.
    """
    def closed(plain: Column) -> Column:
        def with_brackets(missing: Column) -> Column:
            # What follows the last bracket is no part of a complete object.
            ended = F.when(missing <= 0, F.regexp_extract(plain, r"(?s).*\}", 0)).otherwise(F.regexp_replace(plain, r",\s*$", ""))
            return F.concat(F.regexp_replace(ended, r",(\s*[\]}])", "$1"), F.repeat(F.lit("}"), F.greatest(missing, F.lit(0))))

        return let(F.regexp_count(plain, F.lit(r"\{")) - F.regexp_count(plain, F.lit(r"\}")), with_brackets)

    unescaped = lambda t: F.when(t.rlike(r'^\{\s*\\"'), F.replace(t, F.lit('\\"'), F.lit('"'))).otherwise(t)
    return let(F.regexp_extract(text, r"(?s)\{.*", 0), lambda inside: let(unescaped(inside), closed))


def _read(text: Column, kind: ResponseType) -> Column:
    """The object as a struct, null if it is none.

    The reader takes names without quotes or in single ones; values in single quotes
    are no JSON. A corrupt-record column tells broken text from absent fields.
    """
    options = {"columnNameOfCorruptRecord": "_broken", "allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}
    schema = ", ".join(f"{n} {t}" for n, t in {**kind.fields, "_broken": "string"}.items())
    sound = lambda t: t.rlike(r"^\s*\{") & ~t.rlike(r":\s*'")
    whole = lambda parsed: F.when(parsed["_broken"].isNull(), parsed)
    return let(text, lambda t: F.when(sound(t), let(F.from_json(t, schema, options), whole)))


def _usable(read: Column, kind: ResponseType) -> Column:
    good = read.isNotNull()
    for name, allowed in kind.choices.items():
        if name not in kind.lenient and kind.fields[name] == "string":
            good = good & F.coalesce(read[name], F.lit(kind.defaults[name])).isin(*allowed)
    for name in kind.sql:
        good = good & ~changes_data(F.coalesce(F.trim(read[name]), F.lit("")))
    for name in kind.required:
        good = good & read[name].isNotNull()
    return good


def _field(read: Column, name: str, kind: ResponseType) -> Column:
    value, allowed = read[name], kind.choices.get(name)
    if kind.fields[name].startswith("array"):
        value = F.coalesce(value, F.array().cast(kind.fields[name]))
        return F.filter(value, lambda x: x.isin(*allowed)) if allowed else value
    if name in kind.defaults:
        value = F.coalesce(value, F.lit(kind.defaults[name]))
    if name in kind.lenient:
        value = F.when(value.isin(*allowed), value).otherwise(F.lit(kind.defaults[name]))
    return repaired_sql(value) if name in kind.sql else value


def parse_responses(responses: DataFrame, column: str = "response", kind: ResponseType = RESPONSE_TYPES["query"]) -> DataFrame:
    """Add the fields of the response type and `parsed` to a table of raw responses.

    The object is read as it stands in the fence or the text, else with its usual
    damage mended; what is no object, or breaks a rule of its type, has null fields.
    """
    def hit(body: Column) -> Column:
        # Every step is named once, and a text is mended only where it is no use as it stands.
        readings = (F.regexp_extract(body, r"(?s)\{.*\}", 0), mended_json(body))
        return F.coalesce(*[let(_read(t, kind), lambda r: F.when(_usable(r, kind), r)) for t in readings])

    found = responses.withColumn("_hit", let(unfenced(F.col(column), "json"), hit))
    fields = {n: F.when(F.col("_hit").isNotNull(), _field(F.col("_hit"), n, kind)) for n in kind.fields}
    return found.withColumns({**fields, "parsed": F.col("_hit").isNotNull()}).drop("_hit")


def parse_plans(responses: DataFrame, column: str = "response") -> DataFrame:
    """Plans; one without a task for the first agent gets that task added."""
    tasks = F.col("tasks")
    first = F.array(F.struct(F.lit(FIRST_AGENT).alias("agent"), F.lit(FIRST_TASK).alias("task")))
    lacking = ~F.exists(tasks, lambda t: F.coalesce(t["agent"] == FIRST_AGENT, F.lit(False)))
    return parse_responses(responses, column, RESPONSE_TYPES["plan"]).withColumn("tasks", F.when(lacking, F.concat(tasks, first)).otherwise(tasks))


def dedupe_results(results: DataFrame, sql: str, position: str, width: int | None = None) -> DataFrame:
    """Keep the first result per SQL text, or per its leading `width` characters if given.

    Results without SQL are all kept. Whole texts are compared by digest.
    """
    text = F.col(sql) if width is None else F.substring(sql, 1, width)
    key = F.when(F.coalesce(sql, F.lit("")) != "", F.sha2(text, 256))
    first = Window.partitionBy("_key").orderBy(position)
    keyed = results.withColumn("_key", F.coalesce(key, F.concat(F.lit("row "), F.col(position).cast("string"))))
    return keyed.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_key", "_rank")


def overall_strategy(results: DataFrame, group: str, position: str) -> DataFrame:
    """One strategy per group of results.

    A base_table result decides; otherwise the first result whose strategy is known
    does. Failed results count as 'error' and never as base_table.
    """
    strategy = F.when(F.col("failed"), "error").otherwise(F.col("strategy"))
    known = strategy != "unknown"
    return results.groupBy(group).agg(
        F.count(F.lit(1)).alias("results"),
        F.coalesce(
            F.when(F.bool_or(strategy == "base_table"), F.lit("base_table")),
            F.min_by(F.when(known, strategy), F.when(known, F.col(position))),
            F.lit("unknown"),
        ).alias("strategy"),
    )
