"""Review text mining: keywords, themes, sentiment figures.

A review counts once per item of its order, under the category of the item. The
input keeps one row per review, so that a text is read, normalised and tokenised
once: `weight` is the number of items and `categories` an array of (category,
weight) over the distinct categories of the order. Every count below is a sum of
weights.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyport.functions.numbers import fixed_text, percent, ratio, ratio_rounded
from tallyport.functions.text import has_text, is_token, matched, normalise, words
from tallyport.operators.diagnostics import negative_categories
from tallyport.operators.facts import order_category_items
from tallyport.roles import Commerce


@dataclass(frozen=True)
class Theme:
    name: str
    keywords: Sequence[str]
    hint: str


# Portuguese stop words of review texts.
STOP_WORDS_PT = """
a o e de da do das dos para por em com uma um que se nao no na os as aos
foi sua seu ele ela mais ja muito assim entre esse essa estao
porque produto entrega recebi chegou compra comprar prazo antes depois
bom boa bem ruim otimo excelente pessimo recomendo super veio comprei
""".split()

# Theme names, keywords and hints.
THEMES_PT = (
    Theme(
        "Delivery delay / logistics reliability",
        ("demora", "atraso", "prazo", "entrega", "transportadora", "chegou", "recebi"),
        "Review carrier SLAs, late-delivery lanes, and proactive delay messaging.",
    ),
    Theme(
        "Product damage or quality defect",
        ("defeito", "quebrado", "danificado", "avariado", "qualidade", "estragado", "peca"),
        "Tighten seller packaging checks and quality-control sampling.",
    ),
    Theme(
        "Wrong, missing, or incomplete item",
        ("errado", "diferente", "faltou", "falta", "troca", "incompleto", "pedido"),
        "Audit seller fulfillment accuracy and incomplete-order handling.",
    ),
    Theme(
        "Customer service / refund friction",
        ("atendimento", "resposta", "reembolso", "devolucao", "cancelamento", "suporte"),
        "Create fast-lane support workflows for refund and seller-response delays.",
    ),
    Theme(
        "Positive product satisfaction",
        ("excelente", "otimo", "perfeito", "recomendo", "adorei", "amei", "satisfeito"),
        "Use high-satisfaction sellers and categories as operating benchmarks.",
    ),
    Theme(
        "Price / value perception",
        ("preco", "barato", "valor", "custo", "beneficio", "promocao"),
        "Protect value perception in categories where customers mention price positively.",
    ),
)

NO_THEME = "Other / insufficient text"
NO_THEME_SUMMARY = "No dominant negative text theme detected from keyword topic rules."



def review_rows(c: Commerce) -> DataFrame:
    """All reviews with text whose order has items of a known product."""
    texts = c.text_reviews.filter(F.col("review_comment_message").isNotNull()).select(
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message"
    )
    # The array holds the distinct categories of one order, never its items. Only orders with a
    # text review matter, which are few beside all items.
    reviewed = texts.select("order_id").distinct().join(c.orders.select("order_id"), "order_id", "left_semi")
    categories = (
        order_category_items(c, reviewed)
        .groupBy("order_id")
        .agg(
            F.sum("item_rows").alias("weight"),
            F.collect_list(F.struct("category", F.col("item_rows").alias("weight"))).alias("categories"),
        )
    )
    return texts.join(categories, "order_id").drop("order_id")


def single_category_rows(reviews: DataFrame) -> DataFrame:
    """Reviews with a plain `category` column in the shape the functions below take."""
    one = F.lit(1).cast("long").alias("weight")
    return reviews.select(
        *[name for name in reviews.columns if name != "category"],
        one,
        F.array(F.struct(F.col("category").cast("string").alias("category"), one)).alias("categories"),
    )


def by_category(rows: DataFrame) -> DataFrame:
    """One row per review and category with the weight of that category."""
    return rows.select(*[n for n in rows.columns if n not in ("weight", "categories")], F.inline("categories"))


def sentiment(score: Column) -> Column:
    """'positive' from four stars, 'negative' up to two, else null."""
    return F.when(score >= 4, "positive").when(score <= 2, "negative")


def with_sentiment(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sentiment", sentiment(F.col("review_score"))).filter(F.col("sentiment").isNotNull())


def review_keywords(rows: DataFrame, stop_words: Sequence[str] = STOP_WORDS_PT, k: int = 15) -> DataFrame:
    """The k most frequent words of positive and of negative reviews.

    Tokens are counted, not reviews; equal counts are ranked by word.
    """
    counts = (
        with_sentiment(rows)
        .select("sentiment", "weight", F.explode(words("review_comment_message")).alias("word"))
        .filter(is_token(F.col("word"), stop_words))
        .groupBy("sentiment", "word")
        .agg(F.sum("weight").alias("n"))
    )
    order = Window.partitionBy("sentiment").orderBy(F.desc("n"), "word")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked_words(keywords: DataFrame) -> DataFrame:
    """One row per sentiment with its keywords as an ordered array (k is bounded)."""
    return keywords.groupBy("sentiment").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda w: w["word"]).alias("words")
    )


def merge_keyword_lists(first: Column, second: Column, k: int = 15) -> Column:
    """Two ranked lists as one: first list first, repeats dropped, k kept."""
    empty = F.array().cast("array<string>")
    both = F.concat(F.coalesce(first, empty), F.coalesce(second, empty))
    return F.slice(F.array_distinct(both), 1, k)


def _theme_hits(rows: DataFrame, themes: Sequence[Theme]) -> DataFrame:
    """(sentiment, theme_no, category) with weights, score sums and keyword counts.

    One pass over the texts: each review emits a row per theme it mentions and a
    row with theme_no -1 that stands for the review itself. All later steps work
    on these few aggregated rows.
    """
    text = F.col("text")
    hits = F.array(
        F.struct(F.lit(-1).alias("theme_no"), F.array().cast("array<string>").alias("words")),
        *[
            F.struct(F.lit(i).alias("theme_no"), matched(text, theme.keywords).alias("words"))
            for i, theme in enumerate(themes)
        ],
    )
    widest = max(len(theme.keywords) for theme in themes)
    word_counts = []
    for j in range(widest):
        # The j-th keyword of whichever theme the row belongs to.
        word = F.element_at(
            F.array(*[F.lit(t.keywords[j] if j < len(t.keywords) else None).cast("string") for t in themes]),
            F.greatest(F.col("hit.theme_no") + 1, F.lit(1)),
        )
        word_counts.append(
            F.sum(F.when(F.array_contains("hit.words", word), F.col("weight")).otherwise(0)).alias(f"word_{j}")
        )
    return (
        with_sentiment(rows)
        .filter(has_text("review_comment_message"))
        .select("sentiment", "review_score", "categories", normalise("review_comment_message").alias("text"))
        .select(
            "sentiment", "review_score", "categories",
            F.explode(F.filter(hits, lambda h: (h["theme_no"] < 0) | (F.size(h["words"]) > 0))).alias("hit"),
        )
        .select("sentiment", "review_score", "hit", F.inline("categories"))
        .groupBy("sentiment", F.col("hit.theme_no").alias("theme_no"), "category")
        .agg(
            F.sum("weight").alias("n"),
            F.sum(F.col("review_score").cast("long") * F.col("weight")).alias("score"),
            *word_counts,
        )
    )


def _theme_value(themes: Sequence[Theme], pick) -> Column:
    """Look a property of a theme up by theme_no."""
    return F.element_at(F.array(*[F.lit(pick(t)) for t in themes]), F.col("theme_no") + 1)


def review_themes(
    rows: DataFrame, themes: Sequence[Theme] = THEMES_PT, top: int = 5, limit: int | None = None
) -> DataFrame:
    """Keyword themes of positive and negative reviews, most mentioned first.

    A review belongs to every theme of which it contains a keyword. share_pct is
    the share of the reviews of that sentiment with non-empty text.
    """
    hits = _theme_hits(rows, themes)
    counters = [name for name in hits.columns if name.startswith("word_")]
    by_category = Window.partitionBy("sentiment", "theme_no").orderBy(
        F.col("category").isNull(), F.desc("n"), "category"
    )
    ranked = hits.withColumn("category_rank", F.row_number().over(by_category))
    per_theme = ranked.groupBy("sentiment", "theme_no").agg(
        F.sum("n").alias("review_count"),
        F.sum("score").alias("score"),
        F.transform(
            F.array_sort(
                F.collect_list(
                    F.when(
                        (F.col("category_rank") <= top) & F.col("category").isNotNull(),
                        F.struct("category_rank", "category"),
                    )
                )
            ),
            lambda x: x["category"],
        ).alias("top_categories"),
        *[F.sum(w).alias(w) for w in counters],
    )
    # At most one row per theme and sentiment from here on.
    same_sentiment = Window.partitionBy("sentiment")
    keyword_lists = F.array(*[F.array(*[F.lit(w) for w in t.keywords]) for t in themes])
    counted = F.filter(
        F.transform(
            F.element_at(keyword_lists, F.col("theme_no") + 1),
            lambda word, i: F.struct(
                (-F.element_at(F.array(*[F.col(w) for w in counters]), i + 1)).alias("minus_n"), word.alias("word")
            ),
        ),
        lambda x: x["minus_n"] < 0,
    )
    order = Window.partitionBy("sentiment").orderBy(F.desc("review_count"), "theme_no")
    return (
        per_theme.withColumn(
            "selected", F.max(F.when(F.col("theme_no") < 0, F.col("review_count"))).over(same_sentiment)
        )
        .filter("theme_no >= 0")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.lit(True) if limit is None else F.col("rank") <= limit)
        .select(
            "sentiment",
            "rank",
            _theme_value(themes, lambda t: t.name).alias("theme"),
            "review_count",
            percent(F.col("review_count"), F.col("selected")).alias("share_pct"),
            ratio_rounded(F.col("score"), F.col("review_count"), 2).alias("avg_score"),
            F.slice(F.transform(F.array_sort(counted), lambda x: x["word"]), 1, top).alias("top_keywords"),
            "top_categories",
            _theme_value(themes, lambda t: t.hint).alias("action_hint"),
        )
    )


def primary_theme_per_category(rows: DataFrame, themes: Sequence[Theme] = THEMES_PT) -> DataFrame:
    """Most mentioned theme of the low reviews of each category."""
    hits = _theme_hits(rows, themes).filter((F.col("sentiment") == "negative") & (F.col("theme_no") >= 0))
    order = Window.partitionBy("category").orderBy(F.desc("n"), "theme_no")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .filter("rank = 1")
        .select("category", _theme_value(themes, lambda t: t.name).alias("primary_reason"))
    )


def primary_negative_theme(
    c: Commerce, themes: Sequence[Theme] = THEMES_PT, min_reviews: int = 10, n: int = 10
) -> DataFrame:
    """Categories with most low reviews and what those complain about."""
    worst = negative_categories(c, c.text_reviews, min_reviews, n)
    reasons = primary_theme_per_category(review_rows(c), themes)
    return (
        worst.join(reasons, worst["category"].eqNullSafe(reasons["category"]), "left")
        .select(
            worst["category"], "avg_score", "negative_reviews",
            F.coalesce("primary_reason", F.lit(NO_THEME)).alias("primary_reason"),
        )
    )


def score_distribution(rows: DataFrame) -> DataFrame:
    """Reviews per star from 5 to 1, stars nobody gave included."""
    score = F.col("review_score")
    counts = rows.agg(
        *[F.coalesce(F.sum(F.when(score == s, F.col("weight"))), F.lit(0)).alias(str(s)) for s in (5, 4, 3, 2, 1)]
    )
    return counts.unpivot([], ["5", "4", "3", "2", "1"], "score", "reviews").select(
        F.col("score").cast("int").alias("score"), "reviews"
    )


def _summary(rows: DataFrame) -> DataFrame:
    score, weight = F.col("review_score"), F.col("weight")
    return rows.agg(
        F.sum(weight).alias("total"),
        F.sum(score.cast("long") * weight).alias("score"),
        F.sum(F.when(score.isNotNull(), weight)).alias("scored"),
        F.coalesce(F.sum(F.when(score >= 4, weight)), F.lit(0)).alias("positive"),
        F.coalesce(F.sum(F.when(score <= 2, weight)), F.lit(0)).alias("negative"),
    )


def review_summary(rows: DataFrame) -> DataFrame:
    return _summary(rows).select(
        F.col("total").alias("total_reviews"),
        ratio_rounded(F.col("score"), F.col("scored"), 2).alias("avg_score"),
        percent(F.col("positive"), F.col("total")).alias("positive_pct"),
        percent(F.col("negative"), F.col("total")).alias("negative_pct"),
    )


def category_sentiment(rows: DataFrame, min_reviews: int = 5) -> DataFrame:
    """Mean score of each category; 0 when none of its reviews has a score."""
    score, weight = F.col("review_score"), F.col("weight")
    return (
        by_category(rows.select("review_score", "categories"))
        .groupBy("category")
        .agg(
            F.sum(score.cast("long") * weight).alias("score"),
            F.sum(F.when(score.isNotNull(), weight)).alias("scored"),
            F.sum(weight).alias("review_count"),
        )
        .filter(F.col("review_count") >= min_reviews)
        .select(
            "category",
            F.coalesce(ratio_rounded(F.col("score"), F.col("scored"), 2), F.lit(0.0)).alias("avg_score"),
            "review_count",
        )
        .orderBy("avg_score", "category")
    )


def worst_sentiment_categories(rows: DataFrame, below: float = 3.5, n: int = 10) -> DataFrame:
    return (
        category_sentiment(rows)
        .filter(F.col("avg_score") < below)
        .orderBy("avg_score", "category")
        .limit(n)
    )


def decision_signals(rows: DataFrame, themes: Sequence[Theme] = THEMES_PT, n: int = 3) -> DataFrame:
    """The leading negative themes as sentences."""
    return (
        review_themes(rows, themes)
        .filter((F.col("sentiment") == "negative") & (F.col("rank") <= n))
        .select(
            "rank",
            F.format_string(
                "%s: %d negative mentions; action: %s", "theme", "review_count", "action_hint"
            ).alias("signal"),
        )
    )


def sentiment_summary(
    rows: DataFrame, themes: Sequence[Theme] = THEMES_PT, stop_words: Sequence[str] = STOP_WORDS_PT
) -> DataFrame:
    """One row: a sentence on scores and keywords and one on the main negative theme."""
    keywords = (
        ranked_words(review_keywords(rows, stop_words, 5))
        .filter("sentiment = 'negative'")
        .select(F.array_join("words", ", "))
        .scalar()
    )
    main_theme = (
        review_themes(rows, themes)
        .filter("sentiment = 'negative' and rank = 1")
        .select(
            F.concat(
                F.lit("Main negative theme: "), "theme", F.lit(" ("), F.col("review_count").cast("string"),
                F.lit(" matched negative reviews, "), fixed_text(F.col("share_pct"), 1),
                F.lit("% of negative text sample)."),
            )
        )
        .scalar()
    )
    share = lambda part: F.round(
        ratio(F.col(part) * 100, F.col("total")).cast("decimal(38,10)"), 0
    ).cast("long").cast("string")
    scores = F.concat(
        F.lit("Average review score: "), fixed_text(ratio(F.col("score"), F.col("scored")), 1), F.lit("/5. "),
        share("positive"), F.lit("% positive (4-5★), "), share("negative"),
        F.lit("% negative (1-2★). Top negative keywords: "), F.coalesce(keywords, F.lit("")), F.lit("."),
    )
    theme = F.coalesce(main_theme, F.lit(NO_THEME_SUMMARY))
    return _summary(rows).select(
        F.concat_ws(" ", scores, theme).alias("sentiment_summary"), theme.alias("topic_modeling_summary")
    )


def review_sample(
    rows: DataFrame, per_stratum: int = 5, width: int = 80, at_most: int = 12, at_least: int = 5, plain: int = 15
) -> DataFrame:
    """A few negative and positive reviews with shortened text, for reading: a row for each item.

    The first `per_stratum` reviews (by id) of each sentiment; when both together
    are fewer than `at_least`, the first `plain` reviews of any score instead.
    At most `at_most` rows, negative ones first.
    """
    kind = F.coalesce(sentiment(F.col("review_score")), F.lit("other"))
    # Shortened before ranking, so no full text is sorted or moved.
    excerpt = F.substring(F.coalesce("review_comment_message", F.lit("")), 1, width).alias("excerpt")
    keys = by_category(rows.select("review_id", "review_score", kind.alias("kind"), excerpt, "weight", "categories"))
    # An item beyond the `plain` first of its review cannot be among the rows shown.
    copies = F.sequence(F.lit(1), F.least("weight", F.lit(plain).cast("long")).cast("int"))
    keys = keys.select("*", F.explode(copies).alias("copy"))
    in_kind = Window.partitionBy("kind").orderBy("review_id", F.asc_nulls_last("category"))
    ranked = keys.withColumn("pos", F.row_number().over(in_kind)).filter(F.col("pos") <= plain)
    # At most `plain` rows of each of three kinds remain.
    few = Window.partitionBy(F.lit(0))
    strata = (F.col("kind") != "other") & (F.col("pos") <= per_stratum)
    chosen = ranked.withColumn("strata_rows", F.count_if(strata).over(few))
    by_kind = F.col("strata_rows") >= at_least
    order = Window.partitionBy(F.lit(0)).orderBy(
        F.when(by_kind, F.col("kind")), F.col("review_id"), F.asc_nulls_last("category")
    )
    return (
        chosen.filter(~by_kind | strata)
        .withColumn("line", F.row_number().over(order))
        .filter(F.col("line") <= at_most)
        .select("line", "review_score", "category", "excerpt")
    )
