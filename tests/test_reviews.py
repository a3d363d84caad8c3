import re
import unicodedata
from collections import Counter

from conftest import rows_of
from pyspark.sql import functions as F

from tallyport.functions.text import normalise, tokens
from tallyport.operators import reviews

ROWS = "review_id string, review_score int, review_comment_title string, review_comment_message string, category string"


def test_theme_extraction_finds_delivery_delay(spark):
    frame = spark.createDataFrame(
        [("a", 1, "", "entrega com atraso e muita demora", "health_beauty"),
         ("b", 2, "", "prazo ruim, transportadora atrasou", "health_beauty")], ROWS,
    )
    themes = reviews.review_themes(reviews.single_category_rows(frame)).filter("sentiment = 'negative'")
    top = themes.orderBy("rank").first()
    assert top.theme == "Delivery delay / logistics reliability"
    assert top.review_count == 2 and top.share_pct == 100.0 and top.avg_score == 1.5
    assert top.top_categories == ["health_beauty"]
    assert top.top_keywords == ["atraso", "demora", "entrega", "prazo", "transportadora"]


def test_review_rows_weigh_items_by_category(shop):
    got = {r.review_id: r for r in reviews.review_rows(shop).collect()}
    assert got["r1"].weight == 2
    assert sorted((c.category, c.weight) for c in got["r1"].categories) == [("beauty_health", 1), ("coisas_raras", 1)]
    assert got["r5"].review_comment_message == ""


def test_summary_counts_reviews_without_score_in_the_total(shop):
    row = reviews.review_summary(reviews.review_rows(shop)).first()
    # r1 and r2 twice (two items), r3, r4 (no score), r5.
    assert (row.total_reviews, row.avg_score, row.positive_pct, row.negative_pct) == (7, 3.0, 42.9, 42.9)


def test_score_distribution_lists_every_star(shop):
    got = rows_of(reviews.score_distribution(reviews.review_rows(shop)))
    assert got == [(1, 2), (2, 1), (3, 0), (4, 1), (5, 2)]


def test_empty_text_counts_in_totals_but_not_in_theme_share(spark):
    frame = spark.createDataFrame(
        [("a", 5, "", "otimo", "x"), ("b", 5, "", "", "x"), ("c", 5, "", "nada", None)], ROWS
    )
    rows = reviews.single_category_rows(frame)
    assert reviews.review_summary(rows).first().total_reviews == 3
    theme = reviews.review_themes(rows).first()
    assert (theme.theme, theme.share_pct) == ("Positive product satisfaction", 50.0)


def test_tokens_match_a_plain_python_tokeniser(spark):
    texts = ["Não chegou, ABC1 çabc é ótimo!", "a_bc def ghi-jkl", "ÀÉÎ õpa ñam 123 über", "", "x\ny  éclair éclair"]

    def brute(text):
        text = "".join(ch for ch in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(ch))
        return re.findall(r"\b[a-z]{3,}\b", text)

    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(tokens("t")).collect()] == [brute(t) for t in texts]


def test_decomposed_accents_are_stripped(spark):
    frame = spark.createDataFrame([(unicodedata.normalize("NFD", "Péssimo"),)], "t string")
    assert frame.select(normalise("t")).first()[0] == "pessimo"


def test_keywords_count_tokens_and_honour_stop_words(shop, spark):
    frame = spark.createDataFrame(
        [("a", 1, "", "caro caro caro muito", "x"), ("b", 2, "", "caro lento", "x"), ("c", 3, "", "caro", "x")], ROWS
    )
    got = rows_of(reviews.review_keywords(reviews.single_category_rows(frame)), "sentiment", "word", "n", "rank")
    assert got == [("negative", "caro", 4, 1), ("negative", "lento", 1, 2)]


def test_merge_keeps_first_occurrence_and_caps(spark):
    frame = spark.createDataFrame([(["a", "b"], ["b", "c", "d"])], "x array<string>, y array<string>")
    assert frame.select(reviews.merge_keyword_lists(F.col("x"), F.col("y"), 3)).first()[0] == ["a", "b", "c"]
    assert frame.select(reviews.merge_keyword_lists(F.lit(None).cast("array<string>"), F.col("y"))).first()[0] == ["b", "c", "d"]


def test_themes_against_brute_force_with_a_hot_order(spark, tables):
    """One order holds a third of all items and reviews; pairs are never built."""
    from tallyport.roles import from_frames
    from tallyport.schemas import BASE_TABLES

    hot = 300
    none = (None,) * 5
    orders = spark.createDataFrame([(f"x{i}", "c1", "delivered", *none) for i in range(600)], BASE_TABLES["orders"])
    items = [(f"x{i if i > hot else 0}", i, f"p{i % 3 + 1}", "s1", None, 1.5, 1.0) for i in range(900)]
    texts = ["atraso na entrega", "peca com defeito", "otimo", "nada", "pedido errado e atraso"]
    revs = [(f"r{i}", f"x{i if i > hot else 0}", i % 5 + 1, "", texts[i % 5 if i % 2 else i % 3], None, None) for i in range(900)]
    frames = dict(tables)
    frames["orders"] = orders
    frames["order_items"] = spark.createDataFrame(items, BASE_TABLES["order_items"])
    frames["order_reviews"] = spark.createDataFrame(revs, BASE_TABLES["order_reviews"])
    shop = from_frames(frames)
    got = {
        (r.sentiment, r.theme): (r.review_count, r.top_categories)
        for r in reviews.review_themes(reviews.review_rows(shop)).collect()
    }
    names = {"p1": "beauty_health", "p2": "coisas_raras", "p3": None}
    known = {f"x{i}" for i in range(600)}
    want, cats = Counter(), {}
    by_order = {}
    for o, _, p, *_ in items:
        by_order.setdefault(o, []).append(names[p])
    for _, o, score, _, text, *_ in revs:
        kind = "positive" if score >= 4 else "negative" if score <= 2 else None
        if kind is None or o not in known:
            continue
        for theme in reviews.THEMES_PT:
            if any(k in text for k in theme.keywords):
                for cat in by_order.get(o, []):
                    want[kind, theme.name] += 1
                    if cat:
                        cats.setdefault((kind, theme.name), Counter())[cat] += 1
    assert {k: v[0] for k, v in got.items()} == dict(want)
    for key, counter in cats.items():
        assert got[key][1] == [c for c, _ in sorted(counter.items(), key=lambda x: (-x[1], x[0]))][:5]


def test_review_sample_takes_all_scores_when_strata_are_thin(spark):
    frame = spark.createDataFrame([(f"r{i:02}", 3, "", "x" * 100, "c") for i in range(20)] + [("a", 1, "", "bad", "c")], ROWS)
    got = reviews.review_sample(reviews.single_category_rows(frame)).orderBy("line").collect()
    assert len(got) == 12 and got[0].excerpt == "bad" and len(got[1].excerpt) == 80


def test_normalise_equals_unicode_decomposition(spark):
    """Every accented Latin letter, composed and decomposed, as Python's own tables have it."""
    text = "Škoda şeker čekat não Ångström żółw Ćevapi Ǖber ệ ễ Œuvre ﬁn Straße ÑANDÚ"
    letters = [chr(c) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]]
    # Ligatures and letters with several base letters are not accents.
    bare = lambda x: [c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)]
    more = "".join(x for x in letters if len(bare(x.lower())) == 1)
    for given in (text, unicodedata.normalize("NFD", text), more):
        got = spark.createDataFrame([(given,)], "t string").select(normalise("t")).first()[0]
        want = "".join(c for c in unicodedata.normalize("NFKD", given.lower().replace("ﬁ", "")) if not unicodedata.combining(c))
        plain = lambda s: "".join(c for c in s if c in "abcdefghijklmnopqrstuvwxyz ")
        assert plain(got) == plain(want)
