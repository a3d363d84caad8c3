"""Language identification: Viterbi against a plain one, cases, held-out accuracy."""

import random

import numpy as np
from llm_cases import CLASHES
from pyspark.sql import functions as F

from tallyport.llm import langid


def plain_viterbi(e, switch):
    n, k = e.shape
    v, back = e[0].copy(), []
    for t in range(1, n):
        prev = [max((v[j] - (0 if j == i else switch), -j) for j in range(k)) for i in range(k)]
        back.append([-p[1] for p in prev])
        v = np.array([p[0] for p in prev]) + e[t]
    path = [int(np.argmax(v))]
    for b in reversed(back):
        path.append(b[path[-1]])
    return path[::-1]


def test_lockstep_viterbi_equals_plain():
    rng = np.random.default_rng(3)
    scores = [rng.normal(size=(n, 3)) * 4 for n in [0, 1, 2, 7, 30, 31, 500, 3]]
    for got, e in zip(langid.viterbi(scores, 2.5), scores):
        if len(e):
            assert list(got) == plain_viterbi(e, 2.5)


def test_ties_prefer_staying():
    e = np.zeros((5, 2))
    assert list(langid.viterbi([e], 1.0)[0]) in ([0] * 5, [1] * 5)


RNG = random.Random(5)
EN = "the and of to in is that it for with as was on be at by this had not are".split()
FR = "le la les et des est une que pour dans qui sur pas plus par avec son être été".split()
RU = "и в не на что он как это по но из у за от то все она так его".split()


def text(words, n):
    return " ".join(RNG.choice(words) for _ in range(n))


def rows():
    out = []
    for i in range(300):
        lang, words = [("en", EN), ("fr", FR), ("ru", RU)][i % 3]
        out.append((i, text(words, RNG.randint(5, 60)), lang))
    out += [(1000, None, "en"), (1001, "1234 5678 !!!", "en"), (1002, "", None), (1003, text(EN, 30_000), "en"),
            (1004, text(FR, 40) + " " + text(EN, 3) + " " + text(FR, 40), "fr"), (None, text(RU, 20), "ru"),
            (1005, text(FR, 30), None), (1005, text(FR, 30), None)]
    return out


def test_predictions_and_cases(spark):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").withColumns({c: F.lit(1) for c in CLASHES})
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs), carry=["doc_id", "k1"]).collect()}
    assert got[1000].lang_pred == "und" and got[1000].score == 0.0
    assert got[1001].lang_pred == "und" and got[1002].lang_pred == "und"
    assert got[1003].lang_pred == "en"
    assert got[1004].lang_pred == "fr" and 0.5 < got[1004].score <= 1.0
    assert got[None].lang_pred == "ru"
    right = [got[i].lang_pred == lang for i, _, lang in data[:300]]
    assert sum(right) >= 295
    assert all(0.0 <= r.score <= 1.0 for r in got.values())


def test_no_training_rows(spark):
    docs = spark.createDataFrame([(2, "hello there", None)], "doc_id long, text string, lang string")
    got = langid.predict(docs, langid.fit(docs), carry=["doc_id"]).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_held_out_rule(spark):
    import zlib
    ids = spark.range(200).select(F.col("id").alias("doc_id"))
    got = {r.doc_id: r.h for r in ids.select("doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}


def test_script_narrows_candidates():
    fitted = {"langs": ["en", "ru"], "totals": {"en": (10, 3), "ru": (10, 3)},
              "grams": [("en", "a", 5), ("en", "b", 5), ("ru", "и", 5), ("ru", "в", 5)]}
    model = langid.Model(fitted)
    e = model.emissions(["ab", "ив"])
    assert np.isinf(e[0, 1]) and np.isfinite(e[0, 0]) and np.isinf(e[1, 0]) and np.isfinite(e[1, 1])
