"""Filter interaction audit against a plain Python count over all orders."""

import itertools
import re

import numpy as np

from llm_cases import CLASHES
from pyspark.sql import functions as F

from tallyport.llm import audit
from tallyport.llm.common import Stage

WORD = re.compile("[^\x20\x09-\x0d]+")

def brute(docs, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    bad = {d for d, _, t in labels if d is not None and t == 1}
    first = {}
    for d, t, _ in docs:
        t = t or ""
        if d is not None:
            first[t] = min(first.get(t, d), d)
    rows = []
    for d, t, src in docs:
        t = t or ""
        ws = WORD.findall(t)
        fails = {"A": len(ws) < 50, "B": 100 * len(set(ws)) < 65 * len(ws),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": d is not None and d > first[t]}
        rows.append((src or "", fails, d in good, d in bad))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shap = {x: 0 for x in "ABCDE"}
        per = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            for step in range(1, 6):
                x = order[step - 1]
                earlier = lambda f: any(f[y] for y in order[: step - 1])
                here = [r for r in mine if r[1][x] and not earlier(r[1])]
                per[(order, step)] = [
                    sum(not any(r[1][y] for y in order[:step]) for r in mine), len(here),
                    sum(r[1][x] and earlier(r[1]) for r in mine),
                    sum(r[1][x] and sum(r[1].values()) == 1 for r in mine),
                    sum(r[2] for r in here), sum(r[3] for r in here)]
                shap[x] += len(here)
        for (order, step), v in per.items():
            out[(part, order, step)] = tuple(v) + (shap[order[step - 1]],)
    return out

def run(spark, docs, labels):
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.audit(frame, lab, Stage(spark, "audit-test")).collect()
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in got}

LONG = " ".join(f"w{i}" for i in range(60))
DOCS = [
    (1, LONG, "a"), (2, LONG, "a"), (3, "short text", "a"), (4, "x " * 80, None), (5, LONG.upper(), "b"),
    (6, LONG + " #", "b"), (None, LONG, "b"), (7, None, "a"), (8, "", None), (8, "", None), (9, "w " * 30 + LONG, "a"),
    (10, "été " * 10 + LONG, "b"), (3, "short text", "a"), (11, " ".join(f"v{i}" for i in range(20_000)), "c"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 0, 1), (None, 1, 1), (6, 1, 0), (11, 1, 0)]

def test_against_brute_force(spark):
    got = run(spark, DOCS, LABELS)
    assert got == brute(DOCS, LABELS)
    # Every part has all 600 (order, step) rows.
    assert len(got) == 600 * len({(s or "") for _, _, s in DOCS})

def test_repeats_and_many_copies(spark):
    docs = [(i % 7, "same words here " * (i % 3), "s") for i in range(200)] + [(None, None, None)] * 3
    assert run(spark, docs, []) == brute(docs, [])

def test_empty_table(spark):
    assert run(spark, [], []) == {}

def test_clashing_columns_ignored(spark):
    frame = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    frame = frame.withColumns({c: F.lit(1) for c in list(CLASHES) + ["seq", "term", "term_id", "mask", "part", "digest", "copies"]})
    lab = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("good", F.lit(0))
    got = audit.audit(frame, lab, Stage(spark, "audit-test")).collect()
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                                                r.shapley) for r in got} == brute(DOCS, LABELS)

def test_colliding_hashes_take_second_ids(spark, monkeypatch):
    words = spark.createDataFrame([("w1",), ("w2",), ("x",)], "w string").select(F.xxhash64("w").alias("h")).collect()
    monkeypatch.setattr(audit, "collided", lambda docs: [r.h for r in words])
    assert run(spark, DOCS, LABELS) == brute(DOCS, LABELS)


def test_no_collisions_in_corpus(spark):
    frame = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    assert audit.collided(frame) == []


def test_csr_shard():
    lengths = np.array([3, 0, 4, 1])
    flat = np.array([5, 2, 5, 9, 9, 9, 1, 7])
    indptr, indices, data = audit.csr(lengths, flat)
    assert indptr.tolist() == [0, 2, 2, 4, 5]
    assert indices.tolist() == [2, 5, 1, 9, 7] and data.tolist() == [1, 2, 1, 3, 1]
