"""The pipeline on a small corpus, and its registration."""

import brute
import numpy as np
import pytest
from llm_cases import CLASHES
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tallyport.llm import queries, simhash

RNG = np.random.default_rng(2)
WORDS = [f"wort{i}" for i in range(400)]


def text_of(n):
    return " ".join(RNG.choice(WORDS, n))


@pytest.fixture(scope="module")
def corpus(spark, make_docs, tmp_path_factory):
    """Clean documents, junk, near copies, repeated passages of lines, benchmark leaks, nulls and empty texts."""
    root = str(tmp_path_factory.mktemp("corpus"))
    clean = [(i, "\n".join(text_of(25) for _ in range(6)), f"src{i % 4}") for i in range(60)]
    junk = [(100 + i, "BUY!! " * 80, "src0") for i in range(20)]
    near = [(200 + i, clean[0][1] + f" end{i}", "src1") for i in range(3)]
    passage = "\n".join(text_of(20) for _ in range(4))
    shared = [(300 + i, text_of(60) + "\n" + passage + "\n" + text_of(60), "src2") for i in range(3)]
    item = text_of(30)
    leaks = [(400 + i, text_of(80) + " " + item + " " + text_of(80), "src3") for i in range(2)]
    odd = [(500, None, None), (501, "", "src0"), (None, text_of(90), None)]
    rows = clean + junk + near + shared + leaks + odd
    make_docs(rows).write.parquet(f"{root}/documents.parquet")
    marks = [(i, 1, 0) for i, *_ in clean] + [(i, 0, 0) for i, *_ in junk]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, rows, passage


def test_each_stage_does_its_work(spark, corpus):
    root, rows, passage = corpus
    docs, at = spark.read.parquet(f"{root}/documents.parquet"), {}
    columns = docs.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {(r.doc_id, r.text) for r in docs.collect()} if n < 4 else set()
        docs = stage(spark, docs, root)
        assert n == 4 or docs.columns == columns
        at[name] = docs.collect()
        if n in (0, 2, 3):
            assert {(r.doc_id, r.text) for r in at[name]} <= before
    ids = {n: {r.doc_id for r in kept} for n, kept in at.items()}
    assert set(range(60)) <= ids["quality_classifier"] and not ids["quality_classifier"] & set(range(100, 120))
    lined = {r.doc_id: r for r in at["line_dedup"]}
    assert [passage in lined[i].text for i in (300, 301, 302)] == [True, False, False]
    # brute's windows, on what the first stage kept
    want = brute.line_dedup([(r.doc_id, r.text) for r in at["quality_classifier"]])
    assert {i: r.text or "" for i, r in lined.items()} == {i: k for i, (_, _, k) in want.items()}
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in lined.values())
    prints = {i: brute.simhash(r.text) for i, r in lined.items()}
    root_of = brute.groups(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for i in sorted(prints, key=brute.order):
        first.setdefault(root_of[prints[i]], i)
    assert ids["simhash_near_dedup"] == set(first.values())
    assert ids["benchmark_decontamination"] == ids["simhash_near_dedup"] - {400, 401}
    sizes, taken = {}, {}
    for r in at["benchmark_decontamination"]:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    for r in at["mix_sources"]:
        taken[r.source] = taken.get(r.source, 0) + r.mix_words
    for s, t in brute.targets(sizes).items():
        assert abs(taken.get(s, 0) - t) <= 0.5 + 1e-6


def test_near_dedup_stage_broadcasts_no_variants(spark, corpus, monkeypatch):
    """64 rows of each fingerprint, which Spark sizes as one: none of them may go through the driver."""
    plans, plain = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda links, stage: (
        plans.append(links._jdf.queryExecution().executedPlan().toString()), plain(links, stage))[1])
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, corpus[0]).collect()
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "BroadcastExchange" not in plans[0]


def test_run_gives_the_last_stage(spark, corpus):
    out = corpus_pipeline.run(spark, corpus[0])
    again = corpus_pipeline.run(spark, corpus[0])
    assert {"mix_shard", "mix_order", "doc_id", "text"} <= set(out.columns)
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))


def test_stages_on_an_empty_table_and_more_columns(spark, corpus, make_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, make_docs([]), corpus[0]).collect() == [], name
        docs = make_docs([(1, text_of(40)), (1, text_of(40)), (None, None)], **CLASHES)
        if name != "mix_sources":
            assert stage(spark, docs, corpus[0]).columns == docs.columns, name
        else:
            stage(spark, docs, corpus[0]).collect()


def test_registered():
    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names and len(queries.QUERIES) == 13
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.SQL) == {"op1_line_dedup", "op7_substring_dedup", "op8_decontaminate", "op10_mix_sources",
                                "op12_filter_audit"}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    import os

    from compare import check, duck

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test data here")
    assert check(spark, duck(sf), queries.QUERIES[name], queries.SQL[name], sf)[0] is None


def test_classifier_on_held_out_rows(spark):
    import os

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("no test data here")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = queries.QUERIES["op4_quality_classifier"](spark, sf).filter("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) > 0.97


def test_mean_scores_of_the_registered_language_model(spark):
    import os

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test data here")
    rows = queries.QUERIES["op3_lm_scores"](spark, sf).filter(F.col("n_tokens") > 0).collect()
    assert len(rows) >= 150 and all(r.log_prob < 0 for r in rows)
