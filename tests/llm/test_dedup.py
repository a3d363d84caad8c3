"""Line, SimHash and substring dedup against plain Python, and their defined cases."""

import random

import brute
import pytest
from llm_cases import CLASHES
from pyspark.sql import functions as F

from tallyport.llm import linededup, shingles, simhash, substring
from tallyport.llm.common import Stage
from tallyport.llm.components import components

RNG = random.Random(5)
WORDS = [f"w{i}" for i in range(60)]


def words(n):
    return [RNG.choice(WORDS) for _ in range(n)]


def corpus():
    """Copies, shared passages, periodic texts, short and empty ones, odd white space."""
    passage, other = words(45), words(27)
    texts = [" ".join(words(RNG.randint(0, 90))) for _ in range(25)]
    texts += [" ".join(words(8) + passage + words(8)) for _ in range(6)]
    texts += [" ".join(words(3) + other) + "\n" + " ".join(passage[:21]) for _ in range(3)]
    texts += [" ".join(words(4) + passage[:30] + words(2) + passage[10:40] + words(1)) for _ in range(3)]
    texts += ["asga " * 70, "a b " * 35, "asga " * 20, "asga " * 19, texts[0], texts[0], texts[30]]
    texts += ["", " \n\t ", None, "one", "Été 中文 x y", " ".join(words(20_000)), "x  y\x0bz\x0c" * 20, "X  Y\x0bz\x0c" * 20]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def rows():
    return corpus()


def lined(rows):
    return [(i, t if t is None else t.replace(" w1", "\nw1").replace(" w2", "\n")) for i, t in rows] + [
        (900, "a\nb\nc"), (901, "x\na\nb\nc\ny"), (902, "a\nb"), (903, "\n\n\n\n"), (904, "\n\n\n"), (905, "a\nb\nc\na\nb\nc"), (906, "b\nc\r\nd")]


def test_line_dedup(rows, make_docs):
    given = lined(rows)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept or "") for r in
           linededup.judged(make_docs(given)).select("doc.doc_id", "n_lines", "n_removed", "kept").collect()}
    assert got == brute.line_dedup(given)


def test_line_dedup_keeps_all_columns(make_docs):
    docs = make_docs([(1, "a\nb\nc"), (2, "a\nb\nc\nd"), (None, None)], **CLASHES)
    out = {r.doc_id: r for r in linededup.dedup_lines(docs).collect()}
    assert linededup.dedup_lines(docs).columns == docs.columns
    assert (out[1].text, out[2].text, out[2].n_chars, out[2].k1, out[None].text) == ("a\nb\nc", "d", 1, 1, None)


def test_line_dedup_same_id_twice(make_docs):
    out = linededup.dedup_lines(make_docs([(1, "a\nb\nc"), (1, "a\nb\nc"), (1, "z\na\nb\nc"), (2, "a\nb\nc")])).collect()
    kept = sorted((r.doc_id, r.text) for r in out)
    assert [k for k in kept if k[0] == 2] == [(2, "")] and len(out) == 4
    assert sum("a\nb\nc" in t for _, t in kept) in (1, 2)  # the two equal rows together, or the other text of the id


def test_substring_dedup(rows, make_docs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.judged(make_docs(rows)).select(
        "doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept")).collect()}
    assert got == brute.substring_dedup(rows)


def test_substring_dedup_small_vocabulary(make_docs):
    """Many windows share an anchor but differ, so the second search has work."""
    base = [RNG.choice("ab") for _ in range(400)]
    given = [(i, " ".join(base[RNG.randint(0, 300):][: RNG.randint(15, 90)] + [RNG.choice("abc") for _ in range(12)])) for i in range(60)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.judged(make_docs(given)).select(
        "doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept")).collect()}
    assert got == brute.substring_dedup(given)


def test_substring_dedup_keeps_all_columns(make_docs):
    text = " ".join(map(str, range(30)))
    docs = make_docs([(None, text), (3, "x " + text), (2, text), (2, text)], **CLASHES)
    out = substring.dedup_substrings(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id, r.text, r.anchor) for r in out.collect()) == [
        (False, 2, text, 1), (False, 2, text, 1), (False, 3, "x", 1), (True, None, "", 1)]


@pytest.mark.parametrize("width", [1, 2, 3, 6, 11, 16])
def test_window_minima(width):
    import numpy as np

    values = np.random.default_rng(1).integers(0, 50, 40).astype(np.uint64)
    assert shingles.window_minima(values, width).tolist() == [min(values[i : i + width]) for i in range(40 - width + 1)]


def near_rows(rows):
    """Near copies too: a long text with a word or two changed."""
    base = words(400)
    more = []
    for i in range(12):
        own = list(base)
        own[RNG.randrange(400)] = f"z{i}"
        more.append((500 + i, " ".join(own)))
    return rows + more + [(None, " ".join(base)), (None, "only this")]


def test_simhash(rows, make_docs):
    given = near_rows(rows)
    got = simhash.judged(make_docs(given)).collect()
    prints = {simhash_of for simhash_of in (brute.simhash(t) for _, t in given)}
    root = brute.groups(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for i, t in given:
        r = root[brute.simhash(t)]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = sorted(((i, brute.simhash(t), least[root[brute.simhash(t)]]) for i, t in given), key=str)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == want
    assert len(set(root.values())) < len(prints)  # there are links


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_near_links_are_all_and_once(spark, distance):
    prints = {0, 1, 3, 7, 15, 2**63, 2**63 + 1, 2**32, 2**32 + 3, 2**31, 2**64 - 1}
    for _ in range(40):
        x = RNG.getrandbits(64)
        prints |= {x} | {x ^ sum(1 << b for b in RNG.sample(range(64), k)) for k in (1, 2, 3, 3, 4)}
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    got = [tuple(r) for r in simhash.near_links(spark.createDataFrame(signed, "fp long"), distance).collect()]
    values = sorted(s for s, in signed)
    want = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) % 2**64).bit_count() <= distance]
    assert sorted(got) == sorted(want)


def test_variants_are_not_broadcast(spark, tmp_path):
    """Fingerprints whose file is below the broadcast threshold make 64 times as many rows, which must not reach the driver."""
    spark.range(2000).select(F.xxhash64("id").alias("fp")).write.parquet(f"{tmp_path}/classes")
    links = simhash.near_links(spark.read.parquet(f"{tmp_path}/classes"))
    links.collect()
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40, 75)] + [(0, i) for i in range(100, 130)] + [(7, 5), (5, 7), (9, 5)]
    nodes = {n for p in pairs for n in p}
    near = {frozenset(p) for p in pairs}
    got = components(spark.createDataFrame(pairs, "a long, b long"), Stage(spark, "test")).collect()
    assert {r.node: r.root for r in got} == brute.groups(sorted(nodes), lambda a, b: frozenset((a, b)) in near)
    assert components(spark.createDataFrame([], "a long, b long"), Stage(spark, "test")).collect() == []


def test_one_of_each_group_stays(make_docs):
    text = " ".join(map(str, range(100)))
    docs = make_docs([(4, text), (2, text), (3, "other words here"), (None, text), (None, None), (9, "")], **CLASHES)
    out = simhash.drop_near_copies(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == [(2, text), (3, "other words here"), (9, "")]


@pytest.mark.parametrize("run", [linededup.dedup_lines, simhash.drop_near_copies, substring.dedup_substrings])
def test_empty_table(run, make_docs):
    out = run(make_docs([]))
    assert out.collect() == [] and out.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_copies_without_an_id_are_removed(make_docs):
    text = " ".join(map(str, range(30)))
    docs = make_docs([(None, text), (None, text), (None, text), (None, "short one"), (None, "short one"), (None, None)], **CLASHES)
    kept = lambda out: sorted(r.text or "" for r in out.collect())
    assert kept(substring.dedup_substrings(docs)) == ["", "", "", text, "short one", "short one"]
    lined_text = "a\nb\nc\nd"
    lines = make_docs([(None, lined_text), (None, lined_text), (7, "x\ny\nz"), (7, "x\ny\nz"), (None, "q"), (None, "q")], **CLASHES)
    assert kept(linededup.dedup_lines(lines)) == ["", "", lined_text, "q", "q", "x\ny\nz"]
    assert kept(simhash.drop_near_copies(docs)) == ["", text, "short one"]
    twice = simhash.drop_near_copies(make_docs([(1, text), (1, text), (2, text)])).collect()
    assert [(r.doc_id, r.text) for r in twice] == [(1, text)]
