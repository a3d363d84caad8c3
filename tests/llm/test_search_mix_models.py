"""Decontamination, mixing, search, classifier, language model, licence and secret scans."""

import random
import re

import brute
import numpy as np
import pytest
from llm_cases import CLASHES
from pyspark.sql import functions as F

from tallyport.llm import ann, decontaminate, licences, lmscore, mixing, quality, secrets

RNG = random.Random(11)
WORDS = [f"w{i}" for i in range(80)]


def text_of(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


# -- benchmark decontamination

def leaks():
    items = [(i, text_of(RNG.randint(12, 40))) for i in range(12)] + [(12, "Short, Item Here"), (13, "nine " * 9), (14, "one"), (15, None),
             (16, ""), (17, "rep " * 40), (None, "null id item"), (2, text_of(15)), (100, "été çà Ünïcode 中文")]
    docs = []
    for i in range(30):
        item = RNG.choice(items[:12])[1].split()
        cut = RNG.randint(0, 3)
        piece = item[cut : cut + RNG.choice([9, 10, 11, 40])]
        docs.append((i, " ".join(text_of(RNG.randint(0, 30)).split() + [w.upper() + "," for w in piece]) + " " + text_of(RNG.randint(0, 30))))
    docs += [(50, "a SHORT item, here b"), (51, "rep " * 25), (52, None), (53, ""), (54, "One"), (55, "nine-" * 9), (56, items[0][1]),
             (57, items[0][1]), (58, "null id item"), (59, "x été çà Ünïcode 中文 y"), (60, text_of(20_000) + " " + items[3][1])]
    return docs, items


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_decontamination(broadcast, make_docs, spark):
    docs, items = leaks()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.judged(
        make_docs(docs), bench, broadcast_fingerprints=broadcast).select("doc.doc_id", "n_words", "n_hit", "items").collect()}
    assert got == brute.decontaminate(docs, [i for i in items if i[0] is not None])


def test_decontamination_drops_only_hits(make_docs, spark):
    bench = spark.createDataFrame([(1, " ".join(map(str, range(20))))], "item_id long, text string").withColumn("k1", F.lit(1))
    docs = make_docs([(1, "x " + " ".join(map(str, range(5, 15)))), (2, " ".join(map(str, range(9)))), (None, None), (2, "again")], **CLASHES)
    out = decontaminate.drop_contaminated(docs, bench)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == [(2, "0 1 2 3 4 5 6 7 8"), (2, "again"), (None, None)]
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == 4
    assert decontaminate.drop_contaminated(make_docs([]), bench).collect() == []


# -- mixing

def sources():
    rows = [(i, text_of(RNG.randint(0, 60)), RNG.choice(["a", "b", "B", "é", "", None, "hot", "hot", "hot"])) for i in range(150)]
    return rows + [(200, None, "a"), (201, " \t", "b"), (None, text_of(40), "a"), (202, text_of(8_000), "tiny"), (203, "", "void"), (204, text_of(1), "z")]


def test_mixing_meets_targets(make_docs):
    rows = sources()
    size = lambda t: len(brute.SPACE_WORD.findall(t or ""))
    by_source = {}
    for _, t, s in rows:
        by_source[s] = by_source.get(s, 0) + size(t)
    want = brute.targets(by_source)
    got = mixing.lay_out(make_docs(rows), rows_per_bucket=7).select("doc.*", "size", "source_size", "target", "taken").collect()
    taken = {}
    for r in got:
        assert r["size"] == size(r.text) and r.source_size == by_source[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in want)
    again = mixing.lay_out(make_docs(rows)).select("doc.doc_id", "taken").collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in mixing.lay_out(make_docs(rows), rows_per_bucket=7).select("doc.doc_id", "taken").collect())


def test_the_mix_is_what_was_taken(make_docs):
    docs = make_docs(sources(), **CLASHES)
    rows = mixing.mix(docs, shards=4, blocks_per_shard=16).collect()
    words, of = {}, {r.doc_id: (r.text or "").split() for r in docs.collect()}
    for r in rows:
        piece = r.text.split()
        assert len(piece) == r.mix_words and r.n_chars == len(r.text) and " ".join(piece) in " ".join(of[r.doc_id])
        words[r.doc_id] = words.get(r.doc_id, 0) + r.mix_words
    want = {r.doc_id: r.taken for r in mixing.lay_out(docs).select("doc.doc_id", "taken").collect() if r.taken}
    assert words == want and {r.mix_shard for r in rows} <= set(range(4))
    by_shard = [sum(r.mix_words for r in rows if r.mix_shard == s) for s in range(4)]
    assert max(by_shard) < 1.3 * min(by_shard)


def test_blocks_are_dealt_exactly(spark):
    given = spark.createDataFrame([(1, 1000, 3000.0), (2, 1700, 3000.0), (3, 300, 3000.0), (4, 0, 3000.0)], "place int, quota long, total double")
    dealt = mixing.deal_blocks(given, shards=8, blocks_per_shard=8).collect()
    assert len({(r.place, r.block) for r in dealt}) == len(dealt) and {r.place for r in dealt} == {1, 2, 3}
    counts = [sum(r.shard == s for r in dealt) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    with pytest.raises(ValueError):
        mixing.deal_blocks(given, shards=6)


def test_op10_counts_the_written_mix(make_docs, monkeypatch):
    docs = make_docs([*sources(), (None, "a b c", "web"), (None, "a b c", "web"), (5, "", "web"), (6, None, None)])
    want = sorted(str(tuple(r)) for r in mixing.lay_out(docs).select("doc.doc_id", "size", "source_size", "target", "taken").collect())
    assert sorted(str(tuple(r)) for r in mixing.drawn(docs, shards=4).collect()) == want
    # An error of the tree shows: a quarter of the blocks is lost.
    whole = mixing.deal_blocks
    monkeypatch.setattr(mixing, "deal_blocks", lambda *a, **k: whole(*a, **k).filter("shard > 0"))
    assert sorted(str(tuple(r)) for r in mixing.drawn(docs, shards=4).collect()) != want


def test_op10_runs_the_mix(spark, make_docs, tmp_path, monkeypatch):
    make_docs(sources()).write.parquet(str(tmp_path / "documents.parquet"))
    calls, whole = [], mixing.deal_blocks
    monkeypatch.setattr(mixing, "deal_blocks", lambda *a, **k: calls.append(1) or whole(*a, **k))
    assert mixing.op10(spark, str(tmp_path)).count() == len(sources()) and calls


def test_buckets_behind_the_quota_are_not_laid_out(make_docs):
    docs = make_docs([(i, "w " * (1 + i % 5), "abc"[i % 3]) for i in range(300)])
    columns = ["doc.doc_id", "size", "start", "taken"]
    whole = mixing.lay_out(docs, rows_per_bucket=5).select(*columns).collect()
    got = mixing.lay_out(docs, rows_per_bucket=5, reached=True).select(*columns).collect()
    # c has a third of the words and an eighth of the mix.
    assert len(got) < 270 and set(got) <= set(whole)
    assert {r for r in got if r.taken} == {r for r in whole if r.taken}


def test_mixing_empty(make_docs):
    assert mixing.mix(make_docs([])).collect() == []
    assert [r.taken for r in mixing.lay_out(make_docs([(1, None), (2, "")])).select("taken").collect()] == [0, 0]


# -- nearest neighbours

def vectors(spark, x, ids=None):
    rows = [(int(i), None if v is None else [float(f) if f is not None else None for f in v]) for i, v in zip(ids or range(len(x)), x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def exact(x, ids, q, k):
    x = np.asarray(x, np.float32).astype(float)
    score = {i: float((x[j] * x[ids.index(q)]).sum()) for j, i in enumerate(ids) if i != q}
    return sorted(score.items(), key=lambda p: (-p[1], p[0]))[:k]


@pytest.mark.parametrize("block", [8_192, 100])
def test_nearest_recall(spark, block):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1_500, 32)) + 2 * rng.normal(size=(10, 32))[rng.integers(0, 10, 1_500)]
    x[700:1_000] = x[700]  # a fifth of all vectors are one
    ids = list(range(1_500))
    got = ann.search(vectors(spark, x), F.col("vec_id") % 50 == 0, least=64, block=block, query_block=16).collect()
    recall = []
    for q in range(0, 1_500, 50):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        want = exact(x, ids, q, 20)
        assert [r.rank for r in mine] == list(range(1, 21))
        assert [(r.vec_id, r.score) for r in mine] == sorted([(r.vec_id, r.score) for r in mine], key=lambda p: (-p[1], p[0]))
        recall.append(np.mean([any(r.vec_id == i and r.score == pytest.approx(s) for r in mine) for i, s in want]))
    assert np.mean(recall) >= 0.9


def test_nearest_work_grows_less_than_the_rows(monkeypatch):
    rng, reranked, scored = np.random.default_rng(4), [], ann.best_scored
    monkeypatch.setattr(ann, "best_scored", lambda kinds, *rest: reranked.append(len(kinds)) or scored(kinds, *rest))
    work = []
    for n in (4_000, 16_000):
        x = rng.normal(size=(n, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        pivots = round(ann.PIVOTS * n**0.5)
        files = ann.files_of(x, ann.spread_pivots(x[: 4 * pivots], pivots), ann.FILES)
        q = np.arange(0, n, n // 50)
        reranked.clear()
        got = ann.search_block(np.arange(n), x, files, q, x[q], files[q], pivots, 20, ann.RERANKED / n**0.5, 1, 20)
        want = x[q] @ x.T
        want[np.arange(len(q)), q] = -1
        least = dict(zip(q.tolist(), np.sort(want, axis=1)[:, -20]))
        assert np.mean([s >= least[i] - 1e-12 for i, s in zip(got.query_id, got.score)]) >= 0.9
        read = np.bincount(files.ravel(), minlength=pivots)[files[q]].sum(axis=1).mean()
        work.append((sum(reranked) / len(q), read))
    assert all(large < 2.8 * small for small, large in zip(*work)), work  # four times the rows


def test_pivots_are_not_crowded_by_near_copies():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 32))
    x[:300] = x[0] + 0.01 * rng.normal(size=(300, 32))
    chosen = ann.spread_pivots(x, 50)
    assert (chosen @ chosen[0] > 0.99).sum() == 1 and len(chosen) == 50


@pytest.mark.parametrize("scale", [1.0, 1e200, 1e-200])
def test_best_scored_is_the_full_sort(scale):
    rng = np.random.default_rng(6)
    x, q = rng.integers(-2, 3, (500, 8)) * scale, rng.integers(-2, 3, 8) * scale
    with np.errstate(all="ignore"):
        score = (x * q).sum(axis=1)
        at, got = ann.best_scored(x, q, 21, float(np.abs(x).max()))
    order = np.argsort(-score, kind="stable")[:21]
    assert at.tolist() == order.tolist() and np.array_equal(got, score[order], equal_nan=True)


def test_nearest_odd_vectors(spark):
    x = [[1, 0], [0.5, 0], [0.5, 0], [0, 0], None, [float("nan"), 1], [float("inf"), 0], [None, 1], [1, 2, 3], [-1, 0]]
    frame = vectors(spark, x).union(spark.createDataFrame([(0, [9.0, 0.0]), (None, [1.0, 1.0])], "vec_id long, embedding array<float>"))
    got = ann.search(frame.withColumn("rank", F.lit(1)), F.col("vec_id") % 5 == 0, nearest=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 9, -1.0)]
    assert ann.search(frame.limit(0), F.col("vec_id") % 5 == 0).collect() == []


# -- quality classifier

def graded(n=300):
    rows, marks = [], []
    for i in range(n):
        good = i % 4 != 0
        rows.append((i, text_of(RNG.randint(5, 120)).replace(" w1", ". W1") if good else RNG.choice(["BUY NOW!! " * 30, "%%% $$$ " * 40, "x " * 90])))
        if i % 3:
            marks.append((i, int(good), 0))
    return rows, marks


def test_quality(make_docs, spark):
    rows, marks = graded()
    extra = [(1_000, None), (1_001, ""), (None, "some plain words here"), (1_002, text_of(30_000))]
    labels = spark.createDataFrame(marks + [(None, 1, 0), (5, None, 0), (9_999, 0, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows + extra, **CLASHES)
    model = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.scored(docs, model).select("doc.doc_id", "score", "predicted", quality.held_out(F.col("doc.doc_id")).alias("out")).collect()}
    import zlib
    assert len(got) == len(rows) + len(extra)
    assert all(r.out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(got[i].predicted, q) for i, q, _ in marks if got[i].out]
    assert len(held) > 20 and np.mean([p == q for p, q in held]) > 0.95
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got.values())


def test_held_out_labels_teach_nothing(make_docs, spark):
    rows, marks = graded(120)
    docs = make_docs(rows)
    frame = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    turned = frame.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [[r.score for r in quality.scored(docs, quality.fit(docs, x)).select("score").collect()] for x in (frame, turned)]
    assert scores[0] == scores[1]


def test_quality_without_labels(make_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make_docs([(1, "a"), (2, None)])
    assert {r.score for r in quality.scored(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert quality.scored(make_docs([]), quality.fit(make_docs([]), none)).collect() == []


# -- language model

def test_language_model(make_docs):
    order = [f"t{i}" for i in range(30)]
    rows = [(i, " ".join(order[(s + j) % 30] for j in range(RNG.randint(3, 80)))) for i, s in enumerate(RNG.choices(range(30), k=80))]
    mixed = " ".join(RNG.sample(order * 2, 60))
    rows += [(501, None), (502, ""), (None, "T1 unseen"), (503, "t1 " * 20_000)]
    docs = make_docs(rows, **CLASHES)
    model = lmscore.train(docs)
    got = {r.doc_id: r for r in lmscore.scored(docs, model, carry=["doc_id"]).select("doc.doc_id", "n_tokens", "log_prob").collect()}
    assert [got[i].n_tokens for i in (501, 502, None)] == [0, 0, 2] and got[501].log_prob == 0
    # Plain sum of log p(class | sides) + log p(token | class), token by token.
    classes, count = lmscore.token_classes(), {}
    for _, t in rows:
        for token in lmscore.tokens(t, model.vocabulary).tolist():
            count[token] = count.get(token, 0) + 1
    table = model.log_triple.reshape(lmscore.SIDE, lmscore.SIDE, lmscore.CLASSES)
    assert np.allclose(np.exp(table).sum(-1), 1)
    tokens = lmscore.tokens(rows[0][1], model.vocabulary).tolist()
    sides = [lmscore.CLASSES, *classes[tokens].tolist(), lmscore.CLASSES]
    share = lambda t: count[t] / sum(n for u, n in count.items() if classes[u] == classes[t])
    want = sum(table[sides[i], sides[i + 2], sides[i + 1]] + np.log(share(t)) for i, t in enumerate(tokens))
    assert got[0].log_prob == pytest.approx(want)
    usual = np.mean([got[i].log_prob / got[i].n_tokens for i in range(80)])
    assert usual > model.score(mixed)[1] / 60 + 1  # word order matters
    assert lmscore.scored(make_docs([]), lmscore.train(make_docs([]))).collect() == []


@pytest.fixture(scope="module")
def pairs(make_docs):
    """Two common words, then a word that only its own other word follows; all 160 pairs are as frequent, so classes hold many."""
    rng = random.Random(4)
    head = [f"the{i}" for i in range(40)]
    rows = []
    for i in range(400):
        rows.append((i, " ".join(f"{rng.choice(head)} {rng.choice(head)} a{k:03} b{k:03}" for k in rng.choices(range(160), k=400))))
    docs = make_docs(rows)
    return docs, lmscore.train(docs)


def test_language_model_tells_words_of_a_class_apart(pairs):
    _, model = pairs
    words = {k: lmscore.tokens(f"a{k:03} b{k:03}", model.vocabulary).tolist() for k in range(160)}
    alike = {}
    for k, (a, b) in words.items():
        alike.setdefault((model.classes[a], model.classes[b]), []).append(k)
    turned = [(k, other) for ks in alike.values() if len(ks) > 1 for k, other in zip(ks, ks[1:] + ks[:1])]
    assert len(turned) > 100
    right = " ".join(f"the1 the2 a{k:03} b{k:03}" for k, _ in turned)
    wrong = " ".join(f"the1 the2 a{k:03} b{other:03}" for k, other in turned)
    n, s = model.score(right)
    assert n == 4 * len(turned) and s > model.score(wrong)[1] + len(turned)  # the same classes everywhere


def test_language_model_is_a_distribution_over_all_tokens(pairs):
    _, model = pairs
    edge, every = model.vocabulary.edge, np.arange(model.vocabulary.edge)
    for left, right in lmscore.tokens("a003 the1 b150 a007 unseen word", model.vocabulary).reshape(3, 2):
        flat = np.stack([np.full_like(every, edge), np.full_like(every, left), every, np.full_like(every, right)], 1).ravel()
        logs = model.log_probs(np.append(flat, edge)).reshape(-1)[2::4]
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_language_model_sums_every_token(pairs):
    """The sums behind the tokens' vectors against plain loops over the texts."""
    docs, model = pairs
    corpus = lmscore.tokenised(docs.filter("doc_id < 20"), model.vocabulary)
    got, products = model.output_sums(corpus)
    want, wanted = np.zeros_like(got), np.zeros_like(products)
    out, edge = model.class_layer[0].astype(float), model.vocabulary.edge
    sides = np.zeros((2 * edge, lmscore.HIDDEN))
    base = lmscore.Model(model.vocabulary, np.concatenate([model.triples.ravel(), model.by_token.astype(np.int64)]))
    p = np.exp(base.log_triple.reshape(lmscore.SIDE, lmscore.SIDE, lmscore.CLASSES).astype(float))
    for row in docs.filter("doc_id < 20").collect():
        token = [edge, *lmscore.tokens(row.text, model.vocabulary).tolist(), edge]
        for left, t, right in zip(token, token[1:], token[2:]):
            c, cl, cr = model.classes[t], *[lmscore.CLASSES if s == edge else model.classes[s] for s in (left, right)]
            hidden = np.tanh(base.left[left].astype(float) + base.right[right])
            gradient = (out[c] - p[cl, cr] @ out) * (1 - hidden * hidden)
            for s, first in ((left, 0), (right, edge)):
                if lmscore.OWN_CLASS <= s < edge:
                    sides[first + s] += gradient
            if t >= lmscore.OWN_CLASS:
                h = np.tanh(model.left[left].astype(float) + model.right[right])
                want[t] += h
                wanted[c] += np.outer(h, h)
    assert np.abs(got - want).max() < 0.01 and np.abs(products - wanted).max() < 0.05
    assert np.abs(model.side_sums(corpus) - sides).max() < 0.01 and np.abs(sides).max() > 1
    halves = [model.output_sums(lmscore.tokenised(docs.filter(f), model.vocabulary))[0] for f in ("doc_id < 10", "doc_id between 10 and 19")]
    assert np.abs(halves[0] + halves[1] - got).max() < 0.01


def test_vocabulary_grows_with_the_corpus(spark, make_docs, monkeypatch):
    assert lmscore.vocabulary_size(10**6) < lmscore.vocabulary_size(10**8) < lmscore.vocabulary_size(10**10)
    monkeypatch.setattr(lmscore, "VOCABULARY", 4)
    monkeypatch.setattr(lmscore, "LIKE_HEAPS", 1)
    stage = lmscore.Stage(spark, "test")
    few = make_docs(["d d d D a a b b c", None, "", "e"])
    assert lmscore.frequent_words(few, stage) == ["d", "a", "b", "c"]
    more = make_docs([" ".join(f"w{i}" for i in range(70)) + " w7"])
    assert lmscore.frequent_words(more, stage) == ["w7", *sorted(f"w{i}" for i in range(70) if i != 7)[:7]]
    assert lmscore.frequent_words(make_docs([]), stage) == []


# -- licences

def test_licences_read_each_text_once(spark, make_docs):
    read = spark.sparkContext.accumulator(0)
    docs = make_docs([(i, f"Copyright 2020 A. Author\nline {i}\nReleased under the MIT licence.\n\nline") for i in range(40)] + [(7, None)])
    texts = docs.withColumn("text", F.udf(lambda t: (read.add(1), t)[1])("text"))
    got = licences.scan(texts, licences.built_in(spark)).collect()
    assert read.value == 41
    assert sorted((r.doc_id, r.notices) for r in got) == sorted([(i, "MIT") for i in range(40)] + [(7, "")])


def test_licences_either_is_the_plain_choice():
    rng = random.Random(5)
    for _ in range(200):
        some = ["".join(rng.choice("ab ") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 8))]
        tree, plain = re.compile(rf"\b{licences.either(some)}\b"), re.compile(r"\b(" + "|".join(some) + r")\b")
        for _ in range(20):
            text = "".join(rng.choice("ab ") for _ in range(8))
            assert bool(tree.search(text)) == bool(plain.search(text)), (some, text)


def test_licences(make_docs):
    respelt = licences.MIT.replace("the", "THE").replace(", ", " ,  ").replace("sublicense", "sublicence")
    docs = make_docs([
        (1, licences.MIT), (2, "Copyright (c) 2020 A. Author\n\n" + respelt + "\n"), (3, licences.MIT + " and more"),
        (4, "Some text.\n  released UNDER the MIT Licence!\nLicensed under CC BY-NC 4.0."), (5, None), (6, ""), (7, "(C) 2020 me"),
        (8, licences.ISC.replace("\n", " ")), (8, "other"), (None, "Released under the MIT License."), (9, "word " * 30_000)], **CLASHES)
    got = sorted(((r.doc_id, r.licences, r.notices) for r in licences.scan(docs, licences.built_in(docs.sparkSession)).collect()), key=str)
    assert got == sorted([(1, "MIT", ""), (2, "MIT", ""), (3, "", ""), (4, "", "CC-BY-NC-4.0,MIT"), (5, "", ""), (6, "", ""), (7, "", ""),
                          (8, "ISC", "ISC"), (8, "", ""), (None, "MIT", "MIT"), (9, "", "")], key=str)
    assert licences.scan(make_docs([]), licences.built_in(docs.sparkSession)).collect() == []


def test_licence_sentences_are_no_copyright_lines(make_docs):
    one_line = " ".join(licences.MIT.split())
    usual = licences.MIT.replace("\nCOPYRIGHT HOLDERS BE", " COPYRIGHT HOLDERS BE").replace("DAMAGES OR", "DAMAGES\nOR")
    narrow = licences.MIT.replace("OR\nCOPYRIGHT HOLDERS BE", "OR\nCOPYRIGHT HOLDERS BE\n")
    notices = ["Copyright (c) 2020 A. Author", "Copyright 2019-2021, The Authors", "(c) 2020 me", "\u00a9 Example Ltd", "COPYRIGHT Jane Doe",
               "Copyright (C) <year> <name>", " * Copyright by Example Corp.", "All rights reserved."]
    texts = [one_line, usual, narrow, *[f"{n}\n\n{one_line}" for n in notices]]
    got = licences.scan(make_docs(texts), licences.built_in(make_docs([]).sparkSession)).collect()
    assert {r.doc_id: r.licences for r in got} == dict.fromkeys(range(len(texts)), "MIT")
    other = make_docs([one_line.replace("COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM", "PEOPLE BE LIABLE FOR ANY CLAIM")])
    assert licences.scan(other, licences.built_in(other.sparkSession)).first().licences == ""


# -- secrets

def findings():
    hexes = lambda n: "".join(RNG.choice("0123456789abcdef") for _ in range(n))
    rows = []
    for i in range(60):
        rows.append((i, f'{text_of(5)} token = "{hexes(40)}" {text_of(3)}'))
        rows.append((100 + i, f"{text_of(4)} {RNG.randrange(10**16, 10**17)} {text_of(4)} name.{i}@mail.example.com /usr/lib/x{i}/part.conf end"))
    return rows + [(300, f"password: '{hexes(32)}'"), (301, None), (302, ""), (303, "x1 " * 20_000), (None, f'api_key = "{hexes(40)}"')]


def test_secrets(make_docs):
    docs = make_docs(findings(), **CLASHES)
    got = secrets.scan(docs).collect()
    assert {r.doc_id for r in got if r.is_secret} == {*range(60), 300, None}
    assert {r.doc_id for r in got if not r.is_secret} == set(range(100, 160))
    assert all(0 <= r.score <= 1 for r in got)


def test_secrets_learn_from_given_labels(make_docs, spark):
    rows = findings()
    docs = make_docs(rows)
    known = secrets.scan(docs).filter("doc_id < 20 OR doc_id BETWEEN 100 AND 120").select("doc_id", "word_at", F.col("is_secret").cast("double").alias("is_secret"))
    rest = secrets.scan(docs, labelled=known).filter("doc_id >= 20").collect()
    assert np.mean([r.is_secret == (r.doc_id < 60 or r.doc_id == 300) for r in rest]) > 0.95
    assert secrets.scan(make_docs([])).collect() == []
    assert {r.is_secret for r in secrets.scan(make_docs(["see 12345678901234567890"])).collect()} == {False}


def test_all_secrets_of_a_word(make_docs):
    aws, spring, two = "wJalrXUtnFEMIK7MDENGbPxRfiCYzEXAMPLEKEY1", "Zx81kLm29QpR77vT", ["q8Zt" * 6, "m3Kd" * 7 + "=="]
    words = [f'aws_secret_access_key="{aws}"', f"spring.datasource.password={spring}", f'{{"api_key":"{two[0]}","token":"{two[1]}"}}',
             f"sha256:{two[0]}", "password=correcthorse", "see internationalization here", "12:34:56:78:9a:bc:de:f0"]
    rows = [(1_000 + i, w) for i, w in enumerate(words)]
    got = {}
    for r in secrets.scan(make_docs(findings() + rows)).filter("doc_id >= 1000").collect():
        got.setdefault(r.doc_id, []).append((r.candidate, r.is_secret))
        assert words[r.doc_id - 1_000][r["at"]:].startswith(r.candidate) or r.word_at
    assert {k: sorted(c for c, _ in v) for k, v in got.items()} == {
        1_000: [aws], 1_001: [spring], 1_002: sorted(two), 1_003: [two[0]], 1_004: ["correcthorse"], 1_006: ["12:34:56:78:9a:bc:de:f0"]}
    assert all(secret for k in (1_000, 1_002) for _, secret in got[k])
