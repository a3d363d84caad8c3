"""Periodic runs against a plain enumeration of all periods."""

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
from llm_cases import CLASHES
from pyspark.sql import functions as F

from tallyport.llm import runs


def smallest_period(s):
    return next(q for q in range(1, len(s) + 1) if all(s[i] == s[i + q] for i in range(len(s) - q)))


def brute(w):
    n, out = len(w), set()
    for q in range(1, n):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if smallest_period(w[i : i + length]) == q and length >= max(6, 4 * q):
                out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        n, k = rng.randint(0, 70), rng.randint(1, 3)
        w = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.3 and n > 4:
            a, p = rng.randrange(n), rng.randint(1, 6)
            w = w[:a] + [w[a + (i - a) % p] if a + (i - a) % p < n else 0 for i in range(a, n)]
        assert runs.find_runs(np.array(w, np.int64)) == brute(w)


def test_rare_words_are_gaps():
    rng = random.Random(2)
    for _ in range(1500):
        w = []
        for _ in range(rng.randint(0, 8)):
            some = [rng.randrange(rng.choice([2, 6, 60])) for _ in range(rng.randint(1, 4))]
            w += (some * rng.randint(1, 8))[: rng.randint(1, 30)] + [rng.randrange(60) for _ in range(rng.randint(0, 3))]
        ids = np.array(w, np.int64)
        assert runs.find_runs(ids) == runs.lyndon_runs(ids) == brute(w)
    short, place = runs.without_gaps(np.array([*range(100, 400), *[1, 2] * 4, 5, *[7] * 5, 6, *[1, 2] * 3, 8]))
    assert len(short) == 17 and place.tolist() == [0, *range(300, 309), *range(315, 322)]
    assert runs.find_runs(np.arange(10_000)) == []


def test_long_words_take_no_room_for_others():
    tracemalloc.start()
    got = runs.describe(None, "a b " * 1500 + "x" * 50_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got["start"], got["length"], got["period"]) == (0, 3000, 2)
    assert peak < 20_000_000


def test_words_that_end_in_a_zero_byte_are_words_of_their_own():
    assert runs.describe(None, "a a\0 a a\0 a a\0 a a\0")["period"] == 2


def plain(doc_id, text):
    words = text.split() if text else []
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            a, g = (h // 10) % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute(words)
    drop = set()
    for s, ln, p in found:
        drop.update(range(s + p, s + ln))
    best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else None
    return (len(found), *(best if best else (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{ln},{p}\n" for s, ln, p in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(words) if i not in drop).encode()).hexdigest())


def test_detect_against_plain(spark):
    rng = random.Random(4)
    planted_ids = [i for i in range(1000, 5000) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))) for i in range(30)]
    rows += [(i, " ".join(f"w{j}" for j in range(50))) for i in planted_ids]
    rows += [(100, None), (101, ""), (102, "x\ty\nx y x y x y"), (None, "a a a a a a a"), (103, "a " * 5000),
             (104, "é b é b é b é b"), (30, "a a a a a a"), (30, "a a a a a a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in CLASHES})
    got = {r.doc_id: tuple(r)[1:] for r in runs.detect(docs).collect()}
    assert len(runs.detect(docs).collect()) == len(rows)
    for doc_id, text in rows:
        assert got[doc_id] == plain(doc_id, text), (doc_id, got[doc_id], plain(doc_id, text))
    assert got[planted_ids[0]][0] >= 1


def test_empty_table(spark):
    assert runs.detect(spark.createDataFrame([], "doc_id long, text string")).collect() == []
