"""Periodic run detection over the words of each text, through Lyndon roots.

A run is a maximal stretch with smallest period q; by the runs theorem each run has,
under one of two letter orders (the order of words and its inverse), a Lyndon root
[i, i + q) that is the longest Lyndon word starting at i. So the runs of a text come
from its two Lyndon arrays: for every i and order, q = lambda[i], the stretch is extended
forward by LCE(i, i + q) and backward by the longest common extension to the left,
and kept where it spans at least 2q (the theorem's candidates), then deduplicated.

Per text, in numpy inside Spark tasks (no shuffle): words are numbered (a run has the
same place under any order of words). A run of at least 6 words and 4 periods holds each
of its words four times, so words that are rarer in a text, and stretches of less than
6 others, cannot lie in one: each such gap becomes one separator that occurs once, and
the Lyndon arrays are taken over what is left of the text. Suffix ranks come from prefix
doubling, whose levels also answer LCE queries by binary lifting; the Lyndon array is the distance to the next smaller suffix, found for all
positions at once by lifting over a sparse table of ranks. Memory per text grows as
n log n words.

This replaces phase one of a suffix sorter (the named method) by prefix doubling: the
Lyndon arrays are the same, computed from the inverse suffix array under both orders.

Defined cases: null text: no words, no runs. Texts shorter than 6 words have none. Ties
for the longest run: smallest start, then period. Repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyport.session import Tables

LEAST_LENGTH, LEAST_REPEATS = 6, 4


def doubling(ranks: np.ndarray) -> list[np.ndarray]:
    """Rank arrays of the prefixes of length 1, 2, 4, ... of every suffix, each padded with -1 at n."""
    n = len(ranks)
    rank = np.unique(ranks, return_inverse=True)[1].astype(np.int64)
    levels = [np.r_[rank, -1]]
    k = 1
    while n and rank.max() < n - 1 and k < n:
        second = np.full(n, -1, np.int64)
        second[: n - k] = rank[k:]
        both = rank * (n + 1) + second + 1
        order = np.argsort(both)
        there = both[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.r_[True, there[1:] != there[:-1]]) - 1
        rank, k = new, 2 * k
        levels.append(np.r_[rank, -1])
    return levels


def lce(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Longest common extension of the suffixes at x and y (x != y), all pairs at once."""
    n = len(levels[0]) - 1
    x, y, out = x.copy(), y.copy(), np.zeros(len(x), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        ok = (x < n) & (y < n)
        same = ok & (levels[k][np.minimum(x, n)] == levels[k][np.minimum(y, n)]) & (x + step <= n) & (y + step <= n)
        x, y, out = x + step * same, y + step * same, out + step * same
    return out


def lyndon(isa: np.ndarray) -> np.ndarray:
    """lambda[i]: length of the longest Lyndon word starting at i = next smaller suffix - i."""
    n = len(isa)
    table = [isa]
    while (1 << len(table)) <= n:
        prev, half = table[-1], 1 << (len(table) - 1)
        table.append(np.minimum(prev[: len(prev) - half], prev[half:]))
    pos = np.arange(1, n + 1)
    for k in range(len(table) - 1, -1, -1):
        block = table[k]
        inside = pos + (1 << k) <= n
        move = inside & (block[np.minimum(pos, len(block) - 1)] > isa)
        pos = pos + (1 << k) * move
    return pos - np.arange(n)


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of length >= max(6, 4 * period), by start then period."""
    if len(ids) < LEAST_LENGTH:
        return []
    short, place = without_gaps(ids)
    return [(int(place[start]), length, period) for start, length, period in lyndon_runs(short)]


def without_gaps(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`ids` with one separator, found nowhere else, for each gap that no run can touch; and the places of what is left.

    Every word of a run occurs LEAST_REPEATS times in it; so does a neighbour that would extend it. Runs of the
    result are therefore those of `ids`, and no run holds a separator.
    """
    number, count = np.unique(ids, return_inverse=True, return_counts=True)[1:]
    apart = np.r_[True, count[number] < LEAST_REPEATS, True]
    edges = np.flatnonzero(apart)
    # Each place lies behind its last edge; a stretch between two edges has one word less than they are apart.
    gap = (np.repeat(np.diff(edges), np.diff(edges)) <= LEAST_LENGTH)[1:] | apart[1:-1]
    first = gap & ~np.r_[False, gap[:-1]]
    place = np.flatnonzero(~gap | first)
    return np.where(gap, len(count) + np.arange(len(ids)), number)[place], place


def lyndon_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """The same as find_runs, from the Lyndon arrays of all of `ids`."""
    n = len(ids)
    if n < LEAST_LENGTH:
        return []
    forward = doubling(ids)
    backward = doubling(ids[::-1])
    found = set()
    for ranks in (ids, ids.max() - ids):
        isa = doubling(ranks)[-1][:-1] if ranks is not ids else forward[-1][:-1]
        lam = lyndon(isa)
        i = np.arange(n)
        ahead = i + lam < n
        ext = np.zeros(n, np.int64)
        ext[ahead] = lce(forward, i[ahead], (i + lam)[ahead])
        behind = i > 0
        back = np.zeros(n, np.int64)
        # Left extension: common extension of the reversed text at n - i and n - i - lambda.
        back[behind] = lce(backward, (n - i)[behind], (n - i - lam)[behind])
        start, length = i - back, lam + ext + back
        keep = length >= np.maximum(LEAST_LENGTH, LEAST_REPEATS * lam)
        found.update(zip(start[keep].tolist(), length[keep].tolist(), lam[keep].tolist()))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, words: list[bytes]) -> list[bytes]:
    """The input of a document: periodic words planted by its id where the rule says so."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(int(doc_id)).encode())
    g = h // 10
    if h % 10 != 0:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def describe(doc_id, text: str | None) -> dict:
    # bytes.split() parts at the same six characters as common.WORD.
    words = planted(doc_id, text.encode().split() if text else [])
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    runs = find_runs(ids)
    drop = np.zeros(len(words), bool)
    for start, length, period in runs:
        drop[start + period : start + length] = True
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
    kept = [w for w, d in zip(words, drop.tolist()) if not d] if runs else words
    return {
        "n_runs": len(runs),
        "start": best[0] if best else None, "length": best[1] if best else None, "period": best[2] if best else None,
        "exponent_milli": 1000 * best[1] // best[2] if best else None,
        "runs_sha256": hashlib.sha256("".join(f"{s},{ln},{p}\n" for s, ln, p in runs).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(b" ".join(kept)).hexdigest(),
    }


OUT = [("n_runs", T.LongType()), ("start", T.LongType()), ("length", T.LongType()), ("period", T.LongType()),
       ("exponent_milli", T.LongType()), ("runs_sha256", T.StringType()), ("collapsed_sha256", T.StringType())]


def detect(docs: DataFrame) -> DataFrame:
    """doc_id and the run columns for each row of `docs` (doc_id, text); one row each, no shuffle."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)] + [T.StructField(c, t) for c, t in OUT])

    def run(batches):
        for batch in batches:
            rows = [describe(None if pd.isna(d) else d, t) for d, t in zip(batch["doc_id"], batch["text"])]
            out = pd.DataFrame(rows, columns=[c for c, _ in OUT]).astype({c: "Int64" for c, t in OUT if t == T.LongType()})
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInPandas(run, schema)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark).parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return detect(docs)
