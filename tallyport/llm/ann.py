"""Nearest neighbours by a permutation index.

Pivots are directions of vectors of the table. A vector is represented by its FILES
nearest pivots in order of nearness; the index posts it in the inverted file of each of
these, with the pivot's place in that order. A query reads the files of its own nearest
pivots only and adds up how well the places agree; that sum is the footrule distance of
the two cut orders up to a constant. The best of the ranking are reranked by inner
product in double precision, and more of them as long as the later ones yield any.

Pivots and vectors reranked grow as the square root of the number of different vectors,
up to PIVOTS_MOST pivots, so the postings a query reads and its first reranking grow as
that root, not as the table. Only ranking still passes over one number per vector.

The index is cut into blocks of rows and the queries into blocks of queries; a task
holds one block of each, whatever the size of the table. Each block keeps its 20 best
for each query, and these are merged. Vectors that are equal are one entry of a block
and take one place in its ranking, so very many copies crowd nothing out.

Every row is indexed. Only the pivots are a sample: out of the 4 * pivots rows with the
least hash of their id those farthest from each other, so that near copies do not crowd
them. tests/llm measures recall against brute force; README has figures.

Defined cases: vectors that are null, zero, or hold null or non-finite components take
no part, nor do rows with a null id; of rows that share an id the least vector counts;
where vectors differ in length only those of the commonest length (the shorter on
ties) take part; a query with fewer candidates than asked for gets them all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyport.llm.common import table

NEAREST = 20
# Files that a vector is posted in and a query reads.
FILES = 64
# Pivots for the square root of the number of different vectors.
PIVOTS, PIVOTS_LEAST, PIVOTS_MOST = 4, 192, 2_048
# Vectors reranked first, for that root, over all blocks; the least number in a block.
RERANKED, RERANKED_LEAST = 28, 512
# Rows of a block, for the square root of the number of rows.
BLOCK, BLOCK_LEAST, BLOCK_MOST = 64, 16_384, 65_536
QUERY_BLOCK = 16_384
HIT = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id long, v array<double>): one row for each id that takes part."""
    v = F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), -1)


def spread_pivots(vectors: np.ndarray, pivots: int) -> np.ndarray:
    """Different directions, each the farthest from those before, so that near copies do not crowd the orders."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(pivots, len(unit)):
        nearest[chosen[-1]] = np.inf
        chosen.append(int(np.argmin(nearest)))
        np.maximum(nearest, unit @ unit[chosen[-1]], out=nearest)
    return unit[chosen]


def files_of(x: np.ndarray, pivots: np.ndarray, files: int) -> np.ndarray:
    """For each vector its `files` nearest pivots, nearest last."""
    found = np.empty((len(x), files), np.int16)
    for at in range(0, len(x), 1_024):
        near = x[at : at + 1_024] @ pivots.T
        last = np.argpartition(near, near.shape[1] - files, axis=1)[:, -files:]
        by_nearness = np.argsort(np.take_along_axis(near, last, axis=1), axis=1, kind="stable")
        found[at : at + 1_024] = np.take_along_axis(last, by_nearness, axis=1)
    return found


def best_scored(kinds: np.ndarray, q: np.ndarray, top: int, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in `kinds` and inner products of the `top` with the largest, largest first; no number in `kinds` is above `largest`."""
    pick = np.arange(len(kinds))
    # A product by BLAS, and what lies so near below the last of the top that rounding may have put it there.
    number = np.finfo(np.float64)
    slack = 4 * len(q) * number.eps * np.abs(q).sum() * largest + number.tiny
    if top < len(kinds) and np.isfinite(slack):
        rough = kinds @ q
        pick = np.flatnonzero(rough >= np.partition(rough, len(rough) - top)[len(rough) - top] - slack)
    score = (kinds[pick] * q).sum(axis=1)
    order = np.argsort(-score, kind="stable")[:top]
    return pick[order], score[order]


def search_block(ids: np.ndarray, x: np.ndarray, files: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
                 query_files: np.ndarray, pivots: int, nearest: int, share: float, least: int, front: int) -> pd.DataFrame:
    """The `nearest` of one block for each query, by footrule over the query's files and then inner product.

    As long as more than a tenth of the `front` nearest come from the later half of what
    was reranked, twice as many are.
    """
    by_id = np.argsort(ids, kind="stable")
    ids, x, files = ids[by_id], x[by_id], files[by_id]
    _, first, group = np.unique(x.view(np.dtype((np.void, x.shape[1] * 8))).ravel(), return_index=True, return_inverse=True)
    by_kind, copies = ids[np.argsort(group, kind="stable")], np.bincount(group)
    begin, copies = np.cumsum(copies) - copies, np.minimum(copies, nearest + 1)
    kinds, n, largest = x[first], len(first), float(np.abs(x).max())
    # The inverted files, one after another: the vectors posted in each and the place its pivot has with them.
    posted = files[first].ravel()
    by_file, sizes = np.argsort(posted, kind="stable"), np.bincount(posted, minlength=pivots)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    vector, place = by_file // files.shape[1], (by_file % files.shape[1] + 1).astype(np.uint8)
    places = np.arange(1, files.shape[1] + 1, dtype=np.uint8)
    first_take = min(n, max(least, nearest + 1, int(np.ceil(n * share))))
    out_q, out_i, out_s = [], [], []
    for qid, q, own in zip(query_ids.tolist(), queries, query_files):
        take = first_take
        if take < n:
            # Sum of |a - b| over all pivots, those without a place at 0, is a constant less twice the sum of min(a, b).
            read = [slice(a, b) for a, b in zip(starts[own].tolist(), ends[own].tolist())]
            both = np.minimum(np.concatenate([place[r] for r in read]), np.repeat(places, sizes[own]))
            agree = np.bincount(np.concatenate([vector[r] for r in read]), both, minlength=n)
        while take < n:
            best = np.argpartition(agree, n - take)[n - take :]
            found, score = best_scored(kinds.take(best, axis=0), q, nearest + 1, largest)
            found = best[found]
            half = np.partition(agree[best], take // 2)[take // 2]
            if np.count_nonzero(agree[found[:front]] < half) * 10 <= front:
                break
            take = min(n, 2 * take)
        else:
            found, score = best_scored(kinds, q, nearest + 1, largest)
        each = copies[found]
        i = by_kind[np.repeat(begin[found] - np.cumsum(each) + each, each) + np.arange(each.sum())]
        s = np.repeat(score, each)
        i, s = i[i != qid], s[i != qid]
        top = np.lexsort((i, -s))[:nearest]
        out_q.append(np.full(len(top), qid))
        out_i.append(i[top])
        out_s.append(s[top])
    return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_i), "score": np.concatenate(out_s)})


def search(vectors: DataFrame, is_query: Column, nearest: int = NEAREST, files: int = FILES, pivots: int | None = None,
           reranked: float = RERANKED, least: int = RERANKED_LEAST, block: int | None = None, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found for each row where `is_query`.

    `vectors` has vec_id and embedding; `is_query` is a condition on vec_id. Pivots and
    block follow from the table where they are not given.
    """
    if not 0 < files <= 255 or pivots is not None and not 0 < pivots < 2**15:
        raise ValueError("places are kept in 8 bits and pivots in 16: at most 255 files a vector and 32767 pivots")
    rows = usable(vectors)
    lengths = rows.groupBy(F.size("v").alias("length")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("v"), 0.01).alias("kinds")).orderBy(F.desc("n"), "length").limit(1).collect()
    if not lengths:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    rows, n, root = rows.filter(F.size("v") == lengths[0].length), lengths[0].n, max(1.0, lengths[0].kinds ** 0.5)
    pivots = pivots or min(PIVOTS_MOST, max(PIVOTS_LEAST, round(PIVOTS * root)))
    block = block or min(BLOCK_MOST, max(BLOCK_LEAST, round(BLOCK * n**0.5)))
    # Hashes are spread evenly: about twice the sample has hashes so small, and the tasks send no more between them.
    in_sample = F.xxhash64("vec_id") < F.lit(min(2**63 - 1, 2**64 * 8 * pivots // n - 2**63))
    sample = rows.filter(in_sample).orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * pivots).select("v").toPandas()["v"]
    found = np.unique(np.stack(sample.to_numpy()), axis=0)
    pivot = spread_pivots(found[np.random.default_rng(0).permutation(len(found))], pivots)
    files = min(files, len(pivot))
    n_blocks = -(-n // block)
    front = min(nearest, 5 + -(-nearest // n_blocks))
    n_query_blocks = max(1, -(-rows.filter(is_query).count() // query_block))

    def index(batches):
        for batch in batches:
            near = files_of(_matrix(batch.column("v")), pivot, files)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array([r.tobytes() for r in near], pa.binary())],
                ["vec_id", "v", "files"])

    indexed = rows.mapInArrow(index, "vec_id long, v array<double>, files binary")
    spread = lambda column, seed, parts: F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    posted = indexed.withColumn("block", spread("vec_id", 1, n_blocks)).withColumn("query_block", every(n_query_blocks))
    asked = indexed.filter(is_query).withColumn("query_block", spread("vec_id", 2, n_query_blocks)).withColumn("block", every(n_blocks))
    empty = pa.Table.from_pandas(pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
        {"query_id": "int64", "vec_id": "int64"}), preserve_index=False)

    def work(queries: pa.Table, postings: pa.Table) -> pa.Table:
        if not len(queries) or not len(postings):
            return empty
        part = lambda t: (t["vec_id"].to_numpy(), _matrix(t["v"]),
                          np.frombuffer(b"".join(t["files"].to_pylist()), np.int16).reshape(len(t), files))
        hits = search_block(*part(postings), *part(queries), len(pivot), nearest, reranked / root, least, front)
        return pa.Table.from_pandas(hits, preserve_index=False)

    keys = ["block", "query_block"]
    near = asked.groupBy(*keys).cogroup(posted.groupBy(*keys)).applyInArrow(work, HIT)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= nearest).select(
        "query_id", "rank", "vec_id", "score")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)
