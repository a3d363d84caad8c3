"""Joins that survive a hot key: heavy keys measured first, joined by broadcast, the rest by shuffle.

A fact table whose join key has a few keys on a large share of all rows sends each such
key to one task in a shuffle join. Here the keys are counted first (map-side combined, one
row per key), keys above `share` of all rows are the hot ones (at most 1 / share of them,
so their dimension rows are a bounded broadcast), fact rows of hot keys meet those
dimension rows by broadcast where they lie, and all other rows are joined by shuffle.
The result has the same rows as the plain join.

Defined cases: null keys never join (as in an inner join); an empty fact table gives no
rows; a dimension that repeats a key multiplies rows as the plain join does, and the
broadcast then holds at most `max_dim_rows` rows, else the plain join is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more than this share of the fact rows is hot.
HOT_SHARE = 0.01
MAX_DIM_ROWS = 1_000_000


def hot_keys(fact: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys with more than `share` of the rows: at most 1 / share of them reach the driver."""
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).count()
    total = fact.count()
    if total == 0:
        return []
    return [r[key] for r in counts.where(F.col("count") > share * total).select(key).collect()]


def skew_join(fact: DataFrame, dim: DataFrame, key: str, share: float = HOT_SHARE,
              max_dim_rows: int = MAX_DIM_ROWS) -> DataFrame:
    """fact JOIN dim USING (key), hot keys by broadcast, the rest by shuffle."""
    hot = hot_keys(fact, key, share)
    if not hot:
        return fact.join(dim, key)
    hot_dim = dim.where(F.col(key).isin(hot))
    if hot_dim.count() > max_dim_rows:
        return fact.join(dim, key)
    is_hot = F.col(key).isin(hot)
    by_broadcast = fact.where(is_hot).join(F.broadcast(hot_dim), key)
    by_shuffle = fact.where(~is_hot).join(dim.where(~is_hot), key)
    return by_broadcast.unionByName(by_shuffle)
