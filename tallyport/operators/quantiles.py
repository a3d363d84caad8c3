"""Exact quantiles in bounded memory: a KLL sketch brackets the rank, exact counts confirm it.

Each round reads the values inside the current bracket once: a KLL sketch of them gives
values a little below and above the wanted ranks, one aggregation counts exactly how
many values lie below and inside the narrower bracket, and the bracket is taken only if
it still holds the wanted ranks (else the margin doubles). When at most BUFFER values
are left, they are the only rows brought to the driver, and the answer is read off
exactly. Memory never holds more than the sketch and BUFFER values, whatever the rows;
the number of rounds grows as the logarithm of the rows.

The result equals Spark's `percentile` (linear between the two closest ranks).
Defined cases: nulls are skipped (NaN too); no values gives None; ties are handled,
as a bracket whose ends are equal is the answer.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUFFER = 100_000
SKETCH_K = 200
# Normalised rank error of a sketch of that size, with room to spare.
MARGIN = 0.02


def exact_percentile(frame: DataFrame, column: str, p: float, buffer: int = BUFFER) -> float | None:
    """The p-th percentile of `column` (0 <= p <= 1), as `percentile` gives it, in rounds of bounded memory."""
    v = F.col(column).cast("double")
    values = frame.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    n = values.count()
    if n == 0:
        return None
    pos = p * (n - 1)
    want = (math.floor(pos), math.ceil(pos))
    low, high, below, inside = None, None, 0, n
    margin = MARGIN
    while inside > buffer:
        bracket = _within(values, low, high)
        sketch = bracket.agg(F.kll_sketch_agg_double("v", SKETCH_K).alias("s"))
        q_low = max(0.0, (want[0] - below) / inside - margin)
        q_high = min(1.0, (want[1] - below + 1) / inside + margin)
        new_low, new_high = sketch.select(F.kll_sketch_get_quantile_double("s", F.lit(q_low)),
                                          F.kll_sketch_get_quantile_double("s", F.lit(q_high))).first()
        counts = bracket.agg(F.count_if(F.col("v") < new_low).alias("under"),
                             F.count_if((F.col("v") >= new_low) & (F.col("v") <= new_high)).alias("kept")).first()
        under, kept = below + counts["under"], counts["kept"]
        if not (under <= want[0] and want[1] < under + kept):
            margin *= 2
            continue
        if new_low == new_high:
            return float(new_low)
        if kept >= inside:
            margin /= 2
            if margin < 1 / (4 * inside):
                break
            continue
        low, high, below, inside = new_low, new_high, under, kept
    # At most `buffer` values, or a bracket that no sketch narrows further, ordered in one task.
    rest = [r.v for r in _within(values, low, high).orderBy("v").collect()]
    a, b = rest[want[0] - below], rest[want[1] - below]
    return float(a + (pos - want[0]) * (b - a))


def _within(values: DataFrame, low: float | None, high: float | None) -> DataFrame:
    if low is None:
        return values
    return values.where((F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high)))
