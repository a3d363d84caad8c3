"""Compare a rollup with the same figures from the base tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(view: DataFrame, base: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row: row counts, keys on one side only, greatest difference and null-against-value count per measure.

    Keys match null-safely, so a NULL key meets the NULL key of the other side. A measure
    that is NULL on one side and a value on the other is not a difference of zero: it is
    counted in `null_mismatch_<measure>`; the greatest difference covers pairs of values.
    """
    left = view.select(*[F.col(k).alias(f"view_key_{i}") for i, k in enumerate(keys)],
                       *[F.col(m).cast("double").alias(f"view_{m}") for m in measures], F.lit(1).alias("in_view"))
    right = base.select(*[F.col(k).alias(f"base_key_{i}") for i, k in enumerate(keys)],
                        *[F.col(m).cast("double").alias(f"base_{m}") for m in measures], F.lit(1).alias("in_base"))
    on = [F.col(f"view_key_{i}").eqNullSafe(F.col(f"base_key_{i}")) for i in range(len(keys))]
    matched = left.join(right, on, "full")
    both = F.col("in_view").isNotNull() & F.col("in_base").isNotNull()
    return matched.agg(
        F.count("in_view").alias("view_rows"),
        F.count("in_base").alias("base_rows"),
        F.count_if(F.col("in_view").isNull() | F.col("in_base").isNull()).alias("unmatched_keys"),
        *[
            F.coalesce(F.max(F.abs(F.col(f"view_{m}") - F.col(f"base_{m}"))), F.lit(0.0)).alias(f"max_diff_{m}")
            for m in measures
        ],
        *[
            F.count_if(both & (F.col(f"view_{m}").isNull() != F.col(f"base_{m}").isNull())).alias(f"null_mismatch_{m}")
            for m in measures
        ],
    )
