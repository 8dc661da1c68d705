"""Bounded samples for fitting, the same for every partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from signalloom.operators.ranking import top_per_group
from signalloom.session import small_table

GRAINS = 1 << 30
BROADCAST_VALUES = 10_000


def first_by_hash(df: DataFrame, by: str, id_: str, k: int) -> DataFrame:
    """Of each value of `by` the k rows first by a hash of the id, or all of them.

    Counts decide how small a hash must be for about 2k rows to be left, so no task ever ranks more of a
    class than that. They are broadcast where `by` has at most BROADCAST_VALUES values, else joined.
    """
    grain = F.pmod(F.xxhash64(id_), F.lit(GRAINS))
    counts = df.groupBy(by).agg(F.count("*").alias("_rows"))
    few = counts.limit(BROADCAST_VALUES + 1).collect()
    if len(few) <= BROADCAST_VALUES:
        counts = F.broadcast(small_table(df.sparkSession, [tuple(r) for r in few], counts.schema))
    near = df.join(counts, by).filter(grain * F.col("_rows").cast("double") < 2.0 * k * GRAINS).drop("_rows")
    return top_per_group(near, [by], [F.xxhash64(id_), F.col(id_)], k).drop("rn")
