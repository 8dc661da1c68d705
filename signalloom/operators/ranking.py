"""Capped and ranked picks.

`row_number() <= k` is used wherever only the first rows of a group are wanted: Spark then limits each
group before the shuffle, so a group with a third of all rows moves k rows per task and no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from signalloom.session import cut_lineage


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rn") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def first_per_group(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    return top_per_group(df, group, order, 1, "_rn").drop("_rn")


def numbered_top(df: DataFrame, order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows with their rank; k bounds the single numbered partition."""
    return df.orderBy(*order).limit(k).withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def global_rank(df: DataFrame, order: list[Column], rank: str = "rank", parts: int | None = None) -> DataFrame:
    """Rank of every row over the whole table without a single-task window.

    Rows are range-partitioned by the order and written once; a row's rank is its position in its
    partition plus the sizes of the partitions before it.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    placed = cut_lineage(placed, "range")
    sizes = placed.groupBy("_part").count()
    offsets = sizes.withColumn(
        "_offset", F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    ).select("_part", F.coalesce("_offset", F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (placed.withColumn("_pos", inside).join(offsets, "_part")
            .withColumn(rank, F.col("_pos") + F.col("_offset")).drop("_part", "_pos", "_offset"))


def contribution_caps(df: DataFrame, group: list[str], source: str, publisher: str, order: list[Column],
                      per_source: int = 2, per_publisher: int = 2) -> DataFrame:
    """Keep at most `per_source` rows of a source, then `per_publisher` of a publisher, in rank order.

    A source has one publisher, so its kept count before a row is the row's rank within the source.
    """
    kept = top_per_group(df, group + [source], order, per_source, "_rs")
    return top_per_group(kept, group + [publisher], order, per_publisher, "_rp").drop("_rs", "_rp")


def cap_exclusions(df: DataFrame, kept: DataFrame, group: list[str], source: str, publisher: str, key: str,
                   rank: Column, per_source: int = 2, per_publisher: int = 2) -> DataFrame:
    """Rows the caps dropped, with the caps that were full when they came up.

    Kept rows per publisher are at most the cap, so the joined list stays that short. It also tells which rows were
    kept, so `df` meets the kept rows once; a `key` has one publisher.
    """
    held = kept.groupBy(*group, publisher).agg(
        F.collect_list(F.struct(F.col(source).alias("s"), rank.alias("r"), F.col(key).alias("k"))).alias("_held"))
    held = held.select(*[F.col(c).alias(f"_{c}") for c in [*group, publisher]], "_held")
    meets = F.col(publisher).eqNullSafe(F.col(f"_{publisher}"))
    for c in group:
        meets = meets & (F.col(c) == F.col(f"_{c}"))
    rest = df.join(held, meets, "left").filter(~F.coalesce(F.exists("_held", lambda h: h["k"] == F.col(key)), F.lit(False)))
    rest = rest.drop(*[f"_{c}" for c in [*group, publisher]])
    before = rest.withColumn("_rank", rank).withColumn(
        "_before", F.filter(F.when(F.col(publisher).isNotNull() & F.col("_held").isNotNull(), F.col("_held")).otherwise(F.array()), lambda h: h["r"] < F.col("_rank")))
    same = F.size(F.filter("_before", lambda h: h["s"] == F.col(source)))
    reasons = F.array_compact(F.array(
        F.when(same >= per_source, "source-cap"),
        F.when(F.size("_before") >= per_publisher, "publisher-cap")))
    return before.withColumn("reason_codes", reasons).drop("_held", "_rank", "_before")


def diverse_pick(df: DataFrame, group: list[str], keys: list[str], order: list[Column], k: int) -> DataFrame:
    """First row of any of the `keys` values comes before all others; fill up to k in order.

    The firsts are found by grouped top-1 picks and the fill by a grouped top-k, all limited before
    the shuffle.
    """
    firsts = None
    for key in keys:
        f = first_per_group(df, group + [key], order)
        firsts = f if firsts is None else firsts.unionByName(f)
    firsts = top_per_group(firsts.dropDuplicates(group + ["id"]), group, order, k).drop("rn")
    fill = top_per_group(df, group, order, k).drop("rn")
    both = firsts.withColumn("_late", F.lit(0)).unionByName(fill.withColumn("_late", F.lit(1)))
    both = first_per_group(both, group + ["id"], [F.col("_late")])
    return top_per_group(both, group, [F.col("_late"), *order], k, "pick").drop("_late")


def signature_queue(df: DataFrame, signature: str, order: list[Column], per_signature: int = 3,
                    total: int = 25) -> DataFrame:
    """Review queue: at most three per signature, filled up by rank from the rest."""
    capped = top_per_group(df, [signature], order, per_signature).drop("rn").orderBy(*order).limit(total)
    fill = df.orderBy(*order).limit(2 * total)
    both = capped.withColumn("_late", F.lit(0)).unionByName(fill.withColumn("_late", F.lit(1)))
    both = first_per_group(both, ["name"], [F.col("_late"), *order])
    return numbered_top(both, [F.col("_late"), *order], total, "queue_rank").drop("_late")
