"""Lifecycle of directions and weekly movement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from signalloom.functions import constants as C, dates as D
from signalloom.operators.ranking import diverse_pick
from signalloom.operators.scores import lookup


def family(channel: Column, table: dict[str, str] = C.LIFECYCLE_FAMILIES) -> Column:
    """Source family of a channel; unknown channels are their own family."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, channel), channel)


def stage(dated: Column, trailing: Column, recent: Column, families: Column, publishers: Column, technical: Column,
          periods: Column) -> Column:
    return (F.when(dated == 0, "unobserved")
            .when((trailing == 0) | (recent == 0), "fading")
            .when((families >= 5) & (publishers >= 6) & (technical >= 2) & (periods >= 2), "established")
            .when((families >= 3) & (publishers >= 5) & (technical >= 2), "corroborating")
            .when((families >= 2) & (publishers >= 2) & (technical >= 1), "emerging")
            .otherwise("weak-signal"))


def confidence(col: Column) -> Column:
    return (F.when(col == "unobserved", "unobserved").when(col.isin("fading", "weak-signal"), "low")
            .when(col == "emerging", "moderate").otherwise("strong"))


def snapshots(df: DataFrame, key: str, as_of: str, weeks: list[int]) -> DataFrame:
    """Lifecycle snapshot per direction at several weekly dates.

    `df`: key, ts, publisher_id, family. Rows are first reduced to one per direction, publisher,
    family and each set of windows they fall in, so the dates multiply small counts and not records;
    nothing is joined to the list of dates.
    """
    per_date = F.array(*[F.struct(
        F.lit(w).alias("weeks_ago"),
        D.in_trailing(F.col("ts"), as_of, 90 + 7 * w, 7 * w).alias("t"),
        *[D.in_trailing(F.col("ts"), as_of, 7 * w + hi, 7 * w + hi - 30).alias(f"p{i}")
          for i, hi in enumerate((30, 60, 90))]) for w in weeks])
    hit = F.filter(per_date, lambda s: F.col("ts") <= D.days_before(as_of, 0) - F.make_dt_interval(s["weeks_ago"] * 7))
    small = (df.filter(F.col("ts") <= D.days_before(as_of, 7 * min(weeks)))
             .groupBy(key, "publisher_id", "family", hit.alias("hits")).agg(F.count("*").alias("n")))
    long = small.select(key, "publisher_id", "family", "n", F.inline("hits"))
    t = F.col("t")
    tech = F.col("family").isin(*C.TECHNICAL_FAMILIES)
    out = long.groupBy(key, "weeks_ago").agg(
        F.sum("n").alias("dated"), F.sum(F.when(t, F.col("n")).otherwise(0)).alias("evidence_count"),
        F.sum(F.when(F.col("p0"), F.col("n")).otherwise(0)).alias("recent_count"),
        F.count_distinct(F.when(t, F.col("family"))).alias("family_count"),
        F.count_distinct(F.when(t, F.col("publisher_id"))).alias("source_count"),
        F.count_distinct(F.when(t & tech, F.col("family"))).alias("technical_family_count"),
        *[F.max(F.col(f"p{i}").cast("int")).alias(f"p{i}") for i in range(3)])
    out = out.withColumn("active_periods", F.col("p0") + F.col("p1") + F.col("p2")).drop("p0", "p1", "p2")
    s = stage(F.col("dated"), F.col("evidence_count"), F.col("recent_count"), F.col("family_count"),
              F.col("source_count"), F.col("technical_family_count"), F.col("active_periods"))
    return out.withColumn("stage", s).withColumn("confidence", confidence(F.col("stage")))


def history(snaps: DataFrame, keys: DataFrame, key: str, weeks: list[int]) -> DataFrame:
    """Stage at every date, unobserved where nothing is dated yet, with the stage two weeks before."""
    grid = keys.select(key, F.explode(F.array(*[F.lit(w) for w in weeks])).alias("weeks_ago"))
    full = grid.join(snaps, [key, "weeks_ago"], "left").withColumn("stage", F.coalesce("stage", F.lit("unobserved")))
    w = Window.partitionBy(key).orderBy(F.col("weeks_ago").desc())   # a handful of dates per direction
    full = full.fillna({"evidence_count": 0, "source_count": 0, "family_count": 0})
    full = full.withColumn("previous_stage", F.lag("stage", 2).over(w))
    return full.withColumn("stage_changed", F.col("previous_stage").isNotNull() & (F.col("stage") != F.col("previous_stage")))


def family_summary(df: DataFrame, key: str, as_of: str) -> DataFrame:
    """Publishers, evidence and sources per direction and family in the trailing 90 days."""
    return df.filter(D.in_trailing(F.col("ts"), as_of, 90)).groupBy(key, "family").agg(
        F.count_distinct("publisher_id").alias("source_count"), F.count("*").alias("evidence_count"),
        F.array_sort(F.collect_set("source_id")).alias("source_ids"))


def movement(stage_col: Column, first_seen: Column, current: Column, previous: Column, as_of: str) -> Column:
    """14-day movement of a direction."""
    change = current - previous
    return (F.when(stage_col == "fading", "fading")
            .when(first_seen > D.days_before(as_of, 14), "new")
            .when((change >= 2) & (current >= F.greatest(F.lit(2), F.ceil(previous * 1.5))), "accelerating")
            .when((current > 0) & (previous == 0), "resurfacing")
            .when((change <= -2) & (previous >= F.greatest(F.lit(2), F.ceil(current * 1.5))), "cooling")
            .otherwise("steady"))


def signal_movement(df: DataFrame, stages: DataFrame, key: str, as_of: str) -> DataFrame:
    dated = df.filter(F.col("ts") <= D.instant(as_of))
    row = F.struct("ts", "id")
    s = dated.groupBy(key).agg(
        F.count_if(D.in_trailing(F.col("ts"), as_of, 14)).alias("current_count"),
        F.count_if(D.in_trailing(F.col("ts"), as_of, 28, 14)).alias("previous_count"),
        F.min(row).alias("first"), F.max(row).alias("last"))
    out = s.join(stages.select(key, "stage"), key)
    return out.select(
        key, "stage", "current_count", "previous_count", (F.col("current_count") - F.col("previous_count")).alias("change"),
        F.col("first.id").alias("origin_id"), F.col("first.ts").alias("first_observed"), F.col("last.ts").alias("last_observed"),
        movement(F.col("stage"), F.col("first.ts"), F.col("current_count"), F.col("previous_count"), as_of).alias("movement"))


def weekly_direction(recent: Column, prior: Column) -> Column:
    return (F.when((recent == 0) & (prior == 0), "inactive").when(prior == 0, "new")
            .when(recent >= prior * 1.5, "rising").when(prior >= recent * 1.5, "falling").otherwise("steady"))


def weekly_movement(df: DataFrame, as_of: str, limit: int = 10) -> DataFrame:
    """Records per theme in the last seven days against the seven before, top ten."""
    s = df.filter(D.in_trailing(F.col("ts"), as_of, 14)).groupBy("theme_id").agg(
        F.count_if(D.in_trailing(F.col("ts"), as_of, 7)).alias("recent"),
        F.count_if(D.in_trailing(F.col("ts"), as_of, 14, 7)).alias("prior"))
    out = s.withColumn("delta", F.col("recent") - F.col("prior")).withColumn(
        "direction", weekly_direction(F.col("recent"), F.col("prior")))
    return out.orderBy(F.desc("recent"), F.desc("delta"), "theme_id").limit(limit)


def citations(df: DataFrame, key: str, as_of: str, k: int = 8) -> DataFrame:
    """Up to eight citations per direction, families and publishers first.

    Candidates are the trailing 90 days, or all dated records where those are empty.
    """
    dated = df.filter(F.col("ts") <= D.instant(as_of))
    live = D.in_trailing(F.col("ts"), as_of, 90)
    active = dated.groupBy(key).agg(F.max(live).alias("_active"))
    pool = dated.withColumn("_live", live).join(active, key).filter(~F.col("_active") | F.col("_live"))
    return diverse_pick(pool.drop("_active", "_live"), [key], ["family", "publisher_id"],
                        [F.desc("published_at"), F.desc("id")], k)


def direction_order(df: DataFrame) -> list[Column]:
    """Order of directions: movement, then stage, then breadth."""
    move = lookup({m: i for i, m in enumerate(C.MOVEMENT_ORDER)}, F.col("movement"), 9)
    rank = lookup({s: i for i, s in enumerate(C.STAGE_ORDER)}, F.col("stage"), 0)
    return [move, rank.desc(), F.desc("family_count"), F.desc("source_count"), F.col("title")]
