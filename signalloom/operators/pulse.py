"""Event attention, substance and persistence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signalloom.functions import constants as C, dates as D
from signalloom.operators.ranking import first_per_group
from signalloom.operators.resolve import echo_key


def strength() -> Column:
    """Inspectable artifacts beat claims when echoes share a key."""
    t = F.col("source_type")
    return (F.when(t.isin(*C.HARD_ARTIFACT_TYPES), 4).when(t == "hackathon-project", 3)
            .when(F.size("artifact_urls") > 0, 2).when(t == "event-session", 1).otherwise(0))


def artifact_weight() -> Column:
    t = F.col("source_type")
    return (F.when(t.isin(*C.HARD_ARTIFACT_TYPES), 1.0).when(t == "hackathon-project", 0.5)
            .when(F.size("artifact_urls") > 0, 0.35).otherwise(0.0))


def technical_weight(channel: Column) -> Column:
    t = F.col("source_type")
    return (F.when(t.isin(*C.HARD_ARTIFACT_TYPES), 1.0).when(t == "hackathon-project", 0.5)
            .when(channel == "event-program", 0.25).when(channel.isin(*C.TECHNICAL_CHANNELS), 0.75).otherwise(0.0))


def score_label(score: Column) -> Column:
    return (F.when(score.isNull(), "not-assessed").when(score >= 80, "very-high").when(score >= 60, "high")
            .when(score >= 40, "moderate").otherwise("limited"))


def linked(evidence: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per record and event with echo key, channel, strength and weights."""
    dim = sources.select(F.col("id").alias("source_id"), "channel")
    e = evidence.join(dim, "source_id", "left").withColumn("channel", F.coalesce("channel", F.col("source_type")))
    is_art = F.col("source_type").isin(*C.ARTIFACT_TYPES) | (F.size("artifact_urls") > 0)
    return (e.withColumn("key", echo_key()).withColumn("strength", strength()).withColumn("artifact", is_art)
            .withColumn("aw", artifact_weight()).withColumn("tw", technical_weight(F.col("channel")))
            .select(F.explode("event_ids").alias("event_id"), "id", "source_id", "source_type", "published_at", "ts", "channel",
                    "theme_ids", "key", "strength", "artifact", "aw", "tw"))


def strongest(rows: DataFrame) -> DataFrame:
    return first_per_group(rows, ["event_id", "key"], [F.desc("strength"), F.desc("id")])


def checkpoints(rows: DataFrame, events: DataFrame, as_of: str) -> DataFrame:
    """Status of every event and review window.

    `rows` as from linked(). Keys already seen by the end of the event are removed by an anti join on
    one row per key; later records collapse per key first, so a much repeated key counts once.
    """
    ends = events.select(F.col("id").alias("event_id"), F.col("end_date").cast("timestamp").alias("finish"),
                         F.col("source_ids").alias("official"), F.explode("review_windows_days").alias("days"))
    due = F.col("finish") + F.make_dt_interval(F.col("days"))
    any_item = rows.groupBy("event_id").agg(F.count("*").alias("items"))
    r = rows.join(ends.select("event_id", "finish", "official").distinct(), "event_id")
    baseline = r.filter(F.col("ts") <= F.col("finish")).select("event_id", "key").distinct()
    later = (r.filter((F.col("ts") > F.col("finish")) & ~F.array_contains("official", F.col("source_id")))
             .join(baseline, ["event_id", "key"], "left_anti")
             .join(ends.select("event_id", "days"), "event_id").filter(F.col("ts") <= due))
    kept = first_per_group(later, ["event_id", "days", "key"], [F.desc("strength"), F.desc("id")])
    n = kept.groupBy("event_id", "days").agg(F.count("*").alias("n"), F.count_distinct("source_id").alias("s"))
    out = ends.join(any_item, "event_id", "left").join(n, ["event_id", "days"], "left")
    pending = F.lit(as_of).cast("timestamp") < due
    found = F.coalesce("n", F.lit(0))
    status = (F.when(F.col("items").isNull(), "not-assessed").when(pending, "pending")
              .when((found >= 3) & (F.col("s") >= 2), "confirmed").when(found > 0, "limited").otherwise("not-observed"))
    done = F.col("items").isNotNull() & ~pending
    return out.select("event_id", "days", F.date_format(due, "yyyy-MM-dd").alias("due_at"), status.alias("status"),
                      F.when(done, found).otherwise(0).alias("evidence_count"),
                      F.when(done, F.coalesce("s", F.lit(0))).otherwise(0).alias("source_count"))


def dossiers(rows: DataFrame, events: DataFrame, checks: DataFrame) -> DataFrame:
    """Attention, substance and record counts per event."""
    obs = strongest(rows)
    arts = strongest(rows.filter("artifact"))
    social = F.col("source_type") == "curated-social"
    whole = rows.groupBy("event_id").agg(
        F.count("*").alias("evidence_count"), F.count_distinct("source_id").alias("source_count"),
        F.count_if(social).alias("social_observation_count"))
    o = obs.groupBy("event_id").agg(
        F.count("*").alias("independent_observation_count"), F.count_distinct("source_id").alias("independent_source_count"),
        F.count_distinct("channel").alias("source_family_count"), F.count_if(F.col("tw") > 0).alias("technical_record_count"),
        F.avg("tw").alias("technical_share"))
    kind = F.when(F.col("source_type").isin(*C.ARTIFACT_TYPES), F.col("source_type")).otherwise("linked-artifact")
    a = arts.groupBy("event_id").agg(
        F.count("*").alias("artifact_count"), (F.sum(F.bround(F.col("aw") * 100, 0).cast("long")) / 100).alias("weighted"), F.count_distinct(kind).alias("artifact_kinds"))
    f = checks.groupBy("event_id").agg(F.max("evidence_count").alias("follow"))
    d = (events.select(F.col("id").alias("event_id"), "name").join(whole, "event_id", "left").join(o, "event_id", "left")
         .join(a, "event_id", "left").join(f, "event_id", "left"))
    counts = ["evidence_count", "source_count", "social_observation_count", "independent_observation_count",
              "independent_source_count", "source_family_count", "technical_record_count", "artifact_count", "artifact_kinds", "follow"]
    d = d.fillna(0, counts).fillna(0.0, ["weighted", "technical_share"])
    active = F.col("evidence_count") > 0
    least = lambda top, c: F.least(F.lit(top), c.cast("long"))
    follow = least(20, F.col("follow") * 5)
    attention = (least(35, F.bround(12 * F.log1p("independent_observation_count"), 0)) + least(25, F.col("independent_source_count") * 8)
                 + least(20, F.col("source_family_count") * 5) + follow)
    substance = (least(35, F.bround(12 * F.log1p("weighted"), 0)) + F.bround(25 * F.col("technical_share"), 0).cast("long")
                 + least(20, F.col("artifact_kinds") * 10) + follow)
    d = d.withColumn("attention", F.when(active, attention)).withColumn("substance", F.when(active, substance))
    return d.select(
        "event_id", "name", F.when(active, "active").otherwise("configured").alias("analysis_status"), *counts[:-2],
        (F.col("evidence_count") - F.col("independent_observation_count")).alias("echo_records_collapsed"),
        (F.col("independent_observation_count") - F.col("technical_record_count")).alias("narrative_record_count"),
        F.bround("weighted", 1).alias("weighted_artifact_count"), "attention", score_label(F.col("attention")).alias("attention_label"),
        "substance", score_label(F.col("substance")).alias("substance_label"))


def top_themes(rows: DataFrame, k: int = 8) -> DataFrame:
    """Leading themes of each event's independent observations."""
    from signalloom.operators.ranking import top_per_group
    c = strongest(rows).select("event_id", F.explode("theme_ids").alias("theme_id")).groupBy("event_id", "theme_id").agg(
        F.count("*").alias("evidence_count"))
    return top_per_group(c, ["event_id"], [F.desc("evidence_count"), F.col("theme_id")], k)


def dossier_order() -> list[Column]:
    """Active events first, then by attention, then by name."""
    return [(F.col("analysis_status") != "active"), F.coalesce("attention", F.lit(-1)).desc(), F.col("name")]
