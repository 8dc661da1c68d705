"""Comparison with the previous run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signalloom.functions import constants as C
from signalloom.operators.ranking import numbered_top
from signalloom.operators.scores import lookup


def changes(current: DataFrame, previous: DataFrame, force: bool = False) -> DataFrame:
    """new-record, materially-changed, unchanged or removed per id by fingerprint.

    `force` marks all current records changed, as after a change of policy (X11).
    """
    c = current.select("id", F.col("fingerprint").alias("_now"))
    p = previous.select("id", F.col("fingerprint").alias("_before"))
    kind = (F.when(F.col("_now").isNull(), "removed").when(F.col("_before").isNull(), "new-record")
            .when(F.lit(force) | ~F.equal_null("_now", F.col("_before")), "materially-changed").otherwise("unchanged"))
    return c.join(p, "id", "full_outer").select("id", kind.alias("change_type"))


def new_ids(current: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `current` whose keys the previous run did not have."""
    return current.join(previous.select(*keys).distinct(), keys, "left_anti")


def requirement_changes(current: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Change of each requirement: id, maturity, evidence_count."""
    if previous is None:
        return current.select("id", F.lit("baseline").alias("change_type"), F.lit(None).cast("string").alias("previous_maturity"),
                              F.col("maturity").alias("current_maturity"))
    p = previous.select("id", F.col("maturity").alias("_m"), F.col("evidence_count").alias("_n"))
    rank = {m: i for i, m in enumerate(C.MATURITY_ORDER)}
    now, old = lookup(rank, F.col("maturity"), -1), lookup(rank, F.col("_m"), -1)
    kind = (F.when(F.col("_m").isNull(), "added").when(now > old, "promoted").when(now < old, "demoted")
            .when(F.col("_n") != F.col("evidence_count"), "evidence-updated").otherwise("unchanged"))
    return current.join(p, "id", "left").select("id", kind.alias("change_type"), F.col("_m").alias("previous_maturity"),
                                               F.col("maturity").alias("current_maturity"))


def material_reasons(evidence_delta: int = 2, source_delta: int = 1) -> Column:
    """Reason codes of a candidate row joined to its previous state p_*."""
    c = F.col
    both = lambda f: c(f"p_{f}").isNotNull() & c(f).isNotNull() & (c(f"p_{f}") != c(f))
    codes = F.array_compact(F.array(
        F.when(both("stage"), "stage"), F.when(both("strength"), "strength"),
        F.when(both("movement") & c("movement").isin("new", "accelerating", "rising", "resurfacing"), "movement"),
        F.when(c("evidence_count") - F.coalesce("p_evidence_count", F.lit(0)) >= evidence_delta, "evidence"),
        F.when(c("source_count") - F.coalesce("p_source_count", F.lit(0)) >= source_delta, "sources"),
        F.when(c("recent_count") - F.coalesce("p_recent_count", F.lit(0)) > 0, "recent")))
    return F.when(c("p_id").isNull(), F.array(F.lit("new"))).otherwise(codes)


def adjudication_status(evidence_delta: int = 2, source_delta: int = 1) -> Column:
    """Whether a reviewed candidate still stands on its reviewed state r_* (X6); null when never reviewed."""
    c = F.col
    holds = (F.equal_null("stage", c("r_stage")) & (c("evidence_count") - c("r_evidence_count") < evidence_delta)
             & (c("source_count") - c("r_source_count") < source_delta))
    return F.when(c("r_id").isNotNull(), F.when(holds, "current").otherwise("revisit-required"))


def assessment_queue(candidates: DataFrame, minimum: int = 45, size: int = 10, per_origin: int = 4) -> DataFrame:
    """Material, unsettled candidates that are linked or score enough.

    Linked ones come first and count against their origin; unlinked ones fill each origin up to
    `per_origin`. The per-origin picks are grouped top-k, so no origin is ranked whole.
    """
    from signalloom.operators.ranking import top_per_group
    order = [F.desc("priority"), F.col("title"), F.col("id")]
    ok = candidates.filter((F.size("change_reasons") > 0) & (F.coalesce("adjudication", F.lit("")) != "current")
                           & ((F.col("priority") >= minimum) | F.col("linked")))
    # once `size` linked rows of an origin exist the queue is full, so a grouped top-k counts enough
    linked = ok.filter("linked").orderBy(*order).limit(size)
    used = linked.groupBy("origin").agg(F.count("*").alias("_used"))
    free = top_per_group(ok.filter("not linked"), ["origin"], order, per_origin, "_ro").join(used, "origin", "left")
    free = free.filter(F.col("_ro") + F.coalesce("_used", F.lit(0)) <= per_origin).drop("_ro", "_used")
    both = linked.withColumn("_late", F.lit(0)).unionByName(free.withColumn("_late", F.lit(1)))
    return numbered_top(both, [F.col("_late"), *order], size, "queue_rank").drop("_late")


def carry_over(previous_queue: DataFrame, candidates: DataFrame, queue: DataFrame, size: int = 10) -> DataFrame:
    """Same-cycle queue: what was queued and is still open stays in its order, new entries follow."""
    open_now = candidates.filter(F.coalesce("adjudication", F.lit("")) != "current").select("id")
    held = previous_queue.join(open_now, "id", "left_semi").select("id", F.col("queue_rank").alias("_r"), F.lit(0).alias("_late"))
    fresh = queue.join(held, "id", "left_anti").select("id", F.col("queue_rank").alias("_r"), F.lit(1).alias("_late"))
    out = numbered_top(held.unionByName(fresh), [F.col("_late"), F.col("_r"), F.col("id")], size, "queue_rank")
    return out.select("id", (F.col("_late") == 0).alias("carried"), "queue_rank")


def upsert(existing: DataFrame, incoming: DataFrame, keep_first_date: str = "company-directory") -> DataFrame:
    """Keyed upsert (S4): the incoming row wins; directory rows keep their first date.

    `incoming` may repeat an id; its last row by ingest_ts counts.
    """
    from signalloom.operators.ranking import first_per_group
    newest = first_per_group(incoming, ["id"], [F.desc("ingest_ts")])
    dates = existing.select("id", F.col("published_at").alias("_first"))
    kept = F.when((F.col("source_type") == keep_first_date) & (F.coalesce("_first", F.lit("")) != ""), F.col("_first"))
    fresh = newest.join(dates, "id", "left").withColumn("published_at", F.coalesce(kept, F.col("published_at"))).drop("_first")
    rest = existing.join(newest.select("id"), "id", "left_anti")
    return rest.unionByName(fresh, allowMissingColumns=True)
