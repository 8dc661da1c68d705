"""The weekly review: candidates of four origins, their requirements, queue and changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signalloom.functions import constants as C
from signalloom.operators import change as H, scores as S
from signalloom.operators.ranking import numbered_top
from signalloom.session import cut_lineage, small_table

#: Origin of a candidate, prefix of its id and of the analysis it comes from.
ORIGINS = {
    "early": ("early-signal", "early:", "early-signal-tracker/"),
    "experts": ("expert-finding", "expert-finding:", "expert-pulse/"),
    "narratives": ("operator-narrative", "operator-narrative:", "operator-narratives/"),
    "themes": ("cross-source-theme", "theme:", "themes/"),
}
#: What an item may state itself; where it does, it goes before what its cited records give.
OWN = ["evidence_count", "source_count", "family_count"]
NULLS = {"stage": "string", "strength": "string", "movement": "string", **{c: "bigint" for c in OWN}}


def candidate_union(items: dict[str, DataFrame]) -> DataFrame:
    """id, origin, title, source_analysis, stage, strength, movement, own_*: candidates of all origins.

    items: by origin (`early`, `experts`, `narratives`, `themes`) rows with id, title and any of stage, strength,
    movement, evidence_count, source_count, family_count.
    """
    out = None
    for origin, rows in items.items():
        name, prefix, analysis = ORIGINS[origin]
        have = lambda c: F.col(c).cast(NULLS[c]) if c in rows.columns else F.lit(None).cast(NULLS[c])  # noqa: E731, B023
        part = rows.select(
            F.concat(F.lit(prefix), F.col("id")).alias("id"), F.lit(name).alias("origin"), "title", F.concat(F.lit(analysis), F.col("id")).alias("source_analysis"),
            have("stage").alias("stage"), have("strength").alias("strength"), have("movement").alias("movement"), *[have(c).alias(f"own_{c}") for c in OWN])
        out = part if out is None else out.unionByName(part)
    return out


def candidate_links(links: dict[str, DataFrame]) -> DataFrame:
    """(candidate_id, id) of the records that the items of each origin cite; rows (item, id) by origin."""
    out = None
    for origin, rows in links.items():
        part = rows.select(F.concat(F.lit(ORIGINS[origin][1]), F.col("item")).alias("candidate_id"), "id")
        out = part if out is None else out.unionByName(part)
    return out


def match_by_keys(asked: DataFrame, known: DataFrame) -> DataFrame:
    """(id, target, kind, turn): what each row finds under several keys tried in order.

    asked: id, keys, an array of (kind, key) in the order of preference; known: kind, key, target. One join takes all
    keys; a target found twice counts where it was found first, and `turn` orders the targets of a row. Null keys
    find nothing.
    """
    keys = asked.select("id", F.posexplode("keys").alias("turn", "k")).select("id", "turn", "k.kind", "k.key").filter("key is not null")
    hit = keys.join(known.filter("key is not null"), ["kind", "key"])
    return hit.groupBy("id", "target").agg(F.min(F.struct("turn", "kind")).alias("at")).select("id", "target", "at.kind", "at.turn")


def linked_requirements(candidates: DataFrame, requirements: DataFrame, adjudications: DataFrame) -> DataFrame:
    """(id, requirements, linked_by): requirements behind each candidate that has any.

    First the requirement that names the candidate's analysis (the first of several by `position` where there is
    one, else by id), then those its adjudication names, each once. A row per candidate and requirement is
    shuffled; a candidate lists as many as its adjudication names, plus one.
    """
    first = F.col("position") if "position" in requirements.columns else F.col("id")
    by_analysis = requirements.filter("source_analysis is not null").groupBy(F.col("source_analysis").alias("key")).agg(F.min_by("id", first).alias("target"))
    known = by_analysis.select(F.lit("analysis").alias("kind"), "key", "target").unionByName(
        requirements.select(F.lit("adjudication").alias("kind"), F.col("id").alias("key"), F.col("id").alias("target")).distinct())
    named = adjudications.groupBy(F.col("candidate_id").alias("id")).agg(F.min("requirement_ids").alias("ids"))
    one = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
    keys = F.concat(F.array(one("analysis", F.col("source_analysis"))), F.transform(F.coalesce("ids", F.array().cast("array<string>")), lambda r: one("adjudication", r)))
    hit = match_by_keys(candidates.join(named, "id", "left").select("id", keys.alias("keys")), known)
    rows = hit.join(requirements.select(F.col("id").alias("target"), "maturity"), "target")
    return rows.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.col("target").alias("id"), "maturity", "kind"))),
                                              lambda x: x.dropFields("turn")).alias("linked_requirements"))


def candidate_pool(candidates: DataFrame, links: DataFrame, evidence: DataFrame, requirements: DataFrame, previous: DataFrame,
                   adjudications: DataFrame, as_of: str, technical: list[str] | None = None) -> DataFrame:
    """Candidates with metrics, requirements, priority, change reasons and adjudication (M6: J8, J9, A16, A17, X5, X6).

    previous: id, stage, strength, movement, evidence_count, source_count, recent_count of the run before;
    adjudications: candidate_id, outcome, requirement_ids, stage, evidence_count, source_count as reviewed.
    """
    m = S.candidate_metrics(links, evidence, as_of, technical or C.TECHNICAL_SOURCE_TYPES).withColumnRenamed("candidate_id", "id")
    out = candidates.join(m, "id", "left").join(linked_requirements(candidates, requirements, adjudications), "id", "left")
    out = out.fillna(0, ["evidence_count", "source_count", "recent_evidence_count", "technical_record_count"])
    families = F.size(F.coalesce("source_types", F.array().cast("array<string>"))).cast("long")
    live = F.when(F.col("recent_evidence_count") > 0, "new").otherwise("steady")
    found = F.col("origin").isin("expert-finding", "operator-narrative")
    out = out.select(
        "id", "origin", "title", "source_analysis", "stage", "strength", F.when(found, live).otherwise(F.coalesce("movement", F.lit("steady"))).alias("movement"),
        F.coalesce("own_evidence_count", "evidence_count").alias("evidence_count"), F.coalesce("own_source_count", "source_count").alias("source_count"),
        F.coalesce("own_family_count", families).alias("family_count"), "recent_evidence_count", "technical_record_count", F.col("recent_evidence_count").alias("recent_count"),
        F.coalesce("linked_requirements", F.array().cast("array<struct<id:string,maturity:string,kind:string>>")).alias("linked_requirements"))
    out = out.withColumn("linked", F.size("linked_requirements") > 0)
    out = out.withColumn("priority", S.priority(S.lookup(C.MOVEMENT_POINTS, F.col("movement"), 8), F.col("source_count"), F.col("family_count"),
                                                F.col("technical_record_count"), F.col("recent_evidence_count"), F.col("linked")))
    p = previous.select(*[F.col(c).alias(f"p_{c}") for c in ("id", "stage", "strength", "movement", "evidence_count", "source_count", "recent_count")])
    r = adjudications.select(F.col("candidate_id").alias("r_id"), "outcome", *[F.col(c).alias(f"r_{c}") for c in ("stage", "evidence_count", "source_count")]).dropDuplicates(["r_id"])
    out = out.join(p, out["id"] == p["p_id"], "left").join(r, out["id"] == r["r_id"], "left")
    out = out.withColumn("change_reasons", H.material_reasons()).withColumn("adjudication", H.adjudication_status())
    action = (F.when(F.col("adjudication") == "current", F.col("outcome")).when(F.col("linked"), "review-existing-requirement").otherwise("assess-new-requirement"))
    return out.withColumn("review_action", action).drop(*p.columns, *r.columns)


def without_added(queue: DataFrame, candidates: DataFrame, changes: DataFrame, size: int) -> DataFrame:
    """The queue without candidates whose requirement was added in this run, ranked anew."""
    added = changes.filter("change_type = 'added'").select(F.col("id").alias("requirement"))
    held = candidates.select("id", F.explode("linked_requirements.id").alias("requirement")).join(added, "requirement", "left_semi").select("id").distinct()
    left = queue.join(held, "id", "left_anti")
    return numbered_top(left.withColumnRenamed("queue_rank", "_r"), [F.col("_r")], size, "queue_rank").drop("_r")


def weekly_review(candidates: DataFrame, requirements: DataFrame, previous_requirements: DataFrame | None, verification: DataFrame,
                  previous: dict[str, DataFrame] | None, same_cycle: bool, minimum: int = 45, size: int = 10, per_origin: int = 4) -> dict[str, DataFrame]:
    """The review as tables (M6): candidates, queue, adjudications, requirement_changes, verification, meta.

    candidates: of candidate_pool; verification: of A26, with new_record_count; previous: tables of the run before
    (`queue`, `requirement_changes`, `verification`), None in the first run. Within one cycle the queue of the run
    before goes first (X7). If then nothing changed - no candidate, no requirement, no new verification record -
    changes and verification are those of the run before, and `meta` says so (X8).
    """
    pool = cut_lineage(candidates, "candidates")
    queue = H.assessment_queue(pool, minimum, size, per_origin).select("id", "queue_rank")
    if previous is not None and same_cycle:
        queue = H.carry_over(previous["queue"], pool, queue, size)
    else:
        queue = queue.select("id", F.lit(False).alias("carried"), "queue_rank")
    changes = cut_lineage(H.requirement_changes(requirements, previous_requirements), "changes")
    queue = cut_lineage(without_added(queue, pool, changes, size), "queue")
    verification = cut_lineage(verification, "verification")
    moved = changes.filter(~F.col("change_type").isin("unchanged", "baseline"))
    kept = (previous is not None and same_cycle and pool.filter(F.size("change_reasons") > 0).isEmpty() and moved.isEmpty()
            and verification.filter("new_record_count > 0").isEmpty())
    adjudications = pool.filter("adjudication is not null").select("id", "origin", "stage", "evidence_count", "source_count", "adjudication", "review_action")
    rows = pool.agg(F.count("*").alias("candidates"), F.count_if(F.size("change_reasons") > 0).alias("changed"), F.count("adjudication").alias("adjudications"))
    meta = rows.unpivot([], rows.columns, "metric", "value")
    more = queue.agg(F.count("*").alias("queue"), F.count_if("carried").alias("carried"))
    meta = meta.unionByName(more.unpivot([], more.columns, "metric", "value")).unionByName(moved.agg(F.lit("requirement_changes").alias("metric"), F.count("*").alias("value")))
    flags = small_table(pool.sparkSession, [("baseline", int(previous is None)), ("idempotent", int(kept))], "metric string, value long")
    meta = meta.unionByName(flags)
    return {"candidates": pool, "queue": queue, "adjudications": adjudications, "requirement_changes": previous["requirement_changes"] if kept else changes,
            "verification": previous["verification"] if kept else verification, "meta": meta}

