"""Normalized evidence and the marts built from the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signalloom.functions import dates as D, text as X
from signalloom.functions.arrays import explode_rows
from signalloom.operators import change as H, classify as K, lifecycle as L, pulse as P, ranking as R
from signalloom.operators import quality as Q, resolve as V, scores as S
from signalloom.session import cut_lineage


def normalized_evidence(df: DataFrame, sources: DataFrame, layers: dict[str, list[str]]) -> DataFrame:
    """Public evidence in the shared shape.

    A date that only says when the record was first seen moves to observed_at and counts in no month.
    """
    first_seen = F.try_element_at("metadata", F.lit("date_basis")) == "first-observed"
    first_seen = F.coalesce(first_seen, F.lit(False))
    dim = sources.select(F.col("id").alias("source_id"), F.col("publisher_id").alias("_publisher"))
    published = F.when(first_seen, F.lit("")).otherwise(F.col("published_at"))
    month = D.month_key(published)
    none = F.create_map().cast("map<string,bigint>")
    return df.join(dim, "source_id", "left").select(
        "id", "source_id", F.coalesce("_publisher", F.col("source_id")).alias("publisher_id"), "source_type",
        F.lit("public-source-item").alias("evidence_kind"), "title", "summary", "sponsor_status", "url",
        published.alias("published_at"), F.when(first_seen, F.col("published_at")).otherwise(F.lit("")).alias("observed_at"),
        F.when(~first_seen, F.col("ts")).alias("ts"), "projects", "artifact_urls", "theme_ids",
        F.when(F.size("theme_ids") > 0, "classified").when(F.col("disposition") == "classified", "classification-review")
        .otherwise(F.col("disposition")).alias("disposition"), "rule_id",
        K.stack_layers(F.col("theme_ids"), layers).alias("stack_layers"), F.lit(1).alias("support_count"),
        F.when(month != "", F.create_map(month, F.lit(1).cast("bigint"))).otherwise(none).alias("monthly_counts"),
        F.struct(F.lit("direct-public-metadata").alias("mode")).alias("provenance"),
        Q.verification(F.col("metadata"), F.col("source_type")).alias("verification"))


def aggregate_evidence(rows: DataFrame, mapping: dict[str, list[str]], source_id: str, as_of: str) -> DataFrame:
    """Aggregate analyses as evidence rows (N17): name and month per mention become support and months."""
    monthly = rows.groupBy("name", "month").agg(F.count("*").alias("n"))
    s = monthly.groupBy("name").agg(F.sum("n").alias("support_count"),
                                    F.map_from_entries(F.array_sort(F.collect_list(F.struct("month", "n")))).alias("monthly_counts"))
    table = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.array(*[F.lit(i) for i in v]))])
    themes = F.coalesce(F.try_element_at(table, F.col("name")), F.array().cast("array<string>"))
    return s.select(
        F.concat(F.lit("trend:"), "name").alias("id"), F.lit(source_id).alias("source_id"), F.lit(source_id).alias("publisher_id"),
        F.lit("newsletter-analysis").alias("source_type"), F.lit("aggregate-analysis").alias("evidence_kind"), F.col("name").alias("title"),
        F.lit(as_of).alias("published_at"), themes.alias("theme_ids"),
        F.when(F.size(themes) > 0, "classified").otherwise("classification-review").alias("disposition"),
        "support_count", "monthly_counts")


def search_evidence(df: DataFrame, text: str = "", source: str = "", theme: str = "", disposition: str = "", limit: int = 100) -> DataFrame:
    """Evidence search (F15); the first hundred, newest first, is the feature."""
    hay = F.lower(F.concat_ws(" ", "title", "summary", F.array_join("projects", " ")))
    out = df.filter(F.contains(hay, F.lit(text.lower()))) if text else df
    if source:
        out = out.filter(F.col("source_id") == source)
    if theme:
        out = out.filter(F.array_contains("theme_ids", theme))
    if disposition:
        out = out.filter(F.col("disposition") == disposition)
    return out.orderBy(F.desc("published_at"), F.desc("id")).limit(limit)


def search_themes(themes: DataFrame, text: str) -> DataFrame:
    return themes.filter(F.contains(F.lower(F.concat_ws(" ", "name", F.array_join("aliases", " "))), F.lit(text.lower())))


def search_projects(projects: DataFrame, text: str = "", status: str = "", action: str = "", cross_source: bool | None = None) -> DataFrame:
    """Project search by text, review state, action and cross-source flag."""
    out = projects.filter(F.contains(F.lower("name"), F.lit(text.lower()))) if text else projects
    if status:
        out = out.filter(F.col("review_status") == status)
    if action:
        out = out.filter(F.col("action") == action)
    if cross_source is not None:
        out = out.filter(F.col("cross_source") == cross_source)
    return out


def option_list(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """Distinct values with a custom order, unknown ones last."""
    at = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(column))
    return df.groupBy(column).agg(F.count_distinct("source_id").alias("sources")).withColumn(
        "position", F.when(at > 0, at).otherwise(F.lit(999)))


def verification_hits(df: DataFrame, families: list[dict]) -> DataFrame:
    """One row per record and verification family it matches (F19); the families are literal rules."""
    low = X.fold(F.concat_ws(" ", "title", "summary"))

    def rule(f: dict) -> Column:
        ok = F.lit(True)
        if f.get("source_ids"):
            ok = ok & F.col("source_id").isin(*f["source_ids"])
        if f.get("source_types"):
            ok = ok & F.col("source_type").isin(*f["source_types"])
        if f.get("terms"):
            hit = F.lit(False)
            for t in f["terms"]:
                hit = hit | F.contains(F.col("_low"), F.lit(t.lower()))
            ok = ok & hit
        return F.when(ok, F.lit(f["id"]))
    return explode_rows(df.withColumn("_low", low), "family", F.array_compact(F.array(*[rule(f) for f in families]))).drop("_low")


def verification_coverage(df: DataFrame, families: list[dict], previous: DataFrame, samples: int = 8) -> DataFrame:
    """Records, sources, new records and newest samples per family; silent families are gaps."""
    hits = verification_hits(df, families).select("family", "id", "source_id", "published_at")
    fresh = H.new_ids(hits, previous, ["family", "id"]).groupBy("family").agg(F.count("*").alias("new_record_count"))
    counts = hits.groupBy("family").agg(F.count("*").alias("record_count"), F.count_distinct("source_id").alias("source_count"))
    newest = R.top_per_group(hits, ["family"], [F.desc("published_at"), F.desc("id")], samples).groupBy("family").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rn", "id"))), lambda x: x["id"]).alias("sample_ids"))
    every = df.sparkSession.createDataFrame([(f["id"],) for f in families], "family string")
    out = every.join(counts, "family", "left").join(fresh, "family", "left").join(newest, "family", "left")
    out = out.fillna(0, ["record_count", "source_count", "new_record_count"])
    return out.withColumn("status", F.when(F.col("record_count") > 0, "active").otherwise("gap"))


def project_catalog(evidence: DataFrame, reviewed: DataFrame, as_of: str) -> DataFrame:
    """Reviewed and discovered projects with review priority (M3: J6, J7, A18).

    reviewed: name, official_url, opportunity_score. Discovered ones are repositories no reviewed
    project matched.
    """
    e = evidence.select("id", "source_id", "source_type", "title", "url", "projects", "theme_ids", "ts")
    reviewed = cut_lineage(reviewed, "reviewed")   # read here and by the match
    pairs = cut_lineage(V.match_projects(reviewed, e), "project-pairs")   # read twice below
    themes = pairs.join(e.select("id", "source_id", "theme_ids", "ts"), "id").groupBy("name").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("theme_ids")))).alias("theme_ids"),
        F.collect_set("source_id").alias("source_ids"), F.count("*").alias("related_count"), F.max("ts").alias("ts"))
    empty = F.array().cast("array<string>")
    done = reviewed.join(themes, "name", "left").select(
        "name", F.lit("reviewed").alias("review_status"), F.coalesce("theme_ids", empty).alias("theme_ids"),
        (F.size(F.coalesce("source_ids", empty)) > 0).alias("cross_source"), F.coalesce("related_count", F.lit(0)).alias("related_count"),
        "ts", F.col("opportunity_score").alias("review_priority"), S.opportunity_action(F.col("opportunity_score")).alias("action"))
    repos = V.related_repositories(e, pairs)
    found = repos.join(e.select("id", "theme_ids", "ts"), "id").withColumn("cross_source", F.size("source_ids") > 1)
    one = R.first_per_group(found, ["project_name"], [F.desc("ts"), F.col("id")])
    found = one.select(
        F.col("project_name").alias("name"), F.lit("discovered").alias("review_status"), "theme_ids", "cross_source", "related_count", "ts",
        S.review_priority(F.size("theme_ids"), F.col("cross_source"), F.col("ts"), as_of).alias("review_priority"), F.lit("Discovered").alias("action"))
    return done.unionByName(found)


def review_queue(projects: DataFrame, per_signature: int = 3, total: int = 25) -> DataFrame:
    """Projects with the queued ones marked."""
    projects = cut_lineage(projects, "projects")   # read three times below
    order = [F.desc("review_priority"), F.desc_nulls_last("ts"), F.col("name")]
    open_ones = projects.filter((F.col("review_status") != "reviewed") & (F.size("theme_ids") > 0)).withColumn(
        "signature", F.array_join("theme_ids", ","))
    queue = R.signature_queue(open_ones, "signature", order, per_signature, total).select("name", "queue_rank")
    out = projects.join(queue, "name", "left")
    queued = F.col("queue_rank").isNotNull() & (F.col("review_status") != "reviewed")
    return (out.withColumn("review_status", F.when(queued, "queued").otherwise(F.col("review_status")))
            .withColumn("action", F.when(queued, "Review next").otherwise(F.col("action"))))


def engineering_concepts(projects: DataFrame, k: int = 8) -> DataFrame:
    """Projects, reviewed, queued and leading names per theme."""
    rows = projects.withColumn("theme_id", F.explode("theme_ids"))
    state = F.when(F.col("review_status") == "reviewed", 0).when(F.col("review_status") == "queued", 1).otherwise(2)
    n = rows.groupBy("theme_id").agg(
        F.count("*").alias("project_count"), F.count_if(F.col("review_status") == "reviewed").alias("reviewed_project_count"),
        F.count_if(F.col("review_status") == "queued").alias("queued_project_count"))
    names = R.top_per_group(rows, ["theme_id"], [state, F.desc_nulls_last("review_priority"), F.col("name")], k).groupBy("theme_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rn", "name"))), lambda x: x["name"]).alias("project_names"))
    return n.join(names, "theme_id", "left")


def early_signals(evidence: DataFrame, directions: list[dict], as_of: str) -> DataFrame:
    """Direction mart (M5): stage, previous stage, breadth, movement, origin and citations per direction.

    evidence: id, source_id, publisher_id, channel, title, summary, theme_ids, published_at, ts.
    """
    from signalloom.session import small_table
    spark = evidence.sparkSession
    rows = V.qualify(evidence, directions).withColumn("family", L.family(F.col("channel")))
    rows = rows.select("direction_id", "id", "source_id", "publisher_id", "family", "published_at", "ts")
    weeks = list(range(8))
    keys = small_table(spark, [(d["id"], d["title"]) for d in directions], "direction_id string, title string")
    hist = L.history(L.snapshots(rows, "direction_id", as_of, weeks), keys, "direction_id", weeks)
    now = hist.filter("weeks_ago = 0").drop("weeks_ago")
    trail = hist.groupBy("direction_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(
        (-F.col("weeks_ago")).alias("w"), "stage"))), lambda x: x["stage"]).alias("lifecycle"))
    move = L.signal_movement(rows, now, "direction_id", as_of).drop("stage")
    cited = L.citations(rows, "direction_id", as_of).groupBy("direction_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pick", "id"))), lambda x: x["id"]).alias("evidence_ids"))
    out = keys.join(now, "direction_id").join(trail, "direction_id").join(move, "direction_id", "left").join(cited, "direction_id", "left")
    return out.withColumn("movement", F.coalesce("movement", F.when(F.col("stage") == "fading", "fading").otherwise("steady")))


def event_pulse(evidence: DataFrame, sources: DataFrame, events: DataFrame, as_of: str) -> DataFrame:
    """Event mart (M4)."""
    rows = P.linked(evidence, sources)
    return P.dossiers(rows, events, P.checkpoints(rows, events, as_of))


def dashboard(evidence: DataFrame, themes: DataFrame, as_of: str, latest: int = 250) -> tuple[DataFrame, DataFrame]:
    """Theme scores with all themes kept, and the newest evidence."""
    rows = K.by_theme(evidence).withColumn("month", D.month_key(F.col("published_at")))
    scored = S.item_theme_scores(rows, as_of)
    cards = themes.join(scored, themes["id"] == scored["theme_id"], "left").drop("theme_id").fillna({"item_count": 0})
    return cards, evidence.orderBy(F.desc("published_at"), F.desc("id")).limit(latest)


def research(evidence: DataFrame, themes: DataFrame, sources: DataFrame, layers: dict[str, list[str]], as_of: str, projects: DataFrame | None = None) -> dict[str, DataFrame]:
    """The research mart as tables (M2): evidence, themes (unobserved ones too), sources, weekly movement, verdicts,
    and, given the project catalog (M3), the projects with their review queue and the engineering concepts of themes."""
    rows = normalized_evidence(evidence, sources, layers)
    dim = sources.select(F.col("id").alias("source_id"), F.col("publisher_id").alias("_publisher"))
    by_theme = K.by_theme(evidence).join(dim, "source_id", "left").withColumn("publisher_id", F.coalesce("_publisher", F.col("source_id")))
    by_theme = by_theme.withColumn("support", F.lit(1)).withColumn("month", D.month_key(F.col("published_at")))
    queued = None if projects is None else cut_lineage(review_queue(projects), "research-projects")
    return ({} if queued is None else {"projects": queued, "concepts": engineering_concepts(queued)}) | {
        "evidence": rows,
        "themes": S.with_unobserved(themes, S.cross_source_scores(by_theme, as_of)),
        "sources": S.source_freshness(rows, sources, as_of),
        "weekly": L.weekly_movement(by_theme, as_of),
        "verdicts": evidence.groupBy("disposition", "rule_id").agg(F.count("*").alias("evidence_count")),
    }


def live_section(evidence: DataFrame, source_id: str, k: int = 8) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts with first and last date, the leading themes and the newest records of one source (M8)."""
    mine = evidence.filter(F.col("source_id") == source_id)
    head = mine.agg(F.count("*").alias("record_count"), F.count_if(F.size("theme_ids") > 0).alias("classified_record_count"),
                    F.min("published_at").alias("first_observed_at"), F.max("published_at").alias("last_observed_at"))
    lead = K.by_theme(mine).groupBy("theme_id").agg(F.count("*").alias("evidence_count")).orderBy(F.desc("evidence_count"), "theme_id").limit(k)
    newest = mine.orderBy(F.desc("published_at"), F.desc("id")).limit(k)
    return head, lead, newest


def candidate_pool(candidates: DataFrame, links: DataFrame, evidence: DataFrame, previous: DataFrame, adjudications: DataFrame, as_of: str) -> DataFrame:
    """Candidates with metrics, priority, change reasons and adjudication (M6: A16, A17, X5, X6, J9).

    candidates: id, origin, title, stage, strength, movement, linked; links: candidate_id, id.
    """
    from signalloom.functions import constants as C
    m = S.candidate_metrics(links, evidence, as_of, C.TECHNICAL_SOURCE_TYPES)
    out = candidates.join(m.withColumnRenamed("candidate_id", "id"), "id", "left").fillna(
        0, ["evidence_count", "source_count", "recent_evidence_count", "technical_record_count"])
    families = F.size(F.coalesce("source_types", F.array().cast("array<string>")))
    points = S.lookup(C.MOVEMENT_POINTS, F.col("movement"), 8)
    out = out.withColumn("priority", S.priority(points, F.col("source_count"), families, F.col("technical_record_count"),
                                               F.col("recent_evidence_count"), F.col("linked")))
    out = out.withColumn("recent_count", F.col("recent_evidence_count"))
    p = previous.select(F.col("id").alias("p_id"), *[F.col(c).alias(f"p_{c}") for c in (
        "stage", "strength", "movement", "evidence_count", "source_count", "recent_count")])
    r = adjudications.select(F.col("candidate_id").alias("r_id"), F.col("stage").alias("r_stage"),
                             F.col("evidence_count").alias("r_evidence_count"), F.col("source_count").alias("r_source_count"))
    out = out.join(p, out["id"] == p["p_id"], "left").join(r, out["id"] == r["r_id"], "left")
    out = out.withColumn("change_reasons", H.material_reasons()).withColumn("adjudication", H.adjudication_status())
    return out.drop(*p.columns, *r.columns)
