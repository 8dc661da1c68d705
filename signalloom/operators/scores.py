"""Theme, corpus, project and coverage scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from signalloom.functions import dates as D
from signalloom.session import cut_lineage


def clamp(col: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(col, F.lit(low)), F.lit(high))


def item_theme_scores(df: DataFrame, as_of: str) -> DataFrame:
    """Per theme: recurrence, acceleration, persistence, breadth and their total (A1).

    `df`: theme_id, ts, month (year and month of the stamp), source_type.
    """
    age = D.age_in_days(F.col("ts"), as_of)
    s = df.groupBy("theme_id").agg(
        F.count("*").alias("item_count"),
        F.count_if(age.between(0, 30)).alias("recent"), F.count_if(age.between(31, 60)).alias("prior"),
        F.count_distinct(F.when(F.col("month") != "", F.col("month"))).alias("months"),
        F.count_distinct("source_type").alias("types"))
    boost = F.when(F.col("recent") > 0, 8.0).otherwise(0.0)
    parts = s.select(
        "theme_id", "item_count",
        F.least(F.lit(25.0), F.col("item_count") * 2.5).alias("recurrence"),
        clamp((F.col("recent") - F.col("prior")) * 4.0 + boost, 0.0, 25.0).alias("acceleration"),
        F.least(F.lit(25.0), F.col("months") * 5.0).alias("persistence"),
        F.least(F.lit(25.0), F.col("types") * 5.0).alias("breadth"))
    total = F.col("recurrence") + F.col("acceleration") + F.col("persistence") + F.col("breadth")
    return parts.withColumn("total", F.bround(total, 1))


def cross_source_scores(rows: DataFrame, as_of: str, theme: str = "theme_id", publisher: str = "publisher_id") -> DataFrame:
    """Cross-source theme assessment (A2-A5).

    `rows`: theme, publisher, support, month. Support of a publisher counts logarithmically, so one
    loud publisher cannot carry a theme. Two aggregations: (theme, publisher), then theme; the first
    combines on the map side, so a theme with a third of all rows shuffles only its groups.
    """
    months = D.last_months(as_of)
    per_pub = rows.groupBy(theme, publisher).agg(
        F.sum("support").alias("support"), F.count("*").alias("observations"),
        *[F.sum(F.when(F.col("month") == m, F.col("support")).otherwise(0)).alias(f"m{i}") for i, m in enumerate(months)])
    t = per_pub.groupBy(theme).agg(
        F.sum("support").alias("support_units"), F.sum("observations").alias("evidence_count"),
        F.count("*").alias("source_count"), F.sum(F.log1p("support")).alias("effective"),
        F.max("support").alias("dominant"), *[F.sum(f"m{i}").alias(f"m{i}") for i in range(6)])
    t = cut_lineage(t, "theme-sums")  # read for the maximum and for the scores
    top = t.agg(F.max("effective")).scalar()
    prior = (F.col("m2") + F.col("m3")) / 2
    recent = (F.col("m4") + F.col("m5")) / 2
    active = sum((F.when(F.col(f"m{i}") > 0, 1).otherwise(0) for i in range(6)), F.lit(0))
    out = t.select(
        theme, "evidence_count", "support_units", "source_count",
        F.bround(F.lit(25) * F.col("effective") / top, 1).alias("recurrence"),
        F.bround(clamp(12.5 + 10 * F.log2((recent + 1) / (prior + 1)), 0, 25), 1).alias("acceleration"),
        F.bround(25 * active / 6, 1).alias("persistence"),
        F.least(F.lit(25.0), F.col("source_count") * 5.0).alias("breadth"),
        F.bround(F.col("dominant") / F.col("support_units"), 2).alias("concentration"),
        F.map_from_arrays(F.array(*[F.lit(m) for m in months]), F.array(*[f"m{i}" for i in range(6)]))
        .alias("monthly_counts"))
    total = F.bround(F.col("recurrence") + F.col("acceleration") + F.col("persistence") + F.col("breadth"), 1)
    return out.withColumn("total", total).withColumn("maturity", maturity())


def maturity() -> Column:
    """Theme maturity from support, publishers, concentration and total (A4)."""
    return (F.when(F.coalesce("support_units", F.lit(0)) == 0, "unobserved")
            .when(F.col("source_count") == 1, "source-specific")
            .when(F.col("source_count") == 2, "emerging")
            .when(F.col("concentration") >= 0.75, "corroborated-source-concentrated")
            .when((F.col("source_count") >= 4) & (F.col("total") >= 70), "broadly-corroborated")
            .otherwise("corroborated"))


def with_unobserved(themes: DataFrame, scores: DataFrame) -> DataFrame:
    """Every theme; without support the score stays null and the maturity is unobserved."""
    joined = themes.join(scores, themes["id"] == scores["theme_id"], "left").drop("theme_id")
    return (joined.withColumn("maturity", F.coalesce("maturity", F.lit("unobserved")))
            .fillna({"evidence_count": 0, "support_units": 0, "source_count": 0}))


def source_breakdown(rows: DataFrame) -> DataFrame:
    """Observations, support and sources per theme and publisher (A3)."""
    return rows.groupBy("theme_id", "publisher_id").agg(
        F.count("*").alias("observations"), F.sum("support").alias("support_units"),
        F.array_sort(F.collect_set("source_id")).alias("source_ids"))


def month_spine(rows: DataFrame, themes: DataFrame, as_of: str) -> DataFrame:
    """Counts per theme and month with zeros for silent months."""
    spine = themes.select(F.col("id").alias("theme_id"), F.explode(F.array(*[F.lit(m) for m in D.last_months(as_of)]))
                          .alias("month"))
    counts = rows.groupBy("theme_id", "month").agg(F.sum("support").alias("n"))
    return spine.join(counts, ["theme_id", "month"], "left").fillna({"n": 0})


def theme_summary(df: DataFrame) -> DataFrame:
    """Evidence and sources per theme of a set of records."""
    return df.groupBy("theme_id").agg(
        F.count("*").alias("evidence_count"), F.count_distinct("source_id").alias("source_count"),
        F.array_sort(F.collect_set("source_id")).alias("source_ids"))


def source_freshness(df: DataFrame, sources: DataFrame, as_of: str) -> DataFrame:
    """Count, last date and freshness of every configured source."""
    seen = df.groupBy("source_id").agg(F.count("*").alias("n"), F.max("ts").alias("latest"))
    out = sources.join(seen, sources["id"] == seen["source_id"], "left").drop("source_id").fillna({"n": 0})
    age = F.greatest(F.lit(0), D.age_in_days(F.col("latest"), as_of))
    return (out.withColumn("status", F.when(F.col("n") > 0, "active").otherwise("configured"))
            .withColumn("freshness", F.when(F.col("latest").isNull(), "configured").when(age <= 30, "recent")
                        .when(age <= 90, "aging").otherwise("historical")))


def coverage(df: DataFrame) -> DataFrame:
    """Counts by disposition and rule, and both coverage ratios, in one grouping-sets pass (A10)."""
    sets = df.groupingSets([["disposition"], ["disposition", "rule_id"], []], "disposition", "rule_id").agg(
        F.count("*").alias("records"), F.count_if(F.col("disposition") == "classified").alias("_c"),
        F.count_if(F.col("disposition") == "classification-review").alias("_r"),
        F.grouping_id().alias("level"))
    total = F.col("level") == 3
    return sets.select(
        F.when(F.col("level") == 3, "total").when(F.col("level") == 1, "disposition").otherwise("rule").alias("level"),
        F.coalesce("disposition", F.lit("all")).alias("disposition"), F.coalesce("rule_id", F.lit("all")).alias("rule_id"),
        "records",
        F.when(total, F.bround(F.col("_c") / F.nullif(F.col("_c") + F.col("_r"), F.lit(0)), 3)).alias("in_scope_coverage"),
        F.when(total, F.bround(F.col("_c") / F.nullif(F.col("records"), F.lit(0)), 3)).alias("raw_coverage"))


def candidate_metrics(links: DataFrame, evidence: DataFrame, as_of: str, technical: list[str]) -> DataFrame:
    """Evidence behind each candidate, looked up by id; unknown ids fall out.

    `links`: candidate_id, id, one row per cited record.
    """
    hit = links.join(evidence.select("id", "source_id", "source_type", "ts"), "id")
    return hit.groupBy("candidate_id").agg(
        F.count("*").alias("evidence_count"), F.count_distinct("source_id").alias("source_count"),
        F.array_sort(F.collect_set("source_type")).alias("source_types"),
        F.count_if(D.in_trailing(F.col("ts"), as_of, 7)).alias("recent_evidence_count"),
        F.count_if(F.col("source_type").isin(*technical)).alias("technical_record_count"))


def lookup(table: dict, key: Column, default) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def priority(movement_points: Column, sources: Column, families: Column, technical: Column, recent: Column,
             linked: Column) -> Column:
    """Analyst attention score."""
    return (movement_points + F.least(F.lit(25), sources * 3 + families * 2) + F.least(F.lit(20), technical * 3)
            + F.least(F.lit(20), recent * 4) + F.when(linked, 10).otherwise(0))


def review_priority(theme_count: Column, cross_source: Column, ts: Column, as_of: str) -> Column:
    """Order of unreviewed projects (A18); a missing date counts as very old."""
    age = F.coalesce(D.age_in_days(ts, as_of), F.lit(9999))
    points = F.lit(20) * theme_count + F.when(cross_source, 25).otherwise(0)
    return F.least(F.lit(100), points + F.when(age <= 30, 20).when(age <= 90, 10).otherwise(0))


def half_up(col: Column) -> Column:
    return F.floor(col + 0.5)


def corpus_trends(df: DataFrame, trends: dict[str, str], months: list[str]) -> DataFrame:
    """Corpus trend scores over six months.

    `df`: statement, month, entity, sponsored. Mentions and lead entities scale logarithmically
    against the largest trend; sponsored rows do not count.
    """
    flags = F.array_compact(F.array(*[F.when(F.col("statement").rlike(f"(?i){p}"), F.lit(n)) for n, p in trends.items()]))
    hit = df.filter(~F.col("sponsored")).select("month", "entity", F.explode(flags).alias("name"))
    s = hit.groupBy("name").agg(
        F.count("*").alias("mentions"), F.count_distinct("entity").alias("breadth_count"),
        *[F.count_if(F.col("month") == m).alias(f"m{i}") for i, m in enumerate(months)])
    s = cut_lineage(s, "trend-sums")
    most = lambda c: s.agg(F.max(c)).scalar()
    early = sum((F.col(f"m{i}") for i in range(4)), F.lit(0)) / 4
    recent = (F.col("m4") + F.col("m5")) / 2
    active = sum((F.when(F.col(f"m{i}") > 0, 1).otherwise(0) for i in range(6)), F.lit(0))
    out = s.select(
        "name", "mentions", "breadth_count",
        half_up(25 * F.log1p("mentions") / F.log1p(most("mentions"))).alias("recurrence"),
        half_up(clamp(12.5 + 10 * F.log2((recent + 1) / (early + 1)), 0, 25)).alias("acceleration"),
        half_up(25 * active / 6).alias("persistence"),
        half_up(25 * F.log1p("breadth_count") / F.log1p(most("breadth_count"))).alias("breadth"))
    total = F.col("recurrence") + F.col("acceleration") + F.col("persistence") + F.col("breadth")
    return out.withColumn("total", total).withColumn("tier", F.when(total >= 80, "Structural").when(total >= 65, "Strong")
                                                     .when(total >= 50, "Emerging").otherwise("Niche / uncertain"))


OPPORTUNITY_WEIGHTS = [25, 15, 20, 15, 15, 10]


def opportunity(ratings: Column) -> Column:
    """Weighted score of six ratings from 1 to 5."""
    weights = F.array(*[F.lit(float(w)) for w in OPPORTUNITY_WEIGHTS])
    return half_up(F.aggregate(F.zip_with(ratings, weights, lambda r, w: r * w / 5), F.lit(0.0), lambda a, x: a + x))


def opportunity_action(score: Column) -> Column:
    return (F.when(score >= 85, "Test now").when(score >= 75, "Pilot / watch").when(score >= 65, "Selective")
            .otherwise("Research only"))


def newest_receipts(receipts: DataFrame) -> DataFrame:
    """Newest receipt of each family by directory name."""
    return receipts.groupBy("family").agg(F.max_by(F.struct(*receipts.columns), "snapshot").alias("r")).select("r.*")


def receipt_states(latest: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """One row per family and collector; old receipts derive them from item counts and error lines.

    `latest`: family, collected_at, collectors (null in old receipts), errors. `counts`: family,
    source_id, n, the landed items of old receipts.
    """
    modern = (latest.filter(F.col("collectors").isNotNull() & (F.size("collectors") > 0))
              .select("family", "collected_at", F.explode("collectors").alias("c"))
              .select("family", "collected_at", "c.source_id", "c.status", "c.items", "c.error"))
    old = latest.filter(F.col("collectors").isNull() | (F.size("collectors") == 0))
    from signalloom.functions.text import without_source_prefix
    errs = old.select("family", F.explode("errors").alias("line")).select(
        "family", F.trim(F.substring_index("line", ":", 1)).alias("source_id"), without_source_prefix(F.col("line")).alias("error"))
    errs = errs.groupBy("family", "source_id").agg(F.max("error").alias("error"))
    if counts is None:
        return modern
    items = counts.join(old.select("family"), "family", "left_semi").select("family", "source_id", F.col("n").alias("items"))
    both = items.join(errs, ["family", "source_id"], "full_outer").join(old.select("family", "collected_at"), "family")
    derived = both.select(
        "family", "collected_at", "source_id",
        F.when(F.col("error").isNotNull(), "failed").otherwise("healthy").alias("status"),
        F.coalesce("items", F.lit(0)).cast("int").alias("items"), "error")
    return modern.select(*derived.columns).unionByName(derived)


def run_health(latest: DataFrame, states: DataFrame) -> DataFrame:
    """Degraded or healthy per run, with its failed sources."""
    s = states.groupBy("family").agg(
        F.count("*").alias("source_count"), F.count_if(F.col("status") == "failed").alias("failed_source_count"),
        F.array_sort(F.collect_list(F.when(F.col("status") == "failed", F.col("source_id")))).alias("failed_source_ids"))
    out = latest.select("family", "collected_at").join(s, "family", "left").fillna({"source_count": 0, "failed_source_count": 0})
    return out.withColumn("status", F.when(F.col("failed_source_count") > 0, "degraded").otherwise("healthy"))


def failed_sources(states: DataFrame) -> DataFrame:
    """(family, source_id, error), a row per failed source of a run: what `run_health` lists in one array, for any number of sources."""
    return states.filter("status = 'failed'").groupBy("family", "source_id").agg(F.max("error").alias("error"))


def source_health(states: DataFrame, sources: DataFrame, families: list[str]) -> DataFrame:
    """State of every source: the last family that names it wins; configured ones get a default."""
    order = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family"))
    last = states.groupBy("source_id").agg(F.max_by(F.struct("status", "collected_at", "items", "error", "family"), order).alias("s"))
    last = last.select("source_id", "s.*")
    conf = sources.select(F.col("id").alias("source_id"), "collection")
    both = conf.join(last, "source_id", "full_outer")
    default = F.when(F.col("collection").isNull() | (F.col("collection") == "manual"), "not-automated").otherwise("no-run-receipt")
    return both.select("source_id", F.coalesce("status", default).alias("status"), "collected_at",
                       F.coalesce("items", F.lit(0)).alias("items"), "error", F.col("family").alias("run_id"))


def audit_sample(df: DataFrame, size: int) -> DataFrame:
    """Stratified deterministic sample (A29): one record per source, the rest in proportion.

    The quota is a count per source; rows are ordered by a hash of their id and picked by a grouped
    top-k whose k is the largest quota.
    """
    n = df.groupBy("source_id").count().withColumnRenamed("count", "n")
    n = cut_lineage(n, "source-counts")
    rest = F.greatest(F.lit(0), F.lit(size) - n.agg(F.count("*")).scalar())
    quota = n.withColumn("quota", 1 + F.floor(rest * F.col("n") / n.agg(F.sum("n")).scalar()))
    most = quota.agg(F.max("quota")).first()[0] or 0
    from signalloom.operators.ranking import top_per_group
    ranked = top_per_group(df, ["source_id"], [F.sha2("id", 256), F.col("id")], int(most))
    return ranked.join(quota.select("source_id", "quota"), "source_id").filter("rn <= quota").drop("quota")


def water_fill(counts: DataFrame, group: list[str], stratum: str, quota: int) -> DataFrame:
    """(group, stratum, take): a quota per group dealt over strata of unequal size as evenly as they allow.

    counts: group, stratum, n, one row per stratum. Every stratum gives min(n, level), the level as high as the
    quota allows; what is left goes one each to the strata with more, in the order of a hash. Two passes: the
    histogram of sizes per group gives the level, the strata are then dealt with by themselves; only the leftovers,
    fewer than there are strata above the level, are ranked, by a top-k.
    """
    from signalloom.operators.ranking import top_per_group
    sizes = counts.groupBy(*group, "n").agg(F.count("*").alias("c"))
    up = Window.partitionBy(*group).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy(*group).orderBy("n").rowsBetween(0, Window.unboundedFollowing)
    step = sizes.select(*group, "n", F.coalesce(F.sum(F.col("n") * F.col("c")).over(up), F.lit(0)).alias("below"),
                        F.sum("c").over(rest).alias("strata"), F.coalesce(F.max("n").over(up), F.lit(0)).alias("floor"))
    # the level lies in the first step whose sizes, cut at their own height, exceed the quota; without one nothing is cut
    over = step.filter(F.col("below") + F.col("strata") * F.col("n") > quota)
    level = over.groupBy(*group).agg(F.min_by(F.struct(F.floor((quota - F.col("below")) / F.col("strata")).alias("level"), "below", "strata"), "n").alias("s"))
    level = level.select(*group, F.col("s.level").alias("level"), (F.lit(quota) - F.col("s.below") - F.col("s.strata") * F.col("s.level")).alias("left"))
    dealt = counts.join(level, group, "left").withColumn("take", F.least("n", F.coalesce("level", "n")))
    wants = top_per_group(dealt.filter((F.col("left") > 0) & (F.col("n") > F.col("level"))), group, [F.sha2(F.col(stratum).cast("string"), 256), F.col(stratum)], quota, "_turn")
    more = wants.filter(F.col("_turn") <= F.col("left")).select(*group, stratum, F.lit(1).alias("more"))
    return dealt.join(more, [*group, stratum], "left").select(*group, stratum, "n", (F.col("take") + F.coalesce("more", F.lit(0))).alias("take"))


def ranked_backlog(records: DataFrame, clusters: dict[str, list[str]], as_of: str, cap: int = 40, quota: int = 12) -> tuple[DataFrame, DataFrame]:
    """Vocabulary clusters of the waiting records in the order of inspection, and the records to inspect.

    records: id, publisher_id, family, hay (folded text), ts. Order: frequency capped at `cap`, publishers, families,
    records of the latest seven days, id; the cap keeps a loud cluster from outranking a broad one. Clusters overlap.
    The records of a cluster are dealt over its publishers by `water_fill`, the newest of each first.
    """
    from signalloom.operators.classify import theme_ids
    from signalloom.operators.ranking import top_per_group
    rows = records.select("id", "publisher_id", "family", "ts", F.explode(theme_ids(F.col("hay"), clusters)).alias("cluster_id"))
    parts = rows.groupBy("cluster_id", "publisher_id", "family").agg(F.count("*").alias("n"), F.count_if(D.in_trailing(F.col("ts"), as_of, 7)).alias("recent"))
    ranked = parts.groupBy("cluster_id").agg(F.sum("n").alias("observed_records"), F.count_distinct("publisher_id").alias("publisher_count"),
                                             F.count_distinct("family").alias("family_count"), F.sum("recent").alias("recent_records"))
    ranked = ranked.withColumn("capped_frequency", F.least("observed_records", F.lit(cap)))
    order = [F.desc(c) for c in ("capped_frequency", "publisher_count", "family_count", "recent_records")] + [F.col("cluster_id")]
    ranked = ranked.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # one row per cluster of the vocabulary
    take = water_fill(parts.groupBy("cluster_id", "publisher_id").agg(F.sum("n").alias("n")), ["cluster_id"], "publisher_id", quota)
    first = top_per_group(rows, ["cluster_id", "publisher_id"], [F.desc_nulls_last("ts"), F.col("id")], quota, "_pick")
    chosen = first.join(take.select("cluster_id", "publisher_id", "take"), ["cluster_id", "publisher_id"]).filter("_pick <= take")
    return ranked, chosen.select("cluster_id", "publisher_id", "id")
