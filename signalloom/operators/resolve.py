"""Linking evidence to events and projects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signalloom.functions import constants as C, dates as D, text as X
from signalloom.functions.arrays import explode_rows
from signalloom.session import cut_lineage


def _event_structs(events: list[dict]) -> Column:
    """The event rules as one literal array: no join is needed to test them."""
    def one(e: dict) -> Column:
        last = max(e.get("review_windows_days") or [90])
        aliases = [a.lower().replace("ß", "ss") for a in e.get("aliases", []) if len(a) >= 6]
        return F.struct(
            F.lit(e["id"]).alias("id"),
            F.lit(e.get("start_date")).cast("timestamp").alias("start"),
            F.lit(e.get("end_date")).cast("timestamp").alias("finish"),
            F.lit((e.get("official_url") or "").split("#", 1)[0].rstrip("/")).alias("url"),
            F.array(*[F.lit(a) for a in aliases]).cast("array<string>").alias("aliases"),
            F.array(*[F.lit(s) for s in e.get("source_ids", [])]).cast("array<string>").alias("source_ids"),
            F.lit(last).alias("last"))
    return F.array(*[one(e) for e in events])


def attach_events(df: DataFrame, events: list[dict]) -> DataFrame:
    """First pass: source list, official URL, or an alias inside the event's date range.

    `df` needs id, source_id, title, summary, tags, url, ts and may carry event_ids.
    """
    hay, url = F.col("_hay"), F.col("_url")

    def fits(e: Column) -> Column:
        window = F.col("ts").between(e["start"] - F.make_dt_interval(F.lit(45)),
                                     e["finish"] + F.make_dt_interval(e["last"]))
        named = F.exists(e["aliases"], lambda a: F.contains(hay, a))
        return (F.array_contains(e["source_ids"], F.col("source_id")) | ((url != "") & (url == e["url"]))
                | (F.coalesce(window, F.lit(False)) & named))

    given = F.col("event_ids") if "event_ids" in df.columns else F.array().cast("array<string>")
    ids = F.transform(F.filter(_event_structs(events), fits), lambda e: e["id"])
    return (
        df.withColumn("_hay", X.fold(X.searchable(F.col("title"), F.col("summary"), F.array_join("tags", " "))))
        .withColumn("_url", X.canonical_url(F.col("url")))
        .withColumn("event_ids", F.array_sort(F.array_distinct(F.concat(given, ids)))).drop("_hay", "_url")
    )


def _anchor_keys(for_anchor: bool) -> Column:
    """Keys a record offers as an anchor, or looks anchors up with."""
    url = X.canonical_url(F.col("url"))
    urls = F.array(url)
    if for_anchor:
        urls = F.concat(urls, F.transform("artifact_urls", X.canonical_url))
    projects = F.transform("projects", X.folded_title)
    title = X.folded_title(F.col("title"))
    long = F.length(title) >= 6
    if for_anchor:
        long = long & F.col("source_type").isin(*C.ARTIFACT_TYPES)
    return F.array_distinct(F.array_compact(F.concat(
        F.transform(F.filter(urls, lambda u: u != ""), lambda u: F.concat(F.lit("u:"), u)),
        F.transform(F.filter(projects, lambda p: p != ""), lambda p: F.concat(F.lit("p:"), p)),
        F.array(F.when(long, F.concat(F.lit("t:"), F.md5(title)))))))


def attach_by_artifact(df: DataFrame, events: list[dict]) -> DataFrame:
    """Second and last pass: records sharing a URL, project or title with an event record.

    Anchors are reduced to one row per key before the join, so a popular project joins to a single
    row with the list of its events. The first pass is written once, as a few narrow columns.
    """
    windows = F.array(*[F.struct(
        F.lit(e["id"]).alias("id"), F.lit(e["start_date"]).cast("timestamp").alias("lo"),
        (F.lit(e["end_date"]).cast("timestamp") + F.make_dt_interval(
            F.lit(max(e.get("review_windows_days") or [90])))).alias("hi")) for e in events])
    first = cut_lineage(df.select("id", "ts", "event_ids", "url", "artifact_urls", "projects", "title", "source_type"), "first-pass")
    anchors = (first.filter(F.size("event_ids") > 0)
               .select(F.explode(_anchor_keys(True)).alias("key"), F.explode("event_ids").alias("event_id"))
               .groupBy("key").agg(F.collect_set("event_id").alias("events")))
    probes = first.filter(F.col("ts").isNotNull()).select("id", "ts", F.explode(_anchor_keys(False)).alias("key"))
    hits = (probes.join(anchors, "key")
            .select("id", F.filter("events", lambda e: F.exists(
                windows, lambda w: (w["id"] == e) & F.col("ts").between(w["lo"], w["hi"]))).alias("found"))
            .filter(F.size("found") > 0)
            .groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set("found"))).alias("found")))
    return (df.drop("event_ids").join(first.select("id", "event_ids"), "id").join(hits, "id", "left")
            .withColumn("event_ids", F.array_sort(F.array_union(
                "event_ids", F.coalesce("found", F.array().cast("array<string>"))))).drop("found"))


def echo_key(df_columns: list[str] | None = None) -> Column:
    """Key under which repeated reports of one thing collapse."""
    art = F.get(F.filter(F.transform("artifact_urls", X.canonical_url), lambda u: u != ""), F.lit(0))
    url = X.canonical_url(F.col("url"))
    by_title = F.concat(F.lit("title:"), X.slug(F.col("title")))
    return (F.when(art.isNotNull(), F.concat(F.lit("url:"), art))
            .when(F.col("source_type").isin(*C.ECHO_TITLE_TYPES), by_title)
            .when(url != "", F.concat(F.lit("url:"), url)).otherwise(by_title))


def match_projects(projects: DataFrame, evidence: DataFrame, piece: int = 6) -> DataFrame:
    """(name, id) pairs: equal URL, or the name a substring of the title or the joined project list.

    A substring has no hash key, but a text that holds a name holds all of the name's pieces of `piece`
    characters. Narrow (id, piece) rows are thinned to pieces that names have; each name then meets the
    records at its rarest piece, and only the texts of those records are fetched for the exact test.
    Names and their pieces are written first: with their size known, rows are thinned before they are shuffled.
    """
    name = X.fold(F.col("name"))
    p = projects.select("name", name.alias("_name"), X.canonical_url(F.col("official_url")).alias("_official"))
    p = cut_lineage(p.filter("_name <> ''"), "project-names")   # read four times below
    text = X.fold(F.concat_ws("\n", F.col("title"), F.array_join("projects", " ")))
    e = evidence.select("id", X.canonical_url(F.col("url")).alias("_url"), text.alias("_text"))
    by_url = p.filter(F.col("_official") != "").join(
        e.filter(F.col("_url") != ""), F.col("_official") == F.col("_url")).select("name", "id")

    def pieces(c: Column, n: Column) -> Column:
        last = F.length(c) - (n - 1)
        starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(c, i, n))

    size = F.least(F.length("_name"), F.lit(piece))
    of_names = p.select("_name", F.explode(F.array_distinct(pieces(F.col("_name"), size))).alias("_piece")).distinct()
    of_names = cut_lineage(of_names, "name-pieces")
    lengths = [r[0] for r in of_names.select(F.length("_piece")).distinct().collect()]   # at most `piece` numbers
    # long texts are cut into overlapping blocks, so that a row never holds all pieces of one
    block = 4096
    begins = F.sequence(F.lit(1), F.greatest(F.length("_text"), F.lit(1)), F.lit(block))
    cut = F.transform(begins, lambda at: F.substring(F.col("_text"), at, F.lit(block + piece - 1)))
    blocks = explode_rows(e.select("id", "_text"), "_block", cut).select("id", "_block")
    every = [F.regexp_extract_all("_block", F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in lengths]   # at each place the next n characters
    every = F.concat(*every) if every else F.array().cast("array<string>")
    held = explode_rows(blocks, "_piece", every).select("id", "_piece").join(of_names.select("_piece"), "_piece", "left_semi").distinct()
    held = cut_lineage(held, "pieces")
    often = held.groupBy("_piece").agg(F.count("*").alias("n"))
    rarest = of_names.join(often, "_piece", "left").groupBy("_name").agg(F.min_by("_piece", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "_piece")).alias("_piece"))
    met = held.join(rarest, "_piece").select("id", "_name")
    by_name = met.join(e.select("id", "_text"), "id").filter(F.contains("_text", F.col("_name"))).select("id", "_name").distinct()
    by_name = by_name.join(p.select("name", "_name"), "_name").select("name", "id")
    return by_url.unionByName(by_name).distinct()


def related_repositories(evidence: DataFrame, matched: DataFrame) -> DataFrame:
    """Unmatched repositories with the sources that share their id, URL or project name.

    The three keys are joined as grouped lists of sources, one row per key, never record by record.
    """
    repos = (evidence.filter(F.col("source_type").isin("repository", "hackathon-project"))
             .join(matched.select("id").distinct(), "id", "left_anti")
             .withColumn("project_name", F.coalesce(F.get("projects", F.lit(0)), F.col("title")))
             .withColumn("_url", X.canonical_url(F.col("url"))))
    by_url = evidence.withColumn("_url", X.canonical_url(F.col("url"))).filter(F.col("_url") != "").groupBy("_url").agg(
        F.collect_set("source_id").alias("s1"), F.count("*").alias("n_url"))
    by_name = evidence.select("id", "source_id", F.explode(F.array_distinct("projects")).alias("project_name"))
    names = by_name.groupBy("project_name").agg(F.collect_set("source_id").alias("s2"), F.count("*").alias("n_name"))
    both = (evidence.select("id", "source_id", X.canonical_url(F.col("url")).alias("_url"),
                            F.explode(F.array_distinct("projects")).alias("project_name"))
            .filter(F.col("_url") != "").groupBy("_url", "project_name").agg(F.count("*").alias("n_both")))
    empty = F.array().cast("array<string>")
    out = (repos.join(by_url, "_url", "left").join(names, "project_name", "left")
           .join(both, ["_url", "project_name"], "left"))
    sources = F.array_sort(F.array_union(F.array("source_id"), F.array_union(F.coalesce("s1", empty), F.coalesce("s2", empty))))
    n_own = F.when(F.col("_url") == "", F.when(F.array_contains("projects", F.col("project_name")), 0).otherwise(1)).otherwise(0)
    n = F.coalesce("n_url", F.lit(0)) + F.coalesce("n_name", F.lit(0)) - F.coalesce("n_both", F.lit(0)) + n_own
    return out.select("id", "project_name", sources.alias("source_ids"), n.alias("related_count"))


def qualify(df: DataFrame, directions: list[dict]) -> DataFrame:
    """One row per record and direction it supports (J13); the direction rules are literals, not a join."""
    def shared(d: dict) -> Column:
        overlap = F.size(F.array_intersect("theme_ids", F.array(*[F.lit(t) for t in d["theme_ids"]])))
        return overlap >= d.get("minimum_theme_overlap", 2)

    def rule(d: dict) -> Column:
        enough = shared(d)
        phrases = [p.lower() for p in d.get("match_phrases", [])]
        if phrases:
            hit = F.lit(False)
            for p in phrases:
                hit = hit | F.contains(F.col("_low"), F.lit(p))
            enough = enough & hit
        if d.get("curated_evidence_ids"):
            enough = enough | F.col("id").isin(*d["curated_evidence_ids"])
        return F.when(enough, F.lit(d["id"]))
    # only a text whose themes fit a direction with phrases is folded
    read = F.lit(False)
    for d in directions:
        if d.get("match_phrases"):
            read = read | shared(d)
    low = df.withColumn("_low", F.when(read, X.fold(F.concat_ws(" ", "title", "summary"))))
    return explode_rows(low, "direction_id", F.array_compact(F.array(*[rule(d) for d in directions]))).drop("_low")


def rewrite_sources(df: DataFrame, moved: dict[str, str], source_types: list[str] | None = None) -> DataFrame:
    """Source ids of an older registry under their present names (N28), only on rows of the given source types."""
    if not moved:
        return df
    pairs = F.create_map(*[F.lit(x) for kv in moved.items() for x in kv])
    now = F.coalesce(F.try_element_at(pairs, F.col("source_id")), F.col("source_id"))
    if source_types is not None:
        now = F.when(F.col("source_type").isin(*source_types), now).otherwise(F.col("source_id"))
    return df.withColumn("source_id", now)
