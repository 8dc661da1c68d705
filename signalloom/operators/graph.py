"""Anchors, overlap edges, components and cluster selection."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import combinations
from math import comb

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from signalloom.functions import constants as C, text as X
from signalloom.operators.dedup import greedy_dropped, source_rank
from signalloom.operators.ranking import contribution_caps, top_per_group
from signalloom.session import cut_lineage, small_table


@dataclass
class ClusterPolicy:
    """Parameters of the clustering; the defaults are the reference values, but all clusters of any size are kept.

    The reference keeps components of at most 80 documents and the best 500 clusters; a caller may pass these.
    """

    allowed_kinds: list[str] = field(default_factory=lambda: ["primitive", "emergent-phrase", "project", "technology"])
    structural_kinds: list[str] = field(default_factory=lambda: ["primitive", "relationship"])
    entity_kinds: list[str] = field(default_factory=lambda: ["project", "technology"])
    feature_kinds: list[str] = field(default_factory=lambda: ["primitive", "emergent-phrase", "theme"])
    blocked_phrases: list[str] = field(default_factory=list)
    minimum_documents: int = 2
    minimum_sources: int = 2
    maximum_fraction: float = 0.10
    shared_documents: int = 2
    jaccard: float = 0.50
    containment: float = 0.75
    maximum_cluster_documents: int | None = None
    maximum_clusters: int | None = None
    maximum_anchors: int = 8
    maximum_themes: int = 6
    recurrent_theme_documents: int = 2


def phrase_key(col: Column) -> Column:
    return F.replace(X.folded_title(col), F.lit("-"), F.lit(" "))


def anchor_postings(docs: DataFrame, policy: ClusterPolicy) -> DataFrame:
    """(anchor_id, label, kind, evidence_id, source_id) of allowed anchors (G1)."""
    blocked = [" ".join(p.lower().replace("-", " ").split()) for p in policy.blocked_phrases] or [""]
    nodes = docs.select("evidence_id", "source_id", F.explode(F.concat("concepts", "entities")).alias("c"))
    nodes = nodes.select(F.col("c.id").alias("anchor_id"), F.col("c.label").alias("label"), F.col("c.kind").alias("kind"),
                         "evidence_id", "source_id").filter(F.col("kind").isin(*policy.allowed_kinds))
    key = phrase_key(F.col("label"))
    usable = (F.col("kind") != "emergent-phrase") | ((key != "") & ~key.isin(*blocked) & ~key.rlike("[0-9]"))
    r = docs.select("evidence_id", "source_id", F.explode("relationships").alias("r"))
    triple = ["r.subject_id", "r.predicate", "r.object_id"]
    rel = r.select(F.concat(F.lit("relation:"), F.concat_ws("|", *triple)).alias("anchor_id"),
                   F.concat_ws(" ", *triple).alias("label"), F.lit("relationship").alias("kind"), "evidence_id", "source_id")
    return nodes.filter(usable).unionByName(rel).dropDuplicates(["anchor_id", "evidence_id"])


def anchors(postings: DataFrame, n_documents: int, policy: ClusterPolicy) -> DataFrame:
    """Anchors within the document and source bounds (G2); counts only, no document lists."""
    ceiling = max(10, int(n_documents * policy.maximum_fraction))
    return (postings.groupBy("anchor_id").agg(
        F.min("label").alias("label"), F.min("kind").alias("kind"), F.count("*").alias("document_count"),
        F.count_distinct("source_id").alias("source_count"))
        .filter(F.col("document_count").between(policy.minimum_documents, ceiling)
                & (F.col("source_count") >= policy.minimum_sources)))


def overlap_edges(kept: DataFrame, index: DataFrame, policy: ClusterPolicy) -> DataFrame:
    """Anchor pairs sharing enough documents.

    Pairs are formed inside one document, whose anchors the extraction limits to a few dozen; the
    documents of an anchor are never paired.
    """
    per_doc = kept.groupBy("evidence_id").agg(F.array_sort(F.collect_set("anchor_id")).alias("a"))
    left = per_doc.select("a", F.posexplode("a").alias("i", "left_id"))
    pairs = left.select("left_id", F.explode(F.slice("a", F.col("i") + 2, F.size("a"))).alias("right_id"))
    shared = pairs.groupBy("left_id", "right_id").agg(F.count("*").alias("shared")).filter(
        F.col("shared") >= policy.shared_documents)
    n = index.select("anchor_id", "document_count")
    e = (shared.join(n.select(F.col("anchor_id").alias("left_id"), F.col("document_count").alias("nl")), "left_id")
         .join(n.select(F.col("anchor_id").alias("right_id"), F.col("document_count").alias("nr")), "right_id"))
    jaccard = F.col("shared") / (F.col("nl") + F.col("nr") - F.col("shared"))
    containment = F.col("shared") / F.least("nl", "nr")
    return (e.withColumn("jaccard", jaccard).withColumn("containment", containment)
            .filter((jaccard >= policy.jaccard) | (containment >= policy.containment))
            .select("left_id", "right_id", "shared", "jaccard", "containment"))


def local_forest(pairs: DataFrame) -> DataFrame:
    """(a, b) edges of the same components as those of `pairs`: each partition's edges contracted to a forest.

    A vertex hangs from the least vertex its partition ties it to, so a partition gives one edge per vertex it holds
    but for its roots, however many edges it had. A task keeps the vertices of its partition.
    """
    fields = to_arrow_schema(pairs.select("a", "b").schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def top(x):
            root = x
            while (up := parent.setdefault(root, root)) != root:
                root = up
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = top(x), top(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        rows = [(x, top(x)) for x in list(parent)]
        rows = [r for r in rows if r[0] != r[1]]
        for at in range(0, len(rows), 100_000):
            part = rows[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], type=fields.field(k).type) for k in (0, 1)], schema=fields)

    return pairs.select("a", "b").mapInArrow(run, pairs.select("a", "b").schema)


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): smallest id of each connected component.

    Each partition's edges are contracted to a forest first. Then alternating large-star and small-star steps: each
    hangs neighbours onto the smallest known one, so long chains shrink in logarithmically many rounds. A hub only
    meets a one-row minimum per join. Every step is written out, so lineage does not grow.
    """
    def kept(df: DataFrame) -> tuple[DataFrame, tuple]:
        out = cut_lineage(df, "cc")
        return out, tuple(out.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    pairs = edges.select(F.greatest("left_id", "right_id").alias("a"), F.least("left_id", "right_id").alias("b"))
    pairs, seen = kept(local_forest(pairs.filter("a <> b")).distinct())
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = cut_lineage(large, "cc")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low, "a")
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(hung.select("a", F.col("m").alias("b")))
        pairs, now = kept(small.filter("a <> b").distinct())
        if now == seen:
            break
        seen = now
    roots = pairs.groupBy("a").agg(F.min("b").alias("component"))
    return vertices.join(roots, vertices["id"] == roots["a"], "left").select(
        vertices["id"], F.coalesce("component", vertices["id"]).alias("component"))


def component_members(components: DataFrame, kept: DataFrame) -> DataFrame:
    """(component, evidence_id) of all documents that hold an anchor of the component."""
    return kept.join(components.withColumnRenamed("id", "anchor_id"), "anchor_id").select("component", "evidence_id").distinct()


def overbroad_components(components: DataFrame, kept: DataFrame, policy: ClusterPolicy) -> DataFrame:
    """(component, raw_count, reason) of the components `cluster_documents` leaves out (G5); none without a bound."""
    bound = policy.maximum_cluster_documents
    sizes = component_members(components, kept).groupBy("component").agg(F.count("*").alias("raw_count"))
    over = sizes.filter(F.lit(False) if bound is None else F.col("raw_count") > bound)
    return over.withColumn("reason", F.lit(f"over-broad:{bound}"))


def cluster_documents(components: DataFrame, kept: DataFrame, docs: DataFrame, sources: DataFrame,
                      policy: ClusterPolicy) -> tuple[DataFrame, DataFrame]:
    """Documents of every component that is not over-broad, and the capped ones.

    Where the policy sets a bound, components with more documents are left out by a count before anything
    else looks at their rows; `overbroad_components` lists them.
    """
    member = component_members(components, kept)
    sizes = member.groupBy("component").agg(F.count("*").alias("raw_count"))
    bound = policy.maximum_cluster_documents
    fine = member.join(sizes if bound is None else sizes.filter(F.col("raw_count") <= bound), "component")
    dim = sources.select(F.col("id").alias("source_id"), "channel", "publisher_id")
    rows = (fine.join(docs.select("evidence_id", "source_id", "source_type", "published_at"), "evidence_id")
            .join(dim, "source_id", "left").withColumn("publisher_id", F.coalesce("publisher_id", F.col("source_id"))))
    day = F.to_date(F.try_to_timestamp("published_at"))
    order = [source_rank(F.coalesce("channel", F.lit("")), C.PREFERRED_CHANNELS), day.desc_nulls_last(), F.col("evidence_id")]
    capped = contribution_caps(rows, ["component"], "source_id", "publisher_id", order)
    enough = capped.groupBy("component").agg(F.count("*").alias("n"), F.count_distinct("source_id").alias("s")).filter(
        (F.col("n") >= policy.minimum_documents) & (F.col("s") >= policy.minimum_sources))
    return rows, capped.join(enough.select("component"), "component", "left_semi")


def context_features(capped: DataFrame, docs: DataFrame, components: DataFrame, policy: ClusterPolicy) -> DataFrame:
    """(component, evidence_id, source_id, feature): themes, actions and concepts that are not anchors."""
    d = docs.select("evidence_id", F.concat(
        F.transform("theme_ids", lambda t: F.struct(F.concat(F.lit("theme:"), t).alias("f"), F.lit("").alias("c"))),
        F.transform("actions", lambda a: F.struct(F.concat(F.lit("action:"), a["id"]).alias("f"), F.lit("").alias("c"))),
        F.transform(F.filter(F.concat("concepts", "entities"), lambda c: c["kind"].isin(*policy.feature_kinds)),
                    lambda c: F.struct(F.concat(F.lit("concept:"), c["id"]).alias("f"), c["id"].alias("c")))).alias("fs"))
    rows = capped.select("component", "evidence_id", "source_id").join(d, "evidence_id").select(
        "component", "evidence_id", "source_id", F.inline("fs"))
    own = components.select("component", F.col("id").alias("c"))
    return rows.join(own, ["component", "c"], "left_anti").select(
        "component", "evidence_id", "source_id", F.col("f").alias("feature")).distinct()


def coherent_core(capped: DataFrame, features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Largest cross-source group of a cluster's documents tied by recurring features.

    Documents of one feature are tied to its smallest document instead of to each other; the groups
    are the components of those ties, computed for all clusters at once.
    Returns (core documents, feature summary of at most twelve per cluster).
    """
    key = F.concat_ws("\u0001", "component", "evidence_id")
    recurring = features.groupBy("component", "feature").agg(
        F.count("*").alias("n"), F.min("evidence_id").alias("least")).filter("n >= 2")
    tied = features.join(recurring, ["component", "feature"])
    edges = tied.select(key.alias("left_id"), F.concat_ws("\u0001", "component", "least").alias("right_id"))
    nodes = capped.select(key.alias("id"), "component", "evidence_id", "source_id")
    groups = connected_components(nodes.select("id"), edges).withColumnRenamed("component", "part")
    parts = nodes.join(groups, "id")
    sized = parts.groupBy("component", "part").agg(
        F.count("*").alias("n"), F.count_distinct("source_id").alias("s"), F.min("evidence_id").alias("first"))
    best = top_per_group(sized.filter("n >= 2 and s >= 2"), ["component"], [F.desc("s"), F.desc("n"), F.col("first")], 1)
    core = parts.join(best.select("component", "part"), ["component", "part"], "left_semi").select(
        "component", "evidence_id", "source_id")
    summary = features.join(core.select("component", "evidence_id"), ["component", "evidence_id"], "left_semi").groupBy(
        "component", "feature").agg(F.count("*").alias("document_count")).filter("document_count >= 2")
    return core, top_per_group(summary, ["component"], [F.desc("document_count"), F.col("feature")], 12)


def cluster_id(anchor_ids: Column) -> Column:
    """Readable id with a hash of the sorted anchors."""
    first = F.get(anchor_ids, F.lit(0))
    tail = F.when(F.contains(first, F.lit(":")), F.regexp_replace(first, "^[^:]*:", "")).otherwise(first)
    name = F.substring(X.slug(tail), 1, 42)
    digest = F.substring(F.sha2(F.array_join(anchor_ids, "|"), 256), 1, 10)
    return F.concat(F.lit("discovery:"), F.when(name != "", name).otherwise(F.lit("pattern")), F.lit("-"), digest)


def opening_subsets(spark: SparkSession, most: int = 16) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Which positions of an opening are looked up together.

    Two sets that share `need` members share k of the first n - need + k of each, in one order of all members. k is as
    large as leaves a set at most `most` subsets of k: all of small sets, one of those that may differ in many members.
    Returns (p, k, at) with the subsets of k of p positions, k > 1, and k by the members a set may have on its own.
    """
    sizes = {own: max(k for k in range(2, most) if comb(own + k, k) <= most) for own in range(1, most) if comb(own + 2, 2) <= most}
    rows = {(p, k): [list(c) for c in combinations(range(p), k)]
            for own, top in sizes.items() for k in range(2, top + 1) for p in range(k, k + own + 1)}
    shapes = small_table(spark, [(p, k, at) for (p, k), all_at in rows.items() for at in all_at], "p int, k int, at array<int>")

    def together(own: Column) -> Column:
        out = F.lit(1)
        for d, k in sizes.items():
            out = F.when(own == d, k).otherwise(out)
        return out
    return shapes, together


def opening_pairs(sets: DataFrame, jaccard: float) -> DataFrame:
    """(id, other) of the distinct sets of (id, evidence_ids) that may reach the bound: all that do, few that don't."""
    df = sets.select(F.explode("evidence_ids").alias("e")).groupBy("e").agg(F.count("*").alias("df"))
    tokens = sets.select("id", F.explode("evidence_ids").alias("e")).join(df, "e")
    ordered = tokens.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "e"))).alias("t"))
    ordered = ordered.select("id", F.transform("t", lambda x: x["e"]).alias("t"), F.size("t").alias("n"))
    need = lambda a, b: F.ceil((a + b) * (jaccard / (1 + jaccard)) - 1e-9).cast("int")
    shapes, together = opening_subsets(sets.sparkSession)

    def keyed(small_side: bool) -> DataFrame:
        """Subsets of the opening of each set for every size of its partner that can still reach the bound."""
        n = F.col("n")
        other = (F.sequence(n, F.greatest(n, F.floor(n / jaccard + 1e-9).cast("int"))) if small_side
                 else F.sequence(F.ceil(n * jaccard - 1e-9).cast("int"), n))
        rows = ordered.select("id", "t", "n", F.explode(other).alias("o"))
        low, high = (F.col("n"), F.col("o")) if small_side else (F.col("o"), F.col("n"))
        rows = rows.filter((low != high) | (need(low, high) < low))   # equal sets are gone already
        rows = rows.withColumn("k", F.least(need(low, high), together(high - need(low, high))))
        rows = rows.select("id", "t", "k", low.alias("low"), high.alias("high"), (n - need(low, high) + F.col("k")).alias("p"))
        hashed = lambda items: F.xxhash64("low", "high", items)
        ones = rows.filter("k = 1").select("id", "low", "high", F.explode(F.slice("t", F.lit(1), F.col("p"))).alias("e")).select("id", hashed(F.col("e")).alias("key"))
        more = rows.filter("k > 1").join(shapes, ["p", "k"]).select("id", hashed(F.transform("at", lambda i: F.get("t", i))).alias("key"))
        return ones.unionByName(more)

    return keyed(True).join(keyed(False).withColumnRenamed("id", "other"), "key").filter("id <> other").select(
        F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other")).distinct()


def distinct_clusters(clusters: DataFrame, order: list[Column], jaccard: float = 0.80, limit: int | None = None) -> DataFrame:
    """Drop clusters too similar to a better one, best first (G9); a `limit` keeps the best of the rest.

    Equal document sets collapse first. Other similar pairs must share k of the rarest documents of both sets
    (prefix filter for the Jaccard bound), and they meet by these k together: one shared document, even the
    rarest of small sets, would pair all sets around it. Decisions then run in rounds over those few pairs.
    `order`: columns compared ascending (negate the numbers that count downwards).
    """
    sets = clusters.withColumn("_set", F.sha2(F.array_join("evidence_ids", "\u0001"), 256))
    sets = top_per_group(sets, ["_set"], order, 1).drop("rn", "_set")
    sets = cut_lineage(sets.withColumn("_rank", F.struct(*[
        c.alias(f"r{i}") for i, c in enumerate(order)])), "sets")
    found = opening_pairs(sets, jaccard)
    info = sets.select("id", "_rank", "evidence_ids")
    pairs = (found.join(info, "id").join(info.select(
        F.col("id").alias("other"), F.col("_rank").alias("o_rank"), F.col("evidence_ids").alias("o_ids")), "other")
        .filter(F.size(F.array_intersect("evidence_ids", "o_ids")) / F.size(F.array_union("evidence_ids", "o_ids")) >= jaccard))
    first = F.col("o_rank") < F.col("_rank")
    pairs = pairs.select(F.when(first, F.col("id")).otherwise(F.col("other")).alias("id"),
                         F.when(first, F.col("other")).otherwise(F.col("id")).alias("better"))
    dropped = greedy_dropped(pairs)
    if dropped is not None:
        sets = sets.join(dropped, "id", "left_anti")
    sets = sets.drop("_rank").orderBy(*order)
    return sets if limit is None else sets.limit(limit)

