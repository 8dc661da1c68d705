"""Tables that several queries share, written once per application and input folder.

The evidence table is written after classification because everything downstream reads it; mining and
clustering results are written because they come from iterative jobs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from signalloom.operators import classify as K, concepts as N, discover as G, graph, quality as Q
from signalloom.plans import demo
from signalloom.session import write_shared

_written: dict[tuple, tuple] = {}


def shared(name: str):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        def get(spark: SparkSession, sf_dir: str) -> DataFrame:
            demo.prepare(spark)
            key = (spark.sparkContext.applicationId, sf_dir, name)
            if key not in _written:
                df = build(spark, sf_dir)
                _written[key] = (write_shared(df, name), df.schema)
            path, schema = _written[key]
            return spark.read.schema(schema).parquet(path)
        return get
    return wrap


def with_verdict(rows: DataFrame) -> DataFrame:
    return K.classify(rows, demo.keyword_rules(), demo.RULES, demo.SCOPE_TERMS)


def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_verdict(demo.evidence(spark, sf_dir))


classified = shared("classified")(classify)


def classified_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified evidence for a reader of few columns: the written table if there is one, else the pass itself, whose
    texts are then not written."""
    written = (spark.sparkContext.applicationId, sf_dir, "classified") in _written
    return classified(spark, sf_dir) if written else classify(spark, sf_dir)


@shared("checked")
def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence that its source and date leave, with its eligibility reason; no text of other rows is read."""
    rows = Q.in_reach(demo.evidence(spark, sf_dir), demo.sources(spark), demo.AS_OF)
    return Q.eligibility(with_verdict(rows).drop("doc_id", "ts"), demo.sources(spark), demo.AS_OF)


@shared("eligible")
def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible evidence after the collapse of duplicate events."""
    ok = checked(spark, sf_dir).filter("reason is null")
    kept, _ = Q.duplicate_events(ok)
    return ok.join(kept.select("id"), "id", "left_semi")


PRIMITIVES = [
    {"id": "anea-boundary", "label": "Anea boundary", "aliases": ["thanea", "eriner thanea", "reedes"]},
    {"id": "ouaux-loop", "label": "Ouaux loop", "aliases": ["ouaux", "leou", "eauou"]},
    {"id": "enge-gate", "label": "Enge gate", "aliases": ["enbe", "enver", "ersch"]},
    {"id": "asci-plane", "label": "Asci plane", "aliases": ["asci", "laci", "queci"]},
    {"id": "thre-route", "label": "Thre route", "aliases": ["onatre", "thrent", "tionre"]},
]
ACTIONS = {
    "bind": ["thin", "thon", "tion"], "carry": ["aire", "ment", "elle"], "lift": ["heit", "keit", "lich"],
    "move": ["para", "mente"], "hold": ["erin", "anea", "ther"],
}


def concept_policy() -> N.ConceptPolicy:
    themes = [{"id": t[0], "name": t[1], "aliases": t[2], "terms": t[3]} for t in demo.THEMES]
    return N.ConceptPolicy(
        lexicon=N.lexicon(themes, PRIMITIVES), actions=ACTIONS, generic_tokens=["thth", "thre", "ouou"],
        blocked_phrases=["thth thre", "leou ouai"], blocked_tags=["en", "desk-src2"],
        maximum_phrases=8, maximum_entities=12, maximum_relations=12, maximum_terms=6)  # the bounds that the SQL of the queries states


@shared("concept-documents")
def concept_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.concept_documents(eligible(spark, sf_dir), concept_policy())


DIRECTIONS = [
    {"id": "dir-harbor", "title": "Harbor and bonding", "theme_ids": ["harbor", "bonding"], "match_phrases": ["thea", "ouea"],
     "match_anchor_ids": [], "minimum_theme_overlap": 1},
    {"id": "dir-lattice", "title": "Lattice links", "theme_ids": ["lattice", "bonding", "harbor"]},
    {"id": "dir-north", "title": "Northern forms", "theme_ids": ["quarry", "summit"]},
    {"id": "dir-south", "title": "Southern forms", "theme_ids": ["tidal", "meridian"], "minimum_theme_overlap": 1},
    {"id": "dir-quiet", "title": "Quiet direction", "theme_ids": ["unseen"], "minimum_theme_overlap": 1},
]


def theme_rules() -> list[dict]:
    return [{"id": t[0], "name": t[1], "aliases": t[2], "terms": t[3]} for t in demo.THEMES]


CLUSTERS = graph.ClusterPolicy()


@shared("postings")
def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.anchor_postings(concept_docs(spark, sf_dir), CLUSTERS)


@shared("anchors")
def anchor_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.anchors(postings(spark, sf_dir), concept_docs(spark, sf_dir).count(), CLUSTERS)


@shared("components")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = anchor_index(spark, sf_dir)
    kept = postings(spark, sf_dir).join(index.select("anchor_id"), "anchor_id", "left_semi")
    return graph.connected_components(index.select(F.col("anchor_id").alias("id")), graph.overlap_edges(kept, index, CLUSTERS))


@shared("catalog-changes")
def catalog_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T11 against a catalog a week old in which the labelled documents read otherwise."""
    docs = concept_docs(spark, sf_dir)
    now = eligible(spark, sf_dir).select("id", "fingerprint", "ts")
    lab = demo.table(spark, sf_dir, "labels").select(F.concat(F.lit("doc:"), "doc_id").alias("id")).distinct().withColumn("lab", F.lit(True))
    sig = docs.select(F.col("evidence_id").alias("id"), N.document_signature().alias("signature"))
    before = now.filter(F.col("ts") <= F.lit("2024-06-13T00:00:00Z").cast("timestamp")).join(lab, "id", "left").join(sig, "id")
    before = before.select("id", F.when(F.col("lab"), "other").otherwise(F.col("fingerprint")).alias("fingerprint"), "signature")
    return N.catalog_changes(docs, now, before)


@shared("clusters")
def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = concept_docs(spark, sf_dir)
    changed = catalog_changes(spark, sf_dir).filter(F.col("change").isin("added", "changed")).select("id")
    tables = postings(spark, sf_dir), anchor_index(spark, sf_dir), components(spark, sf_dir)
    return G.build_clusters(docs, demo.sources(spark), changed, DIRECTIONS, theme_rules(), CLUSTERS, docs.count(), tables)
