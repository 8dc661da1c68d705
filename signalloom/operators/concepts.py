"""Concept mining: controlled terms, recurring phrases, entities, actions, relations."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from signalloom.functions import constants as C, text as X
from signalloom.functions.arrays import once
from signalloom.session import cut_lineage


@dataclass
class ConceptPolicy:
    """Parameters of the extraction. The maxima cut what one record may hold; without them nothing is cut."""

    lexicon: list[dict] = field(default_factory=list)            # id, label, kind, aliases
    actions: dict[str, list[str]] = field(default_factory=dict)
    minimum_df: int = 2
    maximum_fraction: float = 0.35
    maximum_phrases: int | None = None
    minimum_score: float = 1.15
    title_weight: float = 1.5
    generic_tokens: list[str] = field(default_factory=list)
    blocked_phrases: list[str] = field(default_factory=list)
    blocked_tags: list[str] = field(default_factory=list)
    minimum_tag_length: int = 3
    maximum_entities: int | None = None
    maximum_relations: int | None = None
    maximum_terms: int | None = None


def plain(text: str) -> str:
    """normalized_text for rule values on the driver."""
    import re
    value = re.sub(r"\s+", " ", text).strip().lower().replace("ß", "ss").replace("-", " ").replace("/", " ")
    return " ".join(re.findall(C.TOKEN_PATTERN, value))


def lexicon(themes: list[dict], primitives: list[dict]) -> list[dict]:
    """Themes (name, aliases, terms) and primitives as one list, aliases longest first."""
    def ordered(values) -> list[str]:
        return sorted(set(values), key=lambda v: (-len(v), v))
    return (
        [{"id": f"theme:{t['id']}", "label": t["name"], "kind": "theme",
          "aliases": ordered([t["name"], *t.get("aliases", []), *t.get("terms", [])])} for t in themes]
        + [{"id": f"primitive:{p['id']}", "label": p["label"], "kind": "primitive", "aliases": ordered(p["aliases"])}
           for p in primitives]
    )


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def vocabulary_hits(tokens: Column, phrases: list[str]) -> Column:
    """The distinct phrases of a vocabulary in a token list, in one pass whose cost does not grow with the vocabulary.

    A token that begins no phrase is passed over by one hash lookup; at the others the grams of the lengths there are
    get looked up. `tokens` must be a column of the frame: it is read inside the lambda.
    """
    phrases = sorted({p for p in phrases if p})
    if not phrases:
        return _strings([])
    begin, sizes = sorted({p.split(" ")[0] for p in phrases}), sorted({p.count(" ") + 1 for p in phrases})
    known = lambda c, values: c.isin(*values, *[f"\0{i}" for i in range(11)])  # noqa: E731 - long enough a list to be hashed
    at = F.filter(F.transform(tokens, lambda t, i: F.when(known(t, begin), i)), lambda i: i.isNotNull())
    grams = F.flatten(F.transform(at, lambda i: F.array(*[F.array_join(F.slice(tokens, i + 1, F.lit(n)), " ") for n in sizes])))
    return F.array_distinct(F.filter(grams, lambda g: known(g, phrases)))


def _first(items: Column, most: int | None) -> Column:
    return items if most is None else F.slice(items, 1, most)


def _found(aliases: list[str], hits: Column, most: int | None) -> Column:
    """Aliases among the phrases found in a record, in the given order."""
    named = [F.when(F.array_contains(hits, plain(a)), F.lit(a)) for a in aliases if plain(a)]
    return _first(F.array_compact(F.array(*named)) if named else _strings([]), most)


def controlled(hits: Column, entries: list[dict], most: int | None = None) -> Column:
    """Lexicon entries among the phrases found in a record (T4)."""
    items = [F.struct(F.lit(e["id"]).alias("id"), F.lit(e["label"]).alias("label"), F.lit(e["kind"]).alias("kind"),
                      _found(e["aliases"], hits, most).alias("matched_terms")) for e in entries]
    return F.filter(F.array(*items), lambda e: F.size(e["matched_terms"]) > 0)


def action_hits(hits: Column, actions: dict[str, list[str]], most: int | None = None) -> Column:
    items = [F.struct(F.lit(a).alias("id"), F.lit(a.replace("-", " ").title()).alias("label"),
                      _found(forms, hits, most).alias("matched_terms")) for a, forms in actions.items()]
    return F.filter(F.array(*items), lambda e: F.size(e["matched_terms"]) > 0)


def entities(policy: ConceptPolicy) -> Column:
    """Projects and tags as entities, the last of equal ids, ordered by kind and label."""
    def item(prefix: str, kind: str):
        return lambda v: F.struct(F.concat(F.lit(prefix), X.slug(v)).alias("id"), v.alias("label"),
                                  F.lit(kind).alias("kind"), F.array(v).alias("matched_terms"))
    projects = F.filter(F.transform("projects", X.compact), lambda v: v != "")
    tags = F.filter(F.transform("tags", X.compact), lambda v: (F.length(v) >= policy.minimum_tag_length)
                    & ~X.fold(v).isin(*(policy.blocked_tags or [""])) & ~v.rlike(r"(?i)^(?:cs|stat)\.[a-z]+$"))
    every = F.concat(F.transform(projects, item("project:", "project")),
                     F.transform(tags, item("technology:", "technology")))
    last = F.filter(every, lambda x, i: ~F.exists(
        F.slice(every, i + 2, F.greatest(F.size(every), F.lit(1))), lambda y: y["id"] == x["id"]))
    keyed = F.array_sort(F.transform(last, lambda x: F.struct(x["kind"].alias("k"), X.fold(x["label"]).alias("l"), x.alias("x"))))
    return _first(F.transform(keyed, lambda s: s["x"]), policy.maximum_entities)


def prepared(items: DataFrame, policy: ConceptPolicy) -> DataFrame:
    """Add searchable text, tokens and the per-record lists that need no other record."""
    sep = X.searchable(F.col("title"), F.col("summary"), F.array_join("tags", " "), F.array_join("projects", " "))
    base = items.withColumn("search", X.compact(sep))
    base = base.withColumn("tokens", X.normalized_tokens(F.col("search")))
    phrases = [plain(a) for e in policy.lexicon for a in e["aliases"]] + [plain(f) for forms in policy.actions.values() for f in forms]
    base = base.withColumn("_hits", vocabulary_hits(F.col("tokens"), phrases))
    return (base.withColumn("title_tokens", F.size(X.normalized_tokens(F.col("title"))))
            .withColumn("controlled", controlled(F.col("_hits"), policy.lexicon, policy.maximum_terms))
            .withColumn("entities", entities(policy))
            .withColumn("actions", action_hits(F.col("_hits"), policy.actions, policy.maximum_terms)).drop("_hits"))


def phrase_counts(base: DataFrame, policy: ConceptPolicy, records_a_task: int = 2048) -> DataFrame:
    """(id, phrase, size, tf, in_title) of all admissible 2-4 token phrases (T5).

    Token columns shifted by zip give one row per position, so everything after the explode is plain
    compiled column code. Token lists are partitioned by record first: that partitioning also serves
    the count, so counting moves token lists once and no phrases. The tasks grow in number with the
    records, so what one of them counts at once does not.
    """
    tasks = max(base.sparkSession.sparkContext.defaultParallelism, -(-base.count() // records_a_task))
    digits = lambda t: t.rlike("^[0-9]+$")
    good = F.transform("tokens", lambda t: F.when(~(t.isin(*C.STOPWORDS) | ((F.length(t) < 3) & ~digits(t))), t))
    # what a phrase may not consist of alone: digits (1), generic tokens (2)
    weak = F.transform("tokens", lambda t: F.when(digits(t), 1).otherwise(0)
                       + F.when(t.isin(*policy.generic_tokens) if policy.generic_tokens else F.lit(False), 2).otherwise(0))
    rows = once(base.select("id", "title_tokens", "tokens").repartition(tasks, "id"), good=good, weak=weak)
    n = F.greatest(F.size("tokens"), F.lit(1))
    shifted = [F.slice(c, F.lit(k), n).alias(f"{c[0]}{k}") for c in ("good", "weak") for k in (1, 2, 3, 4)]
    rows = once(rows, z=F.arrays_zip(*shifted)).select("id", "title_tokens", F.posexplode("z"))
    rows = rows.select("id", "title_tokens", "pos", "col.*").filter(F.col("g1").isNotNull() & F.col("g2").isNotNull())

    def one(k: int) -> Column:   # null as soon as one token is, or if all are weak in one way
        parts = [x for i in range(1, k + 1) for x in (F.lit(" "), F.col(f"g{i}"))][1:]
        alone = reduce(lambda x, y: x.bitwiseAND(y), [F.col(f"w{i}") for i in range(1, k + 1)])
        return F.struct(F.lit(k).alias("size"), F.when(alone == 0, F.concat(*parts)).alias("phrase"))
    grams = rows.select("id", "title_tokens", "pos", F.explode(F.array(one(2), one(3), one(4))).alias("g")).select("id", "title_tokens", "pos", "g.*")
    grams = grams.filter(F.col("phrase").isNotNull())
    if policy.blocked_phrases:
        grams = grams.filter(~F.col("phrase").isin(*[plain(p) for p in policy.blocked_phrases]))
    return grams.groupBy("id", "phrase", "size").agg(
        F.count("*").alias("tf"), F.max(F.col("pos") + F.col("size") <= F.col("title_tokens")).alias("in_title"))


def document_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("phrase").agg(F.count("*").alias("df"))


def scored_phrases(counts: DataFrame, n_documents: int, policy: ConceptPolicy) -> DataFrame:
    """Phrases within the frequency bounds, with their score (T6, first half).

    The bounds drop the many phrases of a single record before the join.
    """
    ceiling = max(policy.minimum_df, int(n_documents * policy.maximum_fraction))
    counts = cut_lineage(counts, "phrases")   # read twice below
    aliases = sorted({plain(a) for e in policy.lexicon for a in e["aliases"]} - {""})
    df = document_frequency(counts).filter(F.col("df").between(policy.minimum_df, ceiling))
    if aliases:
        df = df.filter(~F.col("phrase").isin(*aliases))
    n = max(1, n_documents)
    score = ((1 + F.log("tf")) * (F.log((1 + n) / (1 + F.col("df"))) + 1) * (1 + 0.12 * (F.col("size") - 2))
             * F.when(F.col("in_title"), policy.title_weight).otherwise(1.0))
    return counts.join(df, "phrase").withColumn("score", score).filter(F.col("score") >= policy.minimum_score)


def picked_phrases(scored: DataFrame, policy: ConceptPolicy) -> DataFrame:
    """Greedy choice per record: best first, none inside another chosen one."""
    listed = scored.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("s"), (-F.col("size")).alias("z"), "phrase", "df"))).alias("all"))
    clash = "exists(acc, e -> contains(concat(' ', e.phrase, ' '), concat(' ', x.phrase, ' ')) " \
            "or contains(concat(' ', x.phrase, ' '), concat(' ', e.phrase, ' ')))"
    full = "" if policy.maximum_phrases is None else f"size(acc) >= {policy.maximum_phrases} or "
    picked = F.expr(
        f"aggregate(all, slice(all, 1, 0), (acc, x) -> if({full}{clash}, "
        "acc, concat(acc, array(x))))")
    return listed.select("id", picked.alias("picked"))


def phrase_items() -> Column:
    return F.transform("picked", lambda p: F.struct(
        F.concat(F.lit("phrase:"), X.slug(p["phrase"])).alias("id"), p["phrase"].alias("label"),
        F.lit("emergent-phrase").alias("kind"), F.array(p["phrase"]).alias("matched_terms")))


def relations(base: DataFrame, policy: ConceptPolicy) -> DataFrame:
    """Subject, action, object of one sentence (T9): the nearest node before and after the action,
    else the first two nodes; distinct triples in text order.

    Nodes per record are few (lexicon hits and entities), sentences are exploded.
    """
    def listed(items: Column) -> Column:
        return F.transform(items, lambda n, i: F.named_struct(
            F.lit("ord"), i, F.lit("id"), n["id"], F.lit("terms"), F.filter(F.transform(
                n["matched_terms"], lambda t: X.padded(X.normalized_text(t))), lambda t: t != "  ")))

    def placed(items: Column) -> Column:
        """Those of the items that stand in the sentence, by place; one at its very start counts as absent (X.phrase_position)."""
        def at(x: Column) -> Column:
            spots = F.filter(F.transform(x["terms"], lambda t: F.instr(F.col("sent"), t) - 2), lambda p: p >= 0)
            return F.named_struct(F.lit("pos"), F.array_min(spots), F.lit("ord"), x["ord"], F.lit("id"), x["id"])
        return F.array_sort(F.filter(F.transform(items, at), lambda x: x["pos"].isNotNull()))

    rows = base.filter((F.size("actions") > 0) & (F.size("controlled") + F.size("entities") > 1))
    rows = once(rows.select("id", "search", "controlled", "entities", "actions"), nodes=listed(F.concat("controlled", "entities")), acts=listed(F.col("actions")),
                sents=F.transform(F.split("search", C.SENTENCE_PATTERN), lambda x: X.padded(X.normalized_text(x))))
    rows = rows.select("id", "nodes", "acts", F.posexplode("sents").alias("sno", "sent")).filter("sent <> '  '")
    rows = once(rows, found=placed(F.col("acts"))).filter("size(found) > 0")
    rows = once(rows, present=placed(F.col("nodes"))).filter("size(present) > 1")
    hits = rows.select("id", "sno", "present", F.explode("found").alias("act"))
    before = F.filter("present", lambda p: p["pos"] < F.col("act.pos"))
    after = F.filter("present", lambda p: p["pos"] > F.col("act.pos"))
    hits = hits.withColumn("b", before).withColumn("a", after)
    inside = (F.size("b") > 0) & (F.size("a") > 0)
    subject = F.when(inside, F.try_element_at("b", F.lit(-1))).otherwise(F.get("present", F.lit(0)))
    target = F.when(inside, F.get("a", F.lit(0))).otherwise(F.get("present", F.lit(1)))
    triples = hits.select("id", "sno", F.col("act.ord").alias("ord"), F.col("act.id").alias("predicate"),
                          subject["id"].alias("subject_id"), target["id"].alias("object_id"))
    triples = (triples.filter("subject_id <> object_id").groupBy("id", "subject_id", "predicate", "object_id")
               .agg(F.min(F.struct("sno", "ord")).alias("at")))
    listed = _first(F.array_sort(F.collect_list(F.struct("at", "subject_id", "predicate", "object_id"))), policy.maximum_relations)
    return triples.groupBy("id").agg(listed.alias("l")).select("id", F.transform("l", lambda t: F.struct(
        t["subject_id"].alias("subject_id"), t["predicate"].alias("predicate"), t["object_id"].alias("object_id"),
        F.lit("same-sentence-co-mention").alias("basis"))).alias("relationships"))


NODE = "array<struct<id:string,label:string,kind:string,matched_terms:array<string>>>"
RELATION = "array<struct<subject_id:string,predicate:string,object_id:string,basis:string>>"


def concept_documents(items: DataFrame, policy: ConceptPolicy, n_documents: int | None = None) -> DataFrame:
    """One row per record with concepts, entities, actions and relationships."""
    n = items.count() if n_documents is None else n_documents
    base = cut_lineage(prepared(items, policy), "tokens")   # read three times below
    phrases = picked_phrases(scored_phrases(phrase_counts(base, policy), n, policy), policy)
    rel = relations(base, policy)
    out = (base.drop("tokens", "search", "title_tokens").join(phrases.select("id", phrase_items().alias("phrases")), "id", "left")
           .join(rel, "id", "left"))
    both = F.concat(F.col("controlled").cast(NODE), F.coalesce(F.col("phrases").cast(NODE), F.array().cast(NODE)))
    ordered = F.transform(F.array_sort(F.transform(both, lambda x: F.struct(
        x["kind"].alias("k"), X.fold(x["label"]).alias("l"), x.alias("x")))), lambda s: s["x"])
    return out.select(
        F.col("id").alias("evidence_id"), "source_id", "source_type", "published_at",
        F.array_sort("theme_ids").alias("theme_ids"), ordered.alias("concepts"), F.col("entities").cast(NODE).alias("entities"),
        "actions", F.coalesce(F.col("relationships").cast(RELATION), F.array().cast(RELATION)).alias("relationships"))


def document_signature() -> Column:
    """Content hash of a concept document without corpus-level numbers."""
    return F.sha2(F.to_json(F.struct("theme_ids", "concepts", "entities", "actions", "relationships"),
                            {"ignoreNullFields": "false"}), 256)


def concept_index(docs: DataFrame, approximate: bool = False) -> DataFrame:
    """Documents and sources per concept or entity."""
    rows = docs.select("evidence_id", "source_id", F.explode(F.concat("concepts", "entities")).alias("c"))
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return rows.groupBy("c.id").agg(
        F.max("c.label").alias("label"), F.max("c.kind").alias("kind"),
        distinct("evidence_id").alias("document_count"), distinct("source_id").alias("source_count"))


def relationship_index(docs: DataFrame) -> DataFrame:
    """Documents per relation triple."""
    return (docs.select(F.explode("relationships").alias("r"))
            .groupBy("r.subject_id", "r.predicate", "r.object_id").agg(F.count("*").alias("document_count")))


def catalog_changes(docs: DataFrame, fingerprints: DataFrame, previous: DataFrame) -> DataFrame:
    """Change per document against the previous catalog.

    `previous`: id, fingerprint, signature. A document changed when its fingerprint or its signature did.
    """
    now = docs.select(F.col("evidence_id").alias("id"), document_signature().alias("signature")).join(
        fingerprints.select("id", "fingerprint"), "id")
    p = previous.select("id", F.col("fingerprint").alias("_f"), F.col("signature").alias("_s"))
    kind = (F.when(F.col("signature").isNull(), "removed").when(F.col("_s").isNull(), "added")
            .when((F.col("fingerprint") != F.col("_f")) | (F.col("signature") != F.col("_s")), "changed")
            .otherwise("unchanged"))
    return now.join(p, "id", "full_outer").select("id", kind.alias("change"), "fingerprint", "signature")


def vocabulary_gaps(classified: DataFrame, policy: ConceptPolicy, k: int | None = None) -> DataFrame:
    """Phrases of the records waiting for review with their frequency (T12): all, or the k most frequent."""
    waiting = classified.filter(F.col("disposition") == "classification-review")
    counts = phrase_counts(prepared(waiting, policy), policy)
    found = document_frequency(counts)
    return found if k is None else found.orderBy(F.desc("df"), "phrase").limit(k)
