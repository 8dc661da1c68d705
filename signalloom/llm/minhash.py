"""Near-duplicate texts by ProbMinHash, banding and exact verification (operator 9).

Words are folded as in `words.py`; a text is a bag of five-word shingles weighted by how often they occur
(a text of fewer words is one shingle). Similarity is the probability Jaccard index of two bags, which is
the plain Jaccard index where no shingle repeats. A signature has `SIZE` components: every element sends
arrivals of a Poisson process whose rate is its weight to random components, each component keeps the
element that arrives first, and the process stops once later arrivals are later than all kept ones.

1. One scan makes a row per document: a 128-bit key of its words and `BANDS` band hashes. Equal keys are
   copies: they collapse to one text by a grouped minimum, so a group of copies costs one row. From here on
   the key stands for the text; ids come back at the end.
2. Band hashes meet in a grouped count. In each shared bucket the member that shares most overall (ties:
   largest key) is the pivot, and every member is compared with its pivots: at most one pair per row.
3. What a pivot has joined is a class. Buckets that still hold several classes among their other members
   are compared in whole: members are dealt to blocks, every pair of blocks is one small task, and only
   links that join two classes leave it. No bucket is capped, no pair of members is ever a row.

Texts are shuffled only for the members that are to be compared. Results are verified on the whole texts.
Free style (numpy in `mapInPandas`) because arrival processes have no column form.

Defined results: null texts count as empty; texts without words are copies only of equal texts; null ids are
in no class; of an id with several texts every text is compared and has its class, the report gives the one
of its smallest `copy_of`, and `keep_first` decides for each row by its own text; an empty table gives an empty table; extra columns are ignored here and kept by `keep_first`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from signalloom.llm.words import U, folded_words, mix, window_hashes, word_hashes
from signalloom.operators.graph import connected_components
from signalloom.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4  # a pair of similarity 0.8 shares no band in 3 of a million cases
SIZE = BANDS * ROWS
BLOCK = 512


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Distinct shingle hashes in ascending order, their counts, and a 128-bit key of the word sequence."""
    data, starts, ends = folded_words(text)
    if not len(starts):
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64), hashlib.md5(b"\0" + (text or "").encode("utf-8", "surrogatepass")).digest()
    words = word_hashes(data, starts, ends)
    found, counts = np.unique(window_hashes(words, min(SHINGLE, len(words))), return_counts=True)
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    flat = np.where(np.cumsum(inside[:-1]) > 0, data, 32)
    key = hashlib.md5(flat[np.concatenate(([True], (flat[1:] != 32) | (flat[:-1] != 32)))].tobytes().strip()).digest()
    return found, counts, key


def signature(elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """ProbMinHash signature: the element that arrives first at each of SIZE components.

    All elements advance together, one arrival a round. After each round only elements whose last arrival is
    before the latest kept arrival go on; each element's arrivals follow from its hash alone.
    """
    best = np.full(SIZE, np.inf)
    kept = np.zeros(SIZE, dtype=U)
    live, rate, time = elements, weights.astype(np.float64), np.zeros(len(elements))
    turn = 0
    while len(live):
        turn += 1
        draw = mix(live + U(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log((np.float64(1) + (draw >> U(11)).astype(np.float64)) / 9007199254740993.0) / rate
        part = (mix(draw ^ U(0xD1B54A32D192ED03)) % U(SIZE)).astype(np.int64)
        order = np.argsort(time, kind="stable")[::-1]  # of several at one component the earliest is written last
        early = order[time[order] < best[part[order]]]
        best[part[early]] = time[early]
        kept[part[early]] = live[early]
        go = time < best.max()
        live, rate, time = live[go], rate[go], time[go]
    return kept


def band_hashes(kept: np.ndarray) -> np.ndarray:
    rows = kept.reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=U)
    for k in range(ROWS):
        h = mix(h * U(0x9E3779B97F4A7C15) + rows[:, k])
    return h.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard index of two bags (hashes ascending, counts)."""
    (ha, ca), (hb, cb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    common, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if ca.max() == 1 and cb.max() == 1:
        return len(common) / (len(ha) + len(hb) - len(common))
    x, y = ca[ia].astype(np.float64), cb[ib].astype(np.float64)
    # sum over common d of 1 / sum over all e of max(x_e / x_d, y_e / y_d), by the ratio r = x / y
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    below = np.concatenate(([0.0], np.cumsum(y)))  # where x_e / y_e <= r the term is y_e / y_d
    above = np.concatenate((np.cumsum(x[::-1])[::-1], [0.0]))
    r = x / y
    at = np.searchsorted(r, r, side="right")
    only_a, only_b = ca.sum() - x.sum(), cb.sum() - y.sum()
    return float((1 / ((below[at] + only_b) / y + (above[at] + only_a) / x)).sum())


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, t, key, bands) of each row with an id; t is a hash of its text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, bands = [], []
            for text in batch["text"].fillna(""):
                found, counts, key = shingles(text)
                keys.append(key)
                bands.append(band_hashes(signature(found, counts)) if len(found) else np.zeros(0, dtype=np.int64))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "t": batch["t"], "key": keys, "bands": bands})

    return _typed(docs).mapInPandas(run, "doc_id long, t long, key binary, bands array<long>")


def _typed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("t"), text.alias("text")).filter("doc_id is not null")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (left_id, right_id) whose texts are similar enough; texts has one row (id, text) for an id."""
    left = texts.select(F.col("id").alias("left_id"), F.col("text").alias("left_text"))
    right = texts.select(F.col("id").alias("right_id"), F.col("text").alias("right_text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, bag = None, None
        for batch in batches:
            keep = []
            for i, a, b in zip(batch["right_id"], batch["left_text"], batch["right_text"]):
                if i != last:
                    last, bag = i, shingles(b)[:2]
                keep.append(similarity(shingles(a)[:2], bag) >= threshold)
            yield batch.loc[keep, ["left_id", "right_id"]]

    both = pairs.hint("merge").join(left, "left_id").hint("merge").join(right, "right_id")
    return both.select("left_id", "right_id", "left_text", "right_text").mapInPandas(run, "left_id binary, right_id binary")


def block_links(ids: list, labels: list, halves: list[int], bags: list, threshold: float, same: bool) -> list[tuple]:
    """Links between classes found among the rows of one pair of blocks, by an inverted index over their shingles.

    Pairs that are in one class already, or in one half of two different blocks, are passed over; a link found
    joins its classes at once, so at most one link for each joined class comes out.
    """
    parent = {x: x for x in labels}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    n = len(ids)
    sizes = np.array([len(b[0]) for b in bags])
    owner = np.repeat(np.arange(n), sizes)
    every = np.concatenate([b[0] for b in bags])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    half = np.array(halves)
    plain = np.array([not len(b[1]) or b[1].max() == 1 for b in bags])
    links = []
    for i in range(n):
        lo, hi = np.searchsorted(every, bags[i][0], "left"), np.searchsorted(every, bags[i][0], "right")
        count = hi - lo
        at = np.arange(count.sum()) + np.repeat(lo - (np.cumsum(count) - count), count)
        shared = np.bincount(owner[at], minlength=n)
        near = shared / np.maximum(1, sizes[i] + sizes - shared)
        ok = (np.arange(n) > i) & (shared > 0) & np.where(plain & plain[i], near >= threshold, True)
        if not same:
            ok &= half != half[i]
        for j in np.flatnonzero(ok).tolist():
            a, b = top(labels[i]), top(labels[j])
            if a != b and (plain[i] and plain[j] or similarity(bags[i], bags[j]) >= threshold):
                parent[max(a, b)] = min(a, b)
                links.append((ids[i], ids[j]))
    return links


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """((doc_id, t, key, copy_of), (key, class_id, n_links)): the text of a row and its smallest id, and the class of each text in a shared band."""
    sig = cut_lineage(signatures(docs), "signatures")
    rep = cut_lineage(sig.groupBy("key").agg(F.min(F.struct("doc_id", "t")).alias("r")).select("key", F.col("r.doc_id").alias("copy_of"), F.col("r.t").alias("t")), "representatives")
    copies = cut_lineage(sig.select("doc_id", "t", "key").join(rep.select("key", "copy_of"), "key").distinct(), "copies")
    own = sig.groupBy("key").agg(F.any_value("bands").alias("bands"))  # equal words, equal bands
    rows = own.select(F.col("key").alias("id"), F.explode("bands").alias("h"))
    counts = rows.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    members = cut_lineage(rows.join(counts, "h"), "members")  # only buckets of two and more
    degree = members.groupBy("id").agg(F.sum("n").alias("degree"))
    ranked = members.join(degree, "id").select("h", "id", "n", "degree")
    pivots = ranked.groupBy("h").agg(F.max_by("id", F.struct("degree", "id")).alias("pivot"))
    seen = cut_lineage(members.join(pivots, "h").filter("id <> pivot").select("h", "id", "pivot"), "pivots")
    pairs = cut_lineage(seen.select(F.col("id").alias("left_id"), F.col("pivot").alias("right_id")).distinct(), "pairs")

    # the texts of shared buckets grow with the input: the hints keep the joins that bring texts sort-merge joins at every size
    vertices = members.select("id").distinct()
    first = vertices.hint("merge").join(rep.withColumnRenamed("key", "id"), "id").withColumnRenamed("copy_of", "doc_id")
    texts = _typed(docs).join(first.hint("merge"), ["doc_id", "t"]).select("id", "text")
    texts = cut_lineage(texts.groupBy("id").agg(F.min("text").alias("text")), "texts")
    links = cut_lineage(verified(pairs, texts, threshold), "links")
    labels = cut_lineage(connected_components(vertices, links), "labels")

    left = seen.join(labels, "id")
    mixed = left.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m")).filter("lo <> hi")
    blocks = left.join(mixed.select("h", "m"), "h").select("h", "id", "component", F.ceil(F.col("m") / BLOCK).cast("int").alias("k"))
    blocks = blocks.withColumn("b", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    blocks = cut_lineage(blocks, "blocks")
    more = links.limit(0)
    if not blocks.isEmpty():
        rows = blocks.hint("merge").join(texts, "id")
        rows = rows.select("h", "id", "component", "b", "text", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("o"))
        rows = rows.select("h", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "id", "component", "b", "text")
        parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
        rows = rows.repartition(parts, "h", "i", "j").sortWithinPartitions("h", "i", "j", "id")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: list[tuple] = []
            group = None

            def links_of() -> pd.DataFrame:
                ids, labels, halves, bags = zip(*held)
                found = block_links(list(ids), list(labels), list(halves), list(bags), threshold, group[1] == group[2]) if len(set(labels)) > 1 else []
                return pd.DataFrame(found, columns=["left_id", "right_id"], dtype="object")

            for batch in batches:
                for h, i, j, d, c, b, t in zip(*(batch[x].tolist() for x in ("h", "i", "j", "id", "component", "b", "text"))):
                    if group != (h, i, j):
                        if held:
                            yield links_of()
                        group, held = (h, i, j), []
                    held.append((d, c, b, shingles(t)[:2]))
            if held:
                yield links_of()

        more = cut_lineage(rows.mapInPandas(run, "left_id binary, right_id binary"), "more")
    every = links.unionByName(more)
    final = labels
    if not more.isEmpty():
        step = more.join(labels.select(F.col("id").alias("left_id"), F.col("component").alias("a")), "left_id")
        step = step.join(labels.select(F.col("id").alias("right_id"), F.col("component").alias("b")), "right_id").filter("a <> b")
        top = connected_components(labels.select(F.col("component").alias("id")).distinct(), step.select(F.col("a").alias("left_id"), F.col("b").alias("right_id")))
        final = labels.join(top.select(F.col("id").alias("component"), F.col("component").alias("top")), "component").select("id", F.col("top").alias("component"))
    ends = every.select(F.col("left_id").alias("id")).union(every.select(F.col("right_id").alias("id"))).groupBy("id").agg(F.count("*").alias("n_links"))
    final = final.join(rep.select(F.col("key").alias("id"), "copy_of"), "id")
    least = final.groupBy("component").agg(F.min("copy_of").alias("class_id"))
    final = final.join(least, "component").join(ends, "id", "left").select(F.col("id").alias("key"), "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return copies, cut_lineage(final, "classes")


def by_text(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, t, class_id, copy_of, n_links) of each text of an id."""
    copies, found = classes(docs, threshold)
    both = copies.join(found, "key", "left")
    return both.select("doc_id", "t", F.coalesce("class_id", "copy_of").alias("class_id"), "copy_of", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, copy_of, n_links): class_id is the smallest id of the class, copy_of the first equal text.

    n_links counts the links found from the text `copy_of` that hold its class together.
    """
    least = by_text(docs, threshold).groupBy("doc_id").agg(F.min(F.struct("copy_of", "class_id", "n_links")).alias("m"))
    return least.select("doc_id", "m.class_id", "m.copy_of", "m.n_links")


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose id is the smallest of the class of their text, all columns; rows without an id stay."""
    gone = by_text(docs, threshold).filter("doc_id <> class_id").select("doc_id", "t")
    rows = docs.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    return rows.join(gone, (F.col("row.doc_id").cast("long") == F.col("doc_id")) & (F.xxhash64(text) == F.col("t")), "left_anti").select("row.*")
