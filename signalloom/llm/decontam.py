"""Benchmark decontamination with a broadcast hash set of test n-grams (operator 1, native).

Benchmark items become windows of ten words (an item of fewer words is one window), hashed and broadcast.
Each document's words are scanned once, every position is looked up by hash, a hit is verified word by
word. Texts are never shuffled: what leaves the scan is one summary row per document and one narrow row
per hit. The broadcast happens only when there are at most `BROADCAST_WINDOWS` windows (about 200 bytes
each); beyond that the same rows meet in a shuffled join on the hash, which adaptive execution splits.

Defined results: null text or item has no words and no hits; null ids form a group of their own; rows with
equal id and text count once, rows with equal id and other text are told apart; two items with equal windows
both count; an empty benchmark hits nothing; other columns are ignored or, in the removers, passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signalloom.session import cut_lineage

WINDOW = 10
BROADCAST_WINDOWS = 500_000
# The characters of a word, with and without the letters A-Z that are folded first.
FOLDED_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold(text: Column) -> Column:
    """Lower-cases A-Z only; null becomes empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def words(text: Column) -> Column:
    return F.regexp_extract_all(fold(text), F.lit(FOLDED_WORD), F.lit(0))


def _at_least_one(last: Column) -> Column:
    """1..last, or an empty array."""
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(win, len, ws, item_id): every window of every item once; `win` is the hash of the words."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    w = w.filter(F.size("w") > 0).select("item_id", "w", F.least(F.size("w"), F.lit(size)).alias("len"))
    w = w.select("item_id", "w", "len", F.explode(_at_least_one(F.size("w") - F.col("len") + 1)).alias("i"))
    w = w.select("item_id", "len", F.slice("w", F.col("i"), F.col("len")).alias("ws"))
    return w.select(F.xxhash64("ws").alias("win"), "len", "ws", "item_id").distinct()


def scan(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, i, len, win, ws): a row with i = 0 for each document, and one for each window hit at word i."""
    distinct = windows.select("win", "len", "ws").distinct()
    found = distinct.groupBy("len").count().collect()  # one row for each length, at most the window size
    lengths, total = sorted(r["len"] for r in found), sum(r["count"] for r in found)
    d = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    d = d.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words(F.col("text")).alias("w"))
    d = d.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), "w")
    keys = ["doc_id", "text_hash", "n_words"]
    if not lengths:
        none = F.lit(None)
        return d.select(*keys, F.lit(0).alias("i"), none.cast("int").alias("len"), none.cast("long").alias("win"),
                        none.cast("array<string>").alias("ws")).distinct()
    rows = d.select(*keys, "w", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - lengths[0] + 1))).alias("i"))
    if len(lengths) == 1:
        rows = rows.withColumn("n", F.lit(lengths[0]))
    else:
        rows = rows.select("*", F.explode(F.array([F.lit(n) for n in lengths])).alias("n"))
    inside = (F.col("i") >= 1) & (F.col("i") + F.col("n") - 1 <= F.size("w"))
    rows = rows.select(*keys, "i", F.when(inside, F.slice("w", F.greatest("i", F.lit(1)), F.col("n"))).alias("here"), F.when(inside, F.col("n")).alias("n"))
    rows = rows.withColumn("hash", F.when(F.col("here").isNotNull(), F.xxhash64("here")))
    same = (F.col("hash") == F.col("win")) & (F.col("n") == F.col("len")) & (F.col("here") == F.col("ws"))
    if total <= BROADCAST_WINDOWS:
        out = rows.join(F.broadcast(distinct), same, "left").filter((F.col("i") == 0) | F.col("win").isNotNull())
        return out.select(*keys, "i", "len", "win", "ws")
    hits = rows.filter(F.col("hash").isNotNull()).join(distinct, same).select(*keys, "i", "len", "win", "ws")
    none = rows.filter(F.col("i") == 0).select(*keys, "i").distinct()
    return none.unionByName(hits, allowMissingColumns=True)


def covered(spans: Column) -> Column:
    """Number of words in sorted spans (i, len) that may overlap."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(acc: Column, s: Column) -> Column:
        end = s["i"] + s["len"]
        return F.struct(F.greatest(acc["end"], end).alias("end"),
                        (acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], s["i"]))).alias("n"))

    return F.aggregate(spans, start, step, lambda acc: acc["n"].cast("long"))


def merged(spans: Column) -> Column:
    """Sorted spans (i, len) as disjoint (from, to), `to` exclusive."""
    none = F.array().cast("array<struct<from:int,to:int>>")
    start = F.struct(F.lit(0).alias("from"), F.lit(0).alias("to"), none.alias("out"))
    held = lambda acc: F.struct(acc["from"].alias("from"), acc["to"].alias("to"))

    def step(acc: Column, s: Column) -> Column:
        joins = s["i"] <= acc["to"]
        out = F.when(joins | (acc["to"] == 0), acc["out"]).otherwise(F.array_append(acc["out"], held(acc)))
        return F.struct(F.when(joins, acc["from"]).otherwise(s["i"]).alias("from"), F.greatest(acc["to"], s["i"] + s["len"]).alias("to"), out.alias("out"))

    return F.aggregate(spans, start, step, lambda acc: F.when(acc["to"] > 0, F.array_append(acc["out"], held(acc))).otherwise(none))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, n_items, items, spans): one row per document.

    `items` are the item ids with a window in the document, sorted as strings; `spans` are the hits (first word, words).
    """
    windows = cut_lineage(item_windows(benchmark, size), "windows")
    rows = cut_lineage(scan(docs, windows), "hits")
    key = ["doc_id", "text_hash"]
    hits = rows.filter("i > 0")
    spans = F.array_sort(F.collect_set(F.when(F.col("i") > 0, F.struct("i", "len"))))
    base = rows.groupBy(*key).agg(F.max("n_words").alias("n_words"), spans.alias("spans"))
    items = hits.select(*key, "win", "ws").distinct().join(windows, ["win", "ws"]).select(*key, "item_id").distinct()
    items = items.groupBy(*key).agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    a, b = base.alias("a"), items.alias("b")
    both = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_hash") == F.col("b.text_hash")), "left")
    items = F.coalesce(F.col("b.items"), F.array().cast("array<string>"))
    return both.select("a.doc_id", "a.text_hash", "a.n_words", covered(F.col("a.spans")).alias("n_hit"),
                       F.size(items).cast("long").alias("n_items"), items.alias("items"), "a.spans")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    c = contamination(docs, benchmark)
    return c.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))


def _hit(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """The documents as (row), the hit ones as (doc_id, text_hash, spans), and the condition that joins them."""
    rows = docs.select(F.struct("*").alias("row"))
    hit = contamination(docs, benchmark).filter("n_hit > 0").select("doc_id", "text_hash", "spans")
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64(F.coalesce(F.col("row.text").cast("string"), F.lit(""))) == F.col("text_hash"))
    return rows, hit, same


def drop_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, all columns and rows as they were."""
    rows, hit, same = _hit(docs, benchmark)
    return rows.join(hit.select("doc_id", "text_hash"), same, "left_anti").select("row.*")


def cut_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents; where words are hit, they go, each with the separator after it. Unhit texts stay as they are."""
    rows, hit, same = _hit(docs, benchmark)
    d = rows.join(hit.withColumn("runs", merged(F.col("spans"))), same, "left")
    text = F.col("row.text")
    # words beside the gaps after them, split once: naming the split inside the lambda would split the text for each word
    pieces = F.arrays_zip(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"), F.slice(F.split(text, WORD), F.lit(2), F.size(F.split(text, WORD))).alias("gap"))
    d = d.withColumn("gap", F.when(F.col("runs").isNotNull(), F.get(F.split(text, WORD), F.lit(0)))).withColumn("pieces", F.when(F.col("runs").isNotNull(), pieces))
    # from run to run: what lies between two runs is one slice, so the work grows with the words, not with words x runs
    edges = F.concat(F.transform("runs", lambda r: r["from"]), F.array(F.size("pieces") + 1))
    starts = F.concat(F.array(F.lit(1)), F.transform("runs", lambda r: r["to"]))
    kept = F.flatten(F.zip_with(starts, edges, lambda a, b: F.slice("pieces", a, F.greatest(b - a, F.lit(0)))))
    kept = F.transform(kept, lambda p: F.concat(p["w"], p["gap"]))
    cut = F.when(F.col("runs").isNull(), text).otherwise(F.concat(F.col("gap"), F.concat_ws("", kept)))
    return d.withColumn("row", F.col("row").withField("text", cut)).select("row.*")
