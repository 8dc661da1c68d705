"""Repeated passages across documents by difference-cover anchors (operator 5).

Words are runs of anything but white space. Of every 31 word positions the six of a perfect difference set
carry an anchor: a hash of the 20 words from there. Whatever the positions of two equal windows of 50 words,
some shift below 31 puts both on the cover, and the anchor of 20 words lies inside: any long match shares an
aligned anchor. Matches then extend: every window of 50 words around a shared anchor is hashed to 128 bits,
the smallest document of each window is a grouped minimum, and a window that a smaller document has removes
the words it covers. Pairs of documents are never made.

1. One scan gives a row per document: words, a key of the word sequence, the hash of the unchanged words.
   Copies collapse by a grouped minimum of the key: all words of a later copy go, if it has a window.
2. Anchors are counted (once per document, combined before the shuffle) and joined back: narrow rows only.
3. Texts of documents with shared anchors are shuffled by id, once for the windows and the removal.

Free style (numpy in `mapInPandas`): window hashes read off prefix sums have no column form.

Defined results: null texts have no words; rows without an id neither lose words nor make others lose some;
rows of equal id and text give one row; of rows with equal id and other text neither removes words of the
other; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from signalloom.llm.arrow import map_columns
from signalloom.llm.words import IS_TEXT, spans, window_hashes, word_hashes
from signalloom.session import cut_lineage

WINDOW = 50
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)  # each difference modulo 31 occurs once
ANCHOR = WINDOW - PERIOD + 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()  # bytes part at the blank and U+0009 to U+000D only


def hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    return word_hashes(data, *spans(IS_TEXT[data]), seed=seed)


def anchors(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions on the cover and the hashes of the anchors there."""
    found = window_hashes(h, ANCHOR)
    on = np.zeros(PERIOD, dtype=bool)
    on[list(COVER)] = True
    at = np.flatnonzero(on[np.arange(len(found)) % PERIOD])
    return at, found[at]


def covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of n positions lie in a run of `size` from one of the starts."""
    step = np.zeros(n + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + size, -1)
    return np.cumsum(step[:n]) > 0


def candidates(words: list[bytes], shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 128-bit hashes of the windows that hold a shared anchor."""
    h = hashes(words)
    n = len(words) - WINDOW + 1
    at, found = anchors(h)
    at = at[np.isin(found, shared)]
    first, last = np.maximum(at - (WINDOW - ANCHOR), 0), np.minimum(at, n - 1)
    step = np.zeros(n + 1, dtype=np.int32)
    ok = first <= last
    np.add.at(step, first[ok], 1)
    np.add.at(step, last[ok] + 1, -1)
    starts = np.flatnonzero(np.cumsum(step[:n]) > 0)
    one = window_hashes(h, WINDOW)[starts]
    two = window_hashes(hashes(words, 1), WINDOW, 1)[starts]
    _, once = np.unique(one, return_index=True)
    return one[once], two[once]


def removed(words: list[bytes], gone: np.ndarray) -> np.ndarray:
    """Which words the windows with a hash in `gone` cover."""
    return covered(len(words), np.flatnonzero(np.isin(window_hashes(hashes(words), WINDOW), gone)), WINDOW)


def _map(df: DataFrame, columns: list[str], schema: str, make) -> DataFrame:
    """`make` gives, for a row's values, None or the columns it adds; arrays become rows."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, hashes_, out = [], [], []
            size = 0
            for d, th, *rest in zip(batch["doc_id"], batch["th"], *(batch[c] for c in columns)):
                got = make(*rest)
                if got is None:
                    continue
                ids.append(d)
                hashes_.append(th)
                out.append(got)
                size += len(got[0]) if isinstance(got[0], np.ndarray) else 1
                if size > 500_000:
                    yield _frame(names, ids, hashes_, out)
                    ids, hashes_, out, size = [], [], [], 0
            if ids:
                yield _frame(names, ids, hashes_, out)

    return df.select("doc_id", "th", *columns).mapInPandas(run, schema)


def _frame(names: list[str], ids: list, ths: list, out: list) -> pd.DataFrame:
    if isinstance(out[0][0], np.ndarray):
        n = [len(o[0]) for o in out]
        cols = [np.repeat(np.array(ids, dtype=np.int64), n), np.repeat(np.array(ths, dtype=np.int64), n), *(np.concatenate(c).view(np.int64) for c in zip(*out))]
    else:
        cols = [ids, ths, *map(list, zip(*out))]
    return pd.DataFrame(dict(zip(names, cols)))


def _typed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("th"), text.alias("text"))


def _head(text: str) -> tuple:
    words = words_of(text)
    joined = b" ".join(words)
    return len(words), hashlib.md5(joined).digest(), hashlib.sha256(joined).hexdigest()


def _anchors(text: str):
    words = words_of(text)
    return (np.unique(anchors(hashes(words))[1]),) if len(words) >= WINDOW else None


def _windows(text: str, shared) -> tuple[np.ndarray, np.ndarray]:
    return candidates(words_of(text), np.asarray(shared, dtype=np.int64).view(np.uint64))


def _kept(text: str, gone) -> tuple:
    words = words_of(text)
    off = removed(words, np.asarray(gone, dtype=np.int64).view(np.uint64))
    kept = b" ".join([w for w, x in zip(words, off.tolist()) if not x])
    return int(off.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")


def removals(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(heads, cut): a row per document (doc_id, th, n_words, sha, first, with first the smallest id with the same words),
    and for those that lose some words, copies aside, (doc_id, th, n_removed, sha, kept)."""
    typed = _typed(docs)
    heads = cut_lineage(_heads(typed).distinct(), "heads")
    firsts = heads.filter("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("first"))
    heads = cut_lineage(heads.join(firsts, "key", "left").drop("key"), "copies")
    real = typed.filter("doc_id is not null")
    marks = _map(real, ["text"], "doc_id long, th long, h long", _anchors)
    often = marks.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    shared = marks.join(often, "h").groupBy("doc_id", "th").agg(F.collect_list("h").alias("shared"))  # at most a document's own anchors
    single = heads.filter("doc_id = first").select("doc_id", "th")
    shared = cut_lineage(shared.join(single, ["doc_id", "th"], "left_semi"), "shared")
    windows = _map(real.join(shared, ["doc_id", "th"]), ["text", "shared"], "doc_id long, th long, a long, b long", _windows)
    least = windows.groupBy("a", "b").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select("a", "b", "least")
    gone = windows.join(least, ["a", "b"]).filter("doc_id > least").groupBy("doc_id", "th").agg(F.collect_list("a").alias("gone"))
    cut = _map(real.join(gone, ["doc_id", "th"]), ["text", "gone"], "doc_id long, th long, n_removed long, sha string, kept string", _kept)
    return heads, cut


def _heads(df: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[list]:
        if batch.num_rows:
            yield [batch.column("doc_id"), batch.column("th"), *map(list, zip(*map(_head, batch.column("text").to_pylist())))]

    return map_columns(df, "doc_id long, th long, n_words long, key binary, sha string", run)


def _outcome(docs: DataFrame, columns: list[str]) -> DataFrame:
    heads, cut = removals(docs)
    cut = cut.select("doc_id", "th", F.col("n_removed").alias("_n"), F.col("sha").alias("_sha"), *[c for c in columns])
    both = heads.join(cut, ["doc_id", "th"], "left")
    copy = (F.col("first") < F.col("doc_id")) & (F.col("n_words") >= WINDOW)
    n = F.when(copy, F.col("n_words")).otherwise(F.coalesce("_n", F.lit(0))).cast("long")
    sha = F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("_sha", "sha"))
    return both.select("doc_id", "th", "n_words", n.alias("n_removed"), sha.alias("kept_sha256"), *columns)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return _outcome(docs, []).drop("th")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The documents with the repeated words removed and kept words joined by one blank; others stay as they are."""
    out = _outcome(docs, ["kept"]).filter("n_removed > 0").select("doc_id", "th", F.coalesce("kept", F.lit("")).alias("kept"))
    rows = docs.select(F.struct("*").alias("row"))
    same = (F.col("row.doc_id").cast("long") == F.col("doc_id")) & (F.xxhash64(F.coalesce(F.col("row.text").cast("string"), F.lit(""))) == F.col("th"))
    return rows.join(out, same, "left").withColumn("row", F.col("row").withField("text", F.coalesce("kept", "row.text"))).select("row.*")
