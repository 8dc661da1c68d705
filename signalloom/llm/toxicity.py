"""Toxicity by subword-bag embeddings and a linear softmax (operator 4).

A text is the bag of its words and of their byte n-grams, word edges included, each hashed to one of
`BUCKETS` features. Their embeddings are averaged and go into a linear softmax over two classes;
embeddings and softmax are trained jointly in numpy by Adam on the whole sample, so a misspelling scores
through the n-grams it shares. With two classes both gradients follow from X'(p - y): an epoch is one
gather and one bincount.

The sample is bounded: labelled texts of a class in the order of a hash of the id, at most `TRAIN_ROWS` of them,
until those taken have `TRAIN_CHARS` characters; no length is shut out and none is cut. Scoring reads every whole text
in a `mapInArrow` over the scan, without a shuffle; the model is a table of fixed size in the closure.

Defined results: a null text counts as an empty one and an empty one scores the prior of its class balance;
rows with null labels or null ids do not train; of repeated labels of an id the largest counts, of different texts
of an id the one with the least hash; each input row gives one row; without
labels of both classes every score is the share of the class there is (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from signalloom.llm.arrow import keep_rows, map_columns
from signalloom.llm.sampling import first_by_hash
from signalloom.llm.words import FOLD, IS_WORD, U, mix, powers, spans, word_hashes

TRAIN_ROWS = 2_000
TRAIN_CHARS = 24_000_000
BUCKETS = 1 << 18
GRAMS = (3, 4, 5, 6)
DIMENSIONS = 8
LEAST_TEXTS = 3
CHUNK = 200
EPOCHS = 80
STEP = 0.3
DECAY = 0.1
TOXIC_WEIGHT = 0.3
THRESHOLD = 0.7
_BASE = 0xB5297A4D3F84D5B5


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def features(text: str | None) -> np.ndarray:
    """Buckets of all words and of all n-grams inside a word or one edge beyond it."""
    raw = np.frombuffer(f" {text or ''} ".encode("utf-8", "surrogatepass"), dtype=np.uint8)
    data = FOLD[raw]
    inside = IS_WORD[data]
    data = np.where(inside, data, np.uint8(32))
    starts, ends = spans(inside)
    out = [word_hashes(data, starts, ends)]
    up, down = powers(_BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=sums[1:])
    gaps = np.zeros(len(data) + 1, dtype=np.int32)
    np.cumsum(~inside, out=gaps[1:])
    for n in GRAMS:
        if len(data) >= n:
            i = np.flatnonzero(gaps[n - 1 : -1] == gaps[1 : len(data) - n + 2])  # blanks only at the edges
            out.append(mix((sums[i + n] - sums[i]) * down[i] + U(n)))
    return (np.concatenate(out) & U(BUCKETS - 1)).astype(np.int32)


class Model:
    """`value[bucket]` is the embedding's share in the log odds, `bias` the rest."""

    def __init__(self, value: np.ndarray, bias: float):
        self.value, self.bias = value.astype(np.float32), float(bias)

    def score(self, text: str | None) -> float:
        found = features(text)
        z = self.bias + (float(self.value[found].mean(dtype=np.float64)) if len(found) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def bags(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct features of each text and their share of it."""
    for t in texts:
        found = features(t)
        u, c = np.unique(found, return_counts=True)
        yield u, (c / max(1, len(found))).astype(np.float32)


def train(texts: list[str], labels: list[int], seed: int = 1) -> Model:
    """Fits embeddings and softmax; texts are held as sparse rows in chunks, features of few texts left out."""
    y = np.array(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS), 30.0 if len(y) and y[0] else -30.0)
    seen = np.zeros(BUCKETS, dtype=np.int32)
    for t in texts:
        seen[np.unique(features(t))] += 1
    often = seen >= LEAST_TEXTS
    number = (np.cumsum(often) - 1).astype(np.int32)
    n = int(often.sum())
    chunks = []
    for at in range(0, len(texts), CHUNK):
        some = [(number[u[often[u]]], v[often[u]]) for u, v in bags(texts[at : at + CHUNK])]
        row = np.repeat(np.arange(len(some), dtype=np.int32), [len(u) for u, _ in some])
        chunks.append((at, at + len(some), row, np.concatenate([u for u, _ in some]), np.concatenate([v for _, v in some])))
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.1, (n, DIMENSIONS)), rng.normal(0, 0.1, (DIMENSIONS, 2)), np.zeros(2)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weight = np.where(y == 1, TOXIC_WEIGHT / y.sum(), (1 - TOXIC_WEIGHT) / (1 - y).sum())
    for epoch in range(1, EPOCHS + 1):
        table, soft, bias = params
        diff = soft[:, 1] - soft[:, 0]
        values = (table @ diff).astype(np.float32)
        back, loss = np.zeros(n), 0.0
        for lo, hi, row, col, val in chunks:
            z = np.bincount(row, weights=val * values[col], minlength=hi - lo) + bias[1] - bias[0]
            miss = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y[lo:hi]) * weight[lo:hi]
            back += np.bincount(col, weights=val * miss.astype(np.float32)[row], minlength=n)
            loss += miss.sum()
        pull = table.T @ back
        for p, g, m, v in zip(params, (np.outer(back, diff) + DECAY / max(1, n) * table, np.stack((-pull, pull), 1), np.array([-loss, loss])), first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= STEP * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.999**epoch)) + 1e-10)
    table, soft, bias = params
    value = np.zeros(BUCKETS)
    value[often] = table @ (soft[:, 1] - soft[:, 0])
    return Model(value, bias[1] - bias[0])


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic): the bounded training sample; held-out ids are not in it."""
    fit = F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))
    marked = labels.filter(fit).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sized = texts.groupBy("doc_id").agg(F.max(F.length("text")).cast("long").alias("chars")).join(marked, "doc_id")
    chosen = first_by_hash(sized, "toxic", "doc_id", TRAIN_ROWS)
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")  # over TRAIN_ROWS rows at most
    chosen = chosen.withColumn("taken", F.sum("chars").over(order) - F.col("chars")).filter(F.col("taken") < TRAIN_CHARS).select("doc_id", "toxic")
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = sample(docs, labels).toPandas().sort_values("doc_id")  # bounded: 2 x TRAIN_ROWS texts, 2 x (TRAIN_CHARS + one text) characters
    return train(rows["text"].tolist(), rows["toxic"].tolist())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of each row; only the text is read for the score."""
    def run(batch: pa.RecordBatch) -> Iterator[list]:
        yield [batch.column("doc_id"), [model.score(t) for t in batch.column("text").to_pylist()]]

    return map_columns(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id long, score double", run)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    s = score(docs, fit(docs, labels))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored below THRESHOLD, all columns and rows as they were."""
    model = fit(docs, labels)
    return keep_rows(docs, "text", lambda t: model.score(t) < THRESHOLD)
