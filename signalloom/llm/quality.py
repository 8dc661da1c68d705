"""Quality by nearest-neighbour voting in a latent-semantic space (operator 12).

A text is a bag of byte trigrams and four-grams, words, and repeats (a word equal to the one before it),
hashed to `TERMS` terms; weights are square roots of counts times inverse document frequency, with unit length.
Latent vectors are projections on the leading `DIMENSIONS` right singular vectors of the labelled sample,
again with unit length. The labelled vectors are broadcast; every document gets its cosines with all of them in
blocks of `BLOCK` documents, exactly. The `NEIGHBOURS` most similar ones vote with their squared similarity,
weighed by class so that the balanced sample stands for all labels; neighbours as similar as the last one
(to `TIE`) all vote, so the order of rows has no part in it. `PRIOR` votes go to the share of label 1.

The sample is bounded: at most `TRAIN_ROWS` labelled documents of a class, those first by a hash of the id.
Their texts stay on the executors: a row of the sample is a bag of at most `TERMS` terms, however long its text.
Scoring reads every whole text in a `mapInArrow` over the scan, without a shuffle.

Defined results: a null text counts as an empty one, and an empty one scores the share of label 1; rows with
null labels or null ids do not vote; of repeated labels of an id the largest counts, of different texts of an id
the one with the least hash; each input row gives one row; with labels of one class every score is that class,
without labels 0. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from signalloom.llm.arrow import keep_rows, map_columns
from signalloom.llm.sampling import first_by_hash
from signalloom.llm.words import FOLD, IS_WORD, U, mix, powers, spans, word_hashes

TRAIN_ROWS = 1_500
TERMS = 1 << 13
GRAMS = (3, 4)
REPEATS = 30
DIMENSIONS = 64
EXTRA, ROUNDS = 16, 12
NEIGHBOURS = 15
BLOCK = 256
TIE = 1e-5
PRIOR = 0.2
THRESHOLD = 0.7
_BASE = 0xB5297A4D3F84D5B5
_REPEAT = 4057


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def bag(text: str | None) -> np.ndarray:
    """How often each term is in a text."""
    if not text:
        return np.zeros(TERMS, dtype=np.float32)
    data = np.frombuffer(f" {text} ".encode("utf-8", "surrogatepass"), dtype=np.uint8)
    up, down = powers(_BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=sums[1:])
    counts = np.zeros(TERMS, dtype=np.int64)
    for n in GRAMS:
        if len(data) >= n:
            grams = mix((sums[n:] - sums[:-n]) * down[: len(data) - n + 1] + U(n))
            counts += np.bincount((grams & U(TERMS - 1)).astype(np.int32), minlength=TERMS)
    folded = FOLD[data]
    words = word_hashes(folded, *spans(IS_WORD[folded]))
    counts += np.bincount((words & U(TERMS - 1)).astype(np.int32), minlength=TERMS)
    counts[_REPEAT] += REPEATS * int((words[1:] == words[:-1]).sum())
    return counts.astype(np.float32)


class Model:
    """Term weights, basis, labelled vectors and how much each votes."""

    def __init__(self, bags: np.ndarray, labels: np.ndarray, share: float):
        """`bags` is a row of term counts for each label, overwritten here; `share` is the share of label 1 among all labels."""
        self.share = share
        self.fit = 0 < share < 1 and 0 < labels.sum() < len(labels)
        if not self.fit:
            return
        rows = np.sqrt(bags, out=bags)
        self.weight = np.log((1 + len(rows)) / (1 + np.count_nonzero(rows, axis=0))).astype(np.float32)
        rows *= self.weight
        rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
        self.basis = self._leading(rows)
        self.vectors = self._unit(rows @ self.basis)
        self.labels = labels.astype(np.float32)
        ones = labels.mean()
        self.says = np.where(labels == 1, share / ones, (1 - share) / (1 - ones)).astype(np.float32)

    @staticmethod
    def _leading(rows: np.ndarray) -> np.ndarray:
        """Leading right singular vectors by subspace iteration: besides the rows it holds a narrow block only."""
        q = np.random.default_rng(1).normal(size=(rows.shape[1], min(*rows.shape, DIMENSIONS + EXTRA))).astype(np.float32)
        for _ in range(ROUNDS):
            q = np.linalg.qr(rows.T @ (rows @ q))[0]
        left = rows @ q
        e, u = np.linalg.eigh((left.T @ left).astype(np.float64))
        e, u = e[::-1][:DIMENSIONS], u[:, ::-1][:, :DIMENSIONS]
        return q @ u[:, e > 1e-6 * e[0]].astype(np.float32)

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)

    def latent(self, bags: np.ndarray) -> np.ndarray:
        return self._unit(self._unit(np.sqrt(bags) * self.weight) @ self.basis)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.fit:
            return np.full(len(texts), self.share)
        out = np.empty(len(texts))
        for at in range(0, len(texts), BLOCK):
            some = np.stack([bag(t) for t in texts[at : at + BLOCK]])
            cosine = self.latent(some) @ self.vectors.T
            k = min(NEIGHBOURS, cosine.shape[1])
            last = np.partition(cosine, -k, axis=1)[:, -k]
            vote = np.where(cosine >= last[:, None] - TIE, np.maximum(cosine, 0) ** 2 * self.says, 0).astype(np.float64)
            out[at : at + BLOCK] = (vote @ self.labels + PRIOR * self.share) / (vote.sum(axis=1) + PRIOR)
        return np.clip(out, 0, 1)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of the ids that may vote and have a document."""
    fit = F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))
    marked = labels.filter(fit).groupBy("doc_id").agg((F.max("quality") > 0).cast("int").alias("quality"))
    return marked.join(docs.select("doc_id").distinct(), "doc_id")


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, quality, terms, counts): the bounded sample as bags, two arrays of numbers as bytes."""
    chosen = first_by_hash(labelled(docs, labels), "quality", "doc_id", TRAIN_ROWS)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")

    def make(batch: pa.RecordBatch) -> Iterator[list]:
        bags = [bag(t) for t in batch.column("text").to_pylist()]
        at = [np.flatnonzero(b) for b in bags]
        yield [batch.column("doc_id"), batch.column("quality"), batch.column("hash"), [i.astype("<u2").tobytes() for i in at], [b[i].astype("<f4").tobytes() for b, i in zip(bags, at)]]

    hashed = texts.select(F.col("doc_id").cast("long"), "quality", F.xxhash64("text").alias("hash"), "text")
    return map_columns(hashed, "doc_id long, quality int, hash long, terms binary, counts binary", make)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    share = labelled(docs, labels).agg(F.avg("quality")).first()[0] or 0.0
    first = sample(docs, labels).groupBy("doc_id", "quality").agg(F.min_by(F.struct("terms", "counts"), "hash").alias("bag"))
    rows = sorted(first.select("doc_id", "quality", "bag.terms", "bag.counts").collect())  # bounded: 2 x TRAIN_ROWS bags of TERMS terms
    bags = np.zeros((len(rows), TERMS), dtype=np.float32)
    for b, r in zip(bags, rows):
        b[np.frombuffer(r.terms, dtype="<u2")] = np.frombuffer(r.counts, dtype="<f4")
    return Model(bags, np.array([r.quality for r in rows]), float(share))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of each row; only the text is read for the score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # TERMS x DIMENSIONS and 2 x TRAIN_ROWS x DIMENSIONS numbers

    def run(batch: pa.RecordBatch) -> Iterator[list]:
        yield [batch.column("doc_id"), pa.array(shared.value.score(batch.column("text").to_pylist()))]

    return map_columns(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id long, score double", run)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    s = score(docs, fit(docs, labels))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored THRESHOLD or more, all columns and rows as they were."""
    model = fit(docs, labels)
    return keep_rows(docs, "text", lambda t: float(model.score([t])[0]) >= THRESHOLD)
