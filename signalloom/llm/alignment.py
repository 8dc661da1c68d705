"""Cross-tokenizer alignment with an identity-map fast path (operator 13).

A text is cut twice: by byte-level BPE (A, of blank + text) and by pieces with byte fallback (B, which adds the
blank itself). The byte offsets at which a token of A and one of B both end cut both sequences into groups; the
two last tokens of a group are linked. An array from A's ids to the B id of the same bytes is made once. A group
of one A token and its B image is counted in a vector as long as A's vocabulary, one per task; only the links
of other groups go, as (pair, count) rows combined per document and per task, into the shuffle that counts pairs.

Each text is encoded once: the written table of links holds, per row, the digests, the A ids of fast links and
the distinct other pairs with their counts. Pair counts come back in two ways. Of pairs that hold more than 1 in
`FREQUENT` of all links there are fewer than `FREQUENT`; they, the counts of all identity pairs (as many as A's
vocabulary at most) and the highest count of each B id are broadcast. Links of the other, rare pairs join their
counts by pair, where no key can hold more than 1 in `FREQUENT` of all links.

A blank between two visible characters begins a token in both tokenizers (no piece holds the blank mark behind
another character, which is checked), so a text is a row of units that are encoded and cut into groups by
themselves. Each task encodes a unit when it first sees it, many new ones at a time, and remembers its groups, up to
`UNITS` of them or `UNIT_CHARS` characters; a document is the sum of its units.

Defined results: texts that are null, empty, or whose token bytes are not blank + text in both tokenizers (as with
U+2581 itself) have zeros and an empty digest. Strings of special tokens are plain text. Each input row gives one
row, repeated ids and rows included, and counts as often as it is there; null ids stay null; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from signalloom.llm import bpe
from signalloom.llm.arrow import map_columns
from signalloom.session import cut_lineage, small_table

CHARS_AT_ONCE = 3_000_000
UNITS = 250_000
UNIT_CHARS = 4_000_000
FREQUENT = 1 << 20
MARK = "▁"


class Pieces:
    """A sentencepiece model: ids of a text, and the bytes of its pieces."""

    def __init__(self, proto: bytes):
        self.model = m = sentencepiece.SentencePieceProcessor(model_proto=proto)
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.bytes = [bytes([int(n[3:5], 16)]) if m.is_byte(i) else n.replace(MARK, " ").encode() for i, n in enumerate(names)]
        self.plain = [i for i in range(len(names)) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        if any(MARK in names[i].lstrip(MARK) for i in self.plain) or m.encode("a") + m.encode("b") != m.encode("a b"):
            raise ValueError("a piece bridges a blank, so texts can't be cut at blanks")


def digits(n: int, ends: str) -> list[np.ndarray]:
    """For each ending a matrix of the numbers 0..n-1 in decimal with the ending behind, zero bytes elsewhere."""
    width = len(str(n)) + 1
    return [np.frombuffer(b"".join(f"{i}{c}".encode().ljust(width, b"\0") for i in range(n)), dtype=np.uint8).reshape(n, width) for c in ends]


_ODD = regex.compile(rf"\s\s|{MARK}|^\s|\s$")
_CUT = regex.compile(rf"(?<=[^\s{MARK}]) (?=\S)")


def units(text: str) -> list[str]:
    """The parts of a text between the blanks that begin a token in any case."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


class Aligner:
    """Units with their groups; everything of a unit lies in flat arrays."""

    def __init__(self, vocabulary: str, proto: bytes):
        self.a, self.b = bpe.Model(vocabulary, special=False), Pieces(proto)
        self.size_b = len(self.b.bytes)
        self.len_b = np.array([len(p) for p in self.b.bytes], dtype=np.int64)
        self.begin_b = np.cumsum(self.len_b) - self.len_b
        self.blob_b = np.frombuffer(b"".join(self.b.bytes), dtype=np.uint8)
        self.image = images(self.a, self.b)
        self.text_a, self.text_b = digits(len(self.a.lengths), ",|"), digits(self.size_b, ",;")
        self.forget()

    def forget(self) -> None:
        self.known = bpe.Numbers()
        self.written: list[bytes] = []
        self.counts = np.zeros((0, 4), dtype=np.int64)  # tokens of A, of B, groups, 1 where the bytes are the text's
        self.fast, self.odd = (np.zeros(0, dtype=np.int64) for _ in range(2))
        self.sizes = np.zeros((0, 2), dtype=np.int64)  # fast and other links

    def learn(self, words: list[str]) -> None:
        """Encodes new units, all in one go: they form one text whose units end where both tokenizers end."""
        raw = [f" {w}".encode("utf-8", "surrogatepass") for w in words]
        a, n_a = self.a.encode_all([f" {w}" for w in words])
        found = self.b.model.encode(words, num_threads=1)
        n_b = np.array([len(x) for x in found], dtype=np.int64)
        a, b = a.astype(np.int64), np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(n_b.sum()))
        size = np.array([len(r) for r in raw], dtype=np.int64)
        right = (totals(self.a.lengths[a], n_a) == size) & (totals(self.len_b[b], n_b) == size)
        for _ in range(2):  # first the lengths, then the bytes of what has them
            a, b = a[np.repeat(right, n_a)], b[np.repeat(right, n_b)]
            raw, n_a, n_b, size = [r for r, ok in zip(raw, right.tolist()) if ok], n_a[right], n_b[right], size[right]
            if _ == 0:
                alive = right
                data = np.frombuffer(b"".join(raw), dtype=np.uint8)
                same = (self.a.blob[bpe.gather(self.a.begins[a], self.a.lengths[a])] == data) & (self.blob_b[bpe.gather(self.begin_b[b], self.len_b[b])] == data)
                right = totals(same.astype(np.int64), size) == size
        alive = alive.copy()
        alive[np.flatnonzero(alive)[~right]] = False
        end_a, end_b, end = np.cumsum(self.a.lengths[a]), np.cumsum(self.len_b[b]), np.cumsum(size)
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.searchsorted(end_a, common), np.searchsorted(end_b, common)
        link_a, link_b = a[last_a], b[last_b]
        fast = (np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1) & (self.image[link_a] == link_b)
        groups = np.diff(np.searchsorted(common, end, side="right"), prepend=0)
        n_fast = totals(fast.astype(np.int64), groups)
        text, cut = self.write(a, b, end_a, end_b, common, last_a, last_b, n_a + n_b)
        parts = iter([text[i:j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())])
        self.written += [next(parts) if ok else b"" for ok in alive.tolist()]
        counts, sizes = np.zeros((len(words), 4), dtype=np.int64), np.zeros((len(words), 2), dtype=np.int64)
        counts[alive] = np.stack((n_a, n_b, groups, np.ones(len(n_a), dtype=np.int64)), 1)
        sizes[alive] = np.stack((n_fast, groups - n_fast), 1)
        self.counts, self.sizes = np.concatenate((self.counts, counts)), np.concatenate((self.sizes, sizes))
        self.fast = np.concatenate((self.fast, link_a[fast]))
        self.odd = np.concatenate((self.odd, link_a[~fast] * self.size_b + link_b[~fast]))

    def write(self, a, b, end_a, end_b, common, last_a, last_b, tokens) -> tuple[bytes, np.ndarray]:
        """`a1,a2|b1;a3|b2,b3;` of all units, A's tokens of a group before B's, and where each unit begins and ends."""
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        at_a = np.arange(len(a)) + np.concatenate(([0], last_b + 1))[group_a]
        at_b = np.arange(len(b)) + (last_a + 1)[group_b]
        out = np.zeros((len(a) + len(b), max(self.text_a[0].shape[1], self.text_b[0].shape[1])), dtype=np.uint8)
        for ids, at, last, tables in ((a, at_a, last_a, self.text_a), (b, at_b, last_b, self.text_b)):
            width = tables[0].shape[1]
            out[at, :width] = tables[0][ids]
            out[at[last], :width] = tables[1][ids[last]]
        filled = np.concatenate(([0], np.cumsum(np.count_nonzero(out, axis=1))))
        flat = out.ravel()
        return flat[flat != 0].tobytes(), filled[np.concatenate(([0], np.cumsum(tokens)))]

    def links(self, texts: list[str]) -> Iterator[tuple]:
        """n_a, n_b, n_groups, digest, A ids of fast links, keys of the other links of each text."""
        none = np.zeros(0, dtype=np.int64)
        if len(self.known) > UNITS or self.known.chars > UNIT_CHARS:
            self.forget()
        rows = [list(map(self.known.__getitem__, units(t))) if t else [] for t in texts]
        for i, j in bpe.slices([len(w) for w in self.known.new], CHARS_AT_ONCE // 3):  # a third bounds the arrays of `learn`
            self.learn(self.known.new[i:j])
        self.known.new.clear()
        begins = np.cumsum(self.sizes, axis=0) - self.sizes
        for row in rows:
            at = np.array(row, dtype=np.int64)
            n_a, n_b, groups, right = self.counts[at].sum(axis=0).tolist()
            if not row or right < len(row):
                yield 0, 0, 0, "", none, none
                continue
            digest = hashlib.sha256(b"".join([self.written[i] for i in row])[:-1]).hexdigest()
            fast, odd = (flat[bpe.gather(begins[at, k], self.sizes[at, k])] for k, flat in enumerate((self.fast, self.odd)))
            yield n_a, n_b, groups, digest, fast, odd


def totals(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of so many values."""
    ends = np.cumsum(counts)
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[ends] - sums[ends - counts]


def images(a: bpe.Model, b: Pieces) -> np.ndarray:
    """For each A id the B id of the same bytes, -1 where there is none; a piece goes before a single byte."""
    where = {p: i for i, p in enumerate(b.bytes) if b.model.is_byte(i)} | {b.bytes[i]: i for i in reversed(b.plain)}
    raw = a.blob.tobytes()
    return np.array([where.get(raw[s : s + n], -1) for s, n in zip(a.begins.tolist(), a.lengths.tolist())], dtype=np.int64)


_aligners: dict[str, Aligner] = {}


def aligner_of(vocabulary: str, proto: bytes) -> Aligner:
    key = hashlib.md5(vocabulary.encode() + proto).hexdigest()
    if key not in _aligners:
        _aligners[key] = Aligner(vocabulary, proto)
    return _aligners[key]


LINKS = "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, fast binary, keys array<long>, times array<int>"


def find_links(docs: DataFrame, files) -> DataFrame:
    """Encodes each text once; `row` numbers the rows by task."""
    def make(batch: pa.RecordBatch) -> Iterator[list]:
        aligner = aligner_of(*files.value)
        ids, texts = batch.column("doc_id"), batch.column("text")
        for i, j in bpe.slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), CHARS_AT_ONCE):
            found = list(aligner.links([t or "" for t in texts.slice(i, j - i).to_pylist()]))
            n_a, n_b, n_groups, digest, fast, odd = zip(*found)
            pairs = [np.unique(k, return_counts=True) for k in odd]
            yield [ids.slice(i, j - i), n_a, n_b, n_groups, digest, [np.sort(x).astype("<i4").tobytes() for x in fast], [k for k, _ in pairs], [c.astype(np.int32) for _, c in pairs]]

    found = map_columns(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), LINKS.removeprefix("row long, "), make)
    return found.withColumn("row", F.monotonically_increasing_id()).select(*[c.split()[0] for c in LINKS.split(", ")])


def count_pairs(links: DataFrame, image: np.ndarray, size_b: int) -> DataFrame:
    """(key, n) of every pair: vectors of the fast links, one per task, and the shuffled pairs of the others."""
    size_a = len(image)

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size_a, dtype=np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(x, dtype="<i4"), minlength=size_a)
        a = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(a * size_b + image[a]), pa.array(total[a])], names=["key", "n"])

    fast = links.select("fast").mapInArrow(vector, "key long, n long")
    odd = links.select(F.explode(F.arrays_zip("keys", "times")).alias("p")).select(F.col("p.keys").alias("key"), F.col("p.times").cast("long").alias("n"))
    return fast.unionByName(odd).groupBy("key").agg(F.sum("n").alias("n"))


def numbers(df: DataFrame) -> list[np.ndarray]:
    """The columns of a small table of longs, rows in the order of the first."""
    t = df.toArrow()
    order = np.argsort(t.column(0).to_numpy(), kind="stable")
    return [c.to_numpy().astype(np.int64)[order] for c in t.columns]


def align(docs: DataFrame, byte_bpe: str, pieces: str, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row."""
    spark = docs.sparkSession
    with open(byte_bpe, encoding="utf-8") as f, open(pieces, "rb") as g:
        vocabulary, proto = f.read(), g.read()
    a, b = bpe.model_of(vocabulary, special=False), Pieces(proto)  # refuses a file it can't follow before any task starts
    image, size_b = images(a, b), len(b.bytes)
    files = spark.sparkContext.broadcast((vocabulary, proto))  # two files of fixed size
    links = cut_lineage(find_links(docs, files), "links")
    pairs = cut_lineage(count_pairs(links, image, size_b), "pairs")
    total = pairs.agg(F.sum("n")).first()[0] or 0
    rare = F.col("n") <= total // frequent
    own = small_table(spark, [(int(i) * size_b + int(image[i]),) for i in np.flatnonzero(image >= 0)], "key long")
    identity = numbers(pairs.join(own, "key", "left_semi"))
    heavy = numbers(pairs.filter(~rare))
    highest = pairs.groupBy((F.col("key") % size_b).alias("b")).agg(F.max("n").alias("n"))
    top = np.zeros(size_b, dtype=np.int64)
    for_b = numbers(highest)
    top[for_b[0]] = for_b[1]
    of_a = np.zeros(len(image), dtype=np.int64)
    of_a[identity[0] // size_b] = identity[1]
    known = spark.sparkContext.broadcast((of_a, top, image, *heavy))  # lengths of the vocabularies, and fewer than `frequent` pairs

    def score(batch: pa.RecordBatch) -> Iterator[list]:
        of_a, top, image, keys, counts = known.value
        is_best = (of_a == top[image]) & (image >= 0)
        best, total_, rare_keys, rare_times = [], [], [], []
        for fast, k, t in zip(*(batch.column(c).to_pylist() for c in ("fast", "keys", "times"))):
            x, k, t = np.frombuffer(fast, dtype="<i4"), np.array(k, dtype=np.int64), np.array(t, dtype=np.int64)
            n = np.zeros(len(k), dtype=np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                n = np.where(keys[at] == k, counts[at], 0)
            best.append(int(is_best[x].sum()) + int(t[(n > 0) & (n == top[k % size_b])].sum()))
            total_.append(int(of_a[x].sum()) + int((n * t).sum()))
            rare_keys.append(k[n == 0])
            rare_times.append(t[n == 0].astype(np.int32))
        yield [*(batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")), best, total_, rare_keys, rare_times]

    scored = cut_lineage(map_columns(links, "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, best long, total long, keys array<long>, times array<int>", score), "scored")
    counted = pairs.filter(rare).join(highest.select("b", F.col("n").alias("top")), F.col("key") % size_b == F.col("b")).select("key", "n", (F.col("n") == F.col("top")).alias("is_best"))
    rest = scored.select("row", F.explode(F.arrays_zip("keys", "times")).alias("p")).select("row", F.col("p.keys").alias("key"), F.col("p.times").cast("long").alias("t"))
    sums = rest.join(counted, "key").groupBy("row").agg(F.sum(F.when(F.col("is_best"), F.col("t")).otherwise(0)).alias("more_best"), F.sum(F.col("t") * F.col("n")).alias("more"))
    return scored.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), (F.col("best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("total") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")
