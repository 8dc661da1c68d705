"""Byte-level BPE encoding and decoding with a pair occurrence index (operator 7).

The pre-tokens of an Arrow batch that are new to the worker are laid out as one linked list of ids. An
index maps each adjacent pair to all its positions; the active ranks sit in a heap and are applied in
ascending order, each to all its positions at once, and only the lists of neighbouring pairs change.
Results are remembered per pre-token, up to `CACHE` of them or `CACHE_CHARS` characters per worker.

A worker holds the texts of at most `CHARS_AT_ONCE` characters, or one longer text, at a time, and cuts a long
text where a blank between a visible character and a letter begins a pre-token anyway.

Free style: the work on a row needs no other row, so it is a `mapInArrow` over the scan, without a
shuffle. A lost executor costs its own tasks. The vocabulary file is broadcast (one file of fixed size).

Nulls count as empty texts; an empty text has no tokens and decodes to an empty text. One row comes out
for each row that goes in, repeated ids and rows included; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from signalloom.llm.arrow import map_columns

CACHE = 400_000
CACHE_CHARS = 6_000_000
CHARS_AT_ONCE = 6_000_000
CHARS_PER_CUT = 250_000
MERGED_AT_ONCE = 1_500_000
# The pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary: itself, or the next one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(plain))
    return letters


def gather(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions begin..begin+count-1 of all ranges, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - counts), counts)


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about so much size: this bounds the memory of a worker."""
    begin = held = 0
    for i, n in enumerate(sizes):
        held += n
        if held >= most:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


_SAFE = regex.compile(r"(?<=\S)(?= [A-Za-z])")


def cuts(text: str, chars: int) -> list[str]:
    """The text in parts of about so many characters, cut only where a pre-token begins in any case."""
    out, begin = [], 0
    while len(text) - begin > chars:
        found = _SAFE.search(text, begin + chars)
        if not found:
            break
        out.append(text[begin : found.start()])
        begin = found.start()
    return [*out, text[begin:]]


class Numbers(dict):
    """Numbers pre-tokens in the order of their first sight; `new` has those not merged yet."""

    def __init__(self):
        self.new: list[str] = []
        self.chars = 0

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        self.chars += len(word)
        return n


_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """For each code point: 0 letter, 1 number, 2 white space, 3 anything else."""
    if not _classes:
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        table = np.full(0x110000, 3, dtype=np.uint8)
        for k, p in enumerate((r"\p{L}+", r"\p{N}+", r"\s+")):
            for m in regex.finditer(p, every):
                table[ord(m.group()[0]) : ord(m.group()[-1]) + 1] = k
        _classes.append(table)
    return _classes[0]


def pre_tokens(texts: list[str], known: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all texts' pre-tokens, cut as PATTERN does, and how many are before the end of each text.

    A pre-token is a run of one class, with one blank before it. Of white space before something else the
    last character stands alone, or is that blank. An apostrophe that begins a pre-token takes the letters
    of a contraction.
    """
    joined = "\n".join(texts) + "\n"
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    kind = classes()[chars]
    kind[ends - 1] = 4
    n = len(chars)
    start = np.ones(n + 1, dtype=bool)
    start[1:n] = kind[1:] != kind[:-1]
    change = np.flatnonzero(start[1:n]) + 1
    closing = change[(kind[change - 1] == 2) & (kind[change] != 4)]  # what follows white space in a text
    start[closing - 1] = True
    start[closing[chars[closing - 1] == 32]] = False
    quote = np.flatnonzero((chars[:-2] == 39) & (kind[1:-1] == 0)) if n > 2 else np.zeros(0, dtype=np.int64)
    quote = quote[start[quote]]
    one, two = chars[quote + 1], chars[quote + 2]
    size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
    for pair in ("re", "ve", "ll"):
        size[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
    quote, size = quote[size > 0], size[size > 0]
    start[quote + 1] = False
    start[quote + 1 + size] = True
    begins = np.flatnonzero(start)
    real = kind[begins[:-1]] != 4
    first, last = begins[:-1][real], begins[1:][real]
    found = np.fromiter((known[joined[i:j]] for i, j in zip(first.tolist(), last.tolist())), dtype=np.int64, count=len(first))
    return found, np.searchsorted(first, ends)


class Model:
    """Vocabulary, merge ranks and added tokens of a tokenizer file; without `special` added tokens are plain text."""

    def __init__(self, text: str, special: bool = True):
        spec = json.loads(text)
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"].get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("only byte-level BPE without a normalizer and prefix space is read")
        vocab = spec["model"]["vocab"]
        added = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec.get("added_tokens", [])):
            raise ValueError("added tokens that take in their surroundings are not read")
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        self.first = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int32)
        size = 1 + max([*vocab.values(), *added.values()])
        pieces = [b""] * size
        for token, i in vocab.items():
            pieces[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in added.items():
            pieces[i] = token.encode()
        self.lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        self.begins = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.blob = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.added = added = added if special else {}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.made: list[int] = []
        self.pair: list[tuple[int, int]] = []
        born: dict[int, int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            pair, new = (vocab[a], vocab[b]), vocab[a + b]
            if max(born.get(pair[0], -1), born.get(pair[1], -1)) >= r or new in born:
                raise ValueError("a merge uses a token that a later merge makes")
            born[new] = r
            self.pair.append(pair)
            self.made.append(new)
        self.width = size
        self.made = np.array(self.made, dtype=np.int32)
        keys = np.array([a * size + b for a, b in self.pair], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.key_rank = keys[order], order
        self.forget()

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where no merge has it or one side is no token."""
        keys = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.key_rank[at], -1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pre-tokens, one after the other, and their number in each.

        One linked list holds all pre-tokens, parted by -1. `where` is the pair occurrence index: for each
        active rank the positions at which its pair was seen.
        """
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        sizes = np.array([len(w) for w in raw], dtype=np.int64)
        n = len(data) + len(raw)
        ids = np.full(n + 1, -1, dtype=np.int32)
        word = np.repeat(np.arange(len(raw)), sizes)
        ids[np.arange(len(data)) + word] = self.first[data]
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        where: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            found = self.ranks_of(ids[at], ids[after[at]])
            at, found = at[found >= 0], found[found >= 0]
            if len(at):
                order = np.argsort(found, kind="stable")
                at, found = at[order], found[order]
                cuts = np.flatnonzero(np.diff(found)) + 1
                for r, some in zip(found[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts)):
                    if r not in where:
                        where[r] = []
                        heapq.heappush(active, r)
                    where[r].append(some)

        note(np.arange(n))
        while active:
            r = heapq.heappop(active)
            (a, b), some = self.pair[r], where.pop(r)
            p = np.concatenate(some) if len(some) > 1 else some[0]
            p = np.sort(p[(ids[p] == a) & (ids[after[p]] == b)])
            p = p[np.diff(p, prepend=-1) > 0]
            if a == b:  # of overlapping pairs the left one is merged
                kept, last = [], -1
                for x in p.tolist():
                    if x != last:
                        kept.append(x)
                        last = after[x]
                p = np.array(kept, dtype=np.int64)
            if not len(p):
                continue
            q = after[p]
            s = after[q]
            ids[p], ids[q] = self.made[r], -2
            after[p], before[s] = s, p
            left = before[p]
            note(np.concatenate((left[left >= 0], p)))
        whole = ids[:n]
        last = np.cumsum(sizes + 1) - 1
        return whole[whole >= 0], np.diff(np.concatenate(([0], np.cumsum(whole >= 0)[last])))

    def forget(self) -> None:
        """Empties the memory of pre-tokens; the added tokens stay."""
        self.known = Numbers()
        for t in self.added:
            self.known[t]
        self.known.new.clear()
        self.flat = np.array(list(self.added.values()), dtype=np.int32)
        self.count = np.ones(len(self.added), dtype=np.int64)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if len(self.known) > CACHE or self.known.chars > CACHE_CHARS:
            self.forget()
        known, index, pieces = self.known, [], []
        for t in texts:
            some = [s for s in self.split.split(t) if s] if self.split and self.split.search(t) else [t]
            pieces.append([c for s in some for c in ([s] if s in self.added else cuts(s, CHARS_PER_CUT))])
        plain = [s for some in pieces for s in some if s not in self.added]
        for i, j in slices([len(s) for s in plain], CHARS_PER_CUT):
            found, ends = pre_tokens(plain[i:j], known)
            index += np.split(found.astype(np.int32), ends[:-1])
        if known.new:
            parts = [(self.flat, self.count)]
            parts += [self.merge(known.new[i:j]) for i, j in slices([len(w) for w in known.new], MERGED_AT_ONCE)]
            known.new.clear()
            self.flat, self.count = (np.concatenate(x) for x in zip(*parts))
        begins = np.cumsum(self.count) - self.count
        parts = iter(index)
        for some in pieces:
            at = np.concatenate([np.array([known[s]]) if s in self.added else next(parts) for s in some])
            yield self.flat[gather(begins[at], self.count[at])]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and their number in each; nothing is remembered. For many short
        texts without added tokens in them."""
        known = Numbers()
        at, ends = pre_tokens(texts, known)
        flat, count = self.merge(known.new)
        sums = np.concatenate(([0], np.cumsum(count[at])))
        return flat[gather((np.cumsum(count) - count)[at], count[at])], np.diff(np.concatenate(([0], sums[ends])))

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return self.blob[gather(self.begins[ids], self.lengths[ids])].tobytes().decode("utf-8", "replace")


_models: dict[tuple[str, bool], Model] = {}


def model_of(text: str, special: bool = True) -> Model:
    key = hashlib.md5(text.encode()).hexdigest(), special
    if key not in _models:
        _models[key] = Model(text, special)
    return _models[key]


def _vocabulary(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:
        text = f.read()
    model_of(text)  # refuses a file it can't follow before any task starts
    return df.sparkSession.sparkContext.broadcast(text)


def _rows(df: DataFrame, path: str, schema: str, make) -> DataFrame:
    vocabulary = _vocabulary(df, path)

    def run(batch: pa.RecordBatch) -> Iterator[list]:
        model = model_of(vocabulary.value)
        ids, texts = batch.column("doc_id"), batch.column("text")
        for i, j in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), CHARS_AT_ONCE):
            yield [ids.slice(i, j - i), *make(model, [t or "" for t in texts.slice(i, j - i).to_pylist()])]

    return map_columns(df.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), schema, run)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of each row."""
    def make(model: Model, texts: list[str]) -> list:
        found = list(model.encode(texts))
        ends = np.cumsum([0, *(len(x) for x in found)], dtype=np.int32)
        return [pa.ListArray.from_arrays(ends, np.concatenate([x.astype(np.int32) for x in found]))]

    return _rows(docs, path, "doc_id long, ids array<int>", make)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""
    vocabulary = _vocabulary(tokens, path)

    def run(batch: pa.RecordBatch) -> Iterator[list]:
        model = model_of(vocabulary.value)
        yield [batch.column("doc_id"), [model.decode(np.asarray(x or [], dtype=np.int64)) for x in batch.column("ids").to_pylist()]]

    return map_columns(tokens.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")), "doc_id long, text string", run)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, then decoded from the ids, in one pass."""
    def make(model: Model, texts: list[str]) -> list[list]:
        n, encoded, decoded = [], [], []
        for found in model.encode(texts):
            n.append(len(found))
            encoded.append(hashlib.sha256(",".join(map(str, found.tolist())).encode()).hexdigest())
            decoded.append(hashlib.sha256(model.decode(found).encode()).hexdigest())
        return [n, encoded, decoded]

    return _rows(docs, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
