import hashlib
import random

import pytest
from helpers import BIG, ODD, documents

from signalloom.llm import bpe
from signalloom.llm.queries import TOKENIZER

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(TOKENIZER)


def texts():
    rng = random.Random(3)
    alphabet = list("ab'stredvlm  \n\t19é!.　") + ["<|endoftext|>", "日", "🙂", "'ll", "\x85", "²"]
    return ["", " ", "aaaaaaaaa", "x" * 3000] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]


def test_encodes_and_decodes_as_the_library(spark, library):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in rows}
    got = bpe.encode(docs, TOKENIZER)
    assert {r.doc_id: r.ids for r in got.collect()} == want
    back = {r.doc_id: r.text for r in bpe.decode(got, TOKENIZER).collect()}
    assert back == {i: library.decode(w, skip_special_tokens=False) for i, w in want.items()} == dict(rows)


def test_decoding_cut_characters(spark, library):
    rows = [(k, [random.Random(k).randrange(50257) for _ in range(20)]) for k in range(200)] + [(-1, None), (-2, [])]
    got = {r.doc_id: r.text for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), TOKENIZER).collect()}
    assert got == {k: library.decode(ids or [], skip_special_tokens=False) for k, ids in rows}


def test_odd_rows(spark, library):
    got = bpe.digests(documents(spark, ODD), TOKENIZER).collect()
    want = []
    for i, t in ODD:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert BIG in [r.doc_id for r in got]
    assert bpe.digests(documents(spark, []), TOKENIZER).count() == 0


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    model = bpe.Model(open(TOKENIZER, encoding="utf-8").read())
    for t in texts():
        assert next(iter(model.encode([t]))).tolist() == library.encode(t, add_special_tokens=False).ids
    assert len(model.known) < 150
