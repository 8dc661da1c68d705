import random

import numpy as np
import pytest
from helpers import BIG, LONG, ODD, documents

from signalloom.llm import minhash


def brute(rows):
    """Class of each id: components of the graph of similar texts; copies by their words."""
    first, own = {}, {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        h, c, key = minhash.shingles(t)
        first.setdefault(key, (i, (h, c)))
        own.setdefault(i, first[key][0])
    reps = list(first.values())
    parent = {i: i for i, _ in reps}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(reps):
        for j, b in reps[:k]:
            if minhash.similarity(a, b) >= 0.8:
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return {i: top(c) for i, c in own.items()}


def families(seed):
    """Chains of copies of copies, a group of loose near copies, copies, and texts that only share a passage."""
    rng = random.Random(seed)
    word = lambda: f"v{rng.randrange(10**6)}"
    rows, n = [], 0

    def add(words):
        nonlocal n
        n += rng.randint(1, 3)
        rows.append((n, " ".join(words)))

    for _ in range(6):
        w = [word() for _ in range(150)]
        for _ in range(8):
            add(w)
            w = list(w)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = word()
    base = [word() for _ in range(150)]
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(150)] = word()
        add(w)
    for _ in range(20):
        add(base[:60] + [word() for _ in range(90)])
    rows += [(10_000 + k, rows[3][1].upper()) for k in range(30)] + [(20_000 + k, f"tiny text {k % 3}") for k in range(9)]
    rows += [(30_000 + k, "same line again and again. " * (20 + k)) for k in range(4)]
    return rows


@pytest.mark.parametrize("block", [minhash.BLOCK, 7])
def test_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = families(1)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    want = brute(rows)
    assert got == want and len(set(want.values())) < len(rows) - 100


def test_similarity_is_the_probability_jaccard_index():
    rng = np.random.default_rng(3)
    for _ in range(100):
        a, b = (np.unique(rng.integers(0, 25, 12)).astype(np.uint64) for _ in range(2))
        ca, cb = rng.integers(1, 5, len(a)), rng.integers(1, 5, len(b))
        x, y = dict(zip(a.tolist(), ca.tolist())), dict(zip(b.tolist(), cb.tolist()))
        want = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x | y) for d in x.keys() & y.keys())
        assert abs(minhash.similarity((a, ca), (b, cb)) - want) < 1e-9


def test_signatures_estimate_it():
    rng = np.random.default_rng(1)
    for weighted in (False, True):
        miss = []
        for _ in range(60):
            h = rng.integers(0, 2**63, 500).astype(np.uint64)
            a, b = np.sort(h[:400]), np.sort(h[100:])
            ca, cb = (rng.integers(1, 4 if weighted else 2, 400) for _ in range(2))
            miss.append((minhash.signature(a, ca) == minhash.signature(b, cb)).mean() - minhash.similarity((a, ca), (b, cb)))
        assert abs(np.mean(miss)) < 0.03 and np.std(miss) < 0.08


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == brute(ODD) and got[BIG] == 8
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    out = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert out == sorted([(None, None), (None, "alone"), (1, None), (3, "   \n\t "), (4, "one"), (4, "one"), (6, "!!!"), (7, "a" * 30_000), (8, LONG), (10, ODD[-1][1])], key=str)
    assert minhash.near_duplicates(documents(spark, [])).count() == 0
    assert minhash.keep_first(documents(spark, [])).count() == 0


@pytest.mark.parametrize("turn", [False, True])
def test_ids_with_several_texts(spark, turn):
    a, b, c = (" ".join(f"{x}{i}" for i in range(150)) for x in "abc")
    rows = [(2, a), (5, a), (5, b), (7, b), (9, b + " end"), (11, c), (11, a + " end"), (12, c + " end")]
    df = spark.createDataFrame(rows[::-1] if turn else rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.copy_of) for r in minhash.near_duplicates(df).collect()}
    assert got == {2: (2, 2), 5: (2, 2), 7: (5, 5), 9: (5, 9), 11: got[11], 12: (11, 12)}
    assert got[11] in {(2, 11), (11, 11)}
    assert sorted(map(tuple, minhash.keep_first(df).collect())) == [(2, a), (5, b), (11, c)]
