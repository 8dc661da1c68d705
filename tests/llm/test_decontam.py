import hashlib
import random
import re

import pytest
from helpers import BIG, ODD, documents, plain

from signalloom.llm import decontam

UP = str.maketrans(decontam.UPPER, decontam.LOWER)


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UP))


def brute(docs, items):
    out = set()
    wins = [(str(i), words(t)) for i, t in items]
    wins = [(i, w[k : k + min(10, len(w))]) for i, w in wins for k in range(len(w) - min(10, len(w)) + 1) if w]
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for i, ws in wins:
            for k in range(len(w) - len(ws) + 1):
                if w[k : k + len(ws)] == ws:
                    hit |= set(range(k, k + len(ws)))
                    ids.add(i)
        out.add((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def case(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(["a", "B", "c", "É", "é", "d-e", "9"]) for _ in range(n))
    items = [(i, text(rng.choice([3, 9, 10, 12, 14]))) for i in range(12)] + [(99, None), (98, "..."), (3, "a b")]
    docs = [(i, text(rng.randint(0, 40)) + (items[i % 12][1] or "") * (i % 3 == 0)) for i in range(40)]
    return docs, items


@pytest.mark.parametrize("limit", [decontam.BROADCAST_WINDOWS, 0])
def test_like_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", limit)
    docs, items = case(1)
    got = decontam.report(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)


def test_odd_rows_and_empty_tables(spark):
    docs, bench = documents(spark, ODD), spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"), (2, "ONE")], "item_id long, text string")
    got = decontam.report(docs, bench).collect()
    assert sorted(map(tuple, got), key=str) == brute(ODD, [(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"), (2, "ONE")])
    assert decontam.report(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontam.report(docs.limit(0), bench).count() == 0


def test_removal(spark):
    docs, bench = documents(spark, ODD), spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"), (2, "one")], "item_id long, text string")
    left = decontam.drop_documents(docs, bench)
    assert left.columns == docs.columns
    assert plain(left.collect(), "doc_id", "text") == plain([dict(doc_id=i, text=t) for i, t in ODD if i not in (4, 5, 8, 9, BIG)], "doc_id", "text")
    cut = {r.doc_id: r.text for r in decontam.cut_spans(documents(spark, [(1, "x, One: y one"), (2, "twone"), (3, None)]), bench).collect()}
    assert cut == {1: "x, y ", 2: "twone", 3: None}


def test_removal_from_a_long_text(spark):
    """20 000 words, many hits: each word and its gap is read once."""
    words = [f"v{i}" for i in range(20_000)]
    for k in range(100, 20_000, 200):
        words[k : k + 10] = [f"b{j}" for j in range(10)]
    text = ", ".join(words) + "."
    bench = spark.createDataFrame([(1, " ".join(f"b{j}" for j in range(10)))], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontam.cut_spans(documents(spark, [(1, text), (2, text[:500])]), bench).collect()}
    left = [w for w in words if not w.startswith("b")]
    assert got[1] == "".join(w + (", " if w != words[-1] else ".") for w in left) and got[2] == text[:500]
