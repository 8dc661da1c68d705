import hashlib
import random

from helpers import BIG, LONG, ODD, documents

from signalloom.llm import substrings


def brute(rows):
    """Windows seen at a smaller id remove their words."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        if i is not None:
            for k in range(len(w) - 49):
                key = tuple(w[k : k + 50])
                first[key] = min(first.get(key, i), i)
    out = set()
    for i, w in split:
        off = set()
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k : k + 50])] < i:
                off |= set(range(k, k + 50))
        kept = b" ".join(x for k, x in enumerate(w) if k not in off)
        out.add((i, len(w), len(off), hashlib.sha256(kept).hexdigest()))
    return out


def test_cover_has_every_difference():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))


def test_like_brute_force(spark):
    rng = random.Random(9)
    word = lambda: f"v{rng.randrange(10**6)}"
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 64, 90, 140)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += [word() for _ in range(rng.randint(0, 40))]
            if rng.random() < 0.6:
                p = rng.choice(passages)
                a = rng.randint(0, 20)
                parts += p[a : a + rng.randint(40, 140)]
        rows.append((i * 3, rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(1000 + i, rows[5][1]) for i in range(9)] + [(2000, "again " * 300), (2001, "again " * 70), (2002, "once " * 200)]
    got = {tuple(r) for r in substrings.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 500


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    got = {tuple(r) for r in substrings.report(docs).collect()}
    assert got == brute(ODD)
    assert substrings.report(documents(spark, [])).count() == 0
    cut = substrings.cut_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(ODD)
    text = {r.doc_id: r.text for r in cut.collect()}
    assert text[8] == LONG and text[9] == "" and text[BIG] == "end"
