import hashlib
import math
import random
import re

import pytest
from helpers import ODD, documents

from signalloom.llm import simhash

xxhash = pytest.importorskip("xxhash")


def term_hash(words, first=None):
    h = 42
    if first is not None:
        h = xxhash.xxh64_intdigest(first.to_bytes(4, "little"), seed=h)
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=h)
    return h


def fingerprint(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t) or [t]
    votes = [[0] * 64, [0] * 64]
    for i in range(len(w)):
        term = w[i : i + 2]
        weight = max(1, min(8, sum(map(len, term)) // 3))
        for v, h in zip(votes, (term_hash(term), term_hash(term, 1))):
            for b in range(64):
                v[b] += weight if h >> b & 1 else -weight
    return "".join("%016x" % sum(1 << b for b in range(64) if v[b] > 0) for v in votes)


def like(a, b):
    return max(0.0, math.cos(math.pi * bin(int(a, 16) ^ int(b, 16)).count("1") / 128))


def expected(rows):
    rows = [(i, t or "") for i, t in rows]
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        fp, ed, nx = map(fingerprint, (t, e, nxt))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fp, ed, round(like(fp, ed), 9), round(like(fp, nx), 9)))
    return sorted(out, key=str)


def columns(df):
    return sorted(((*tuple(r)[:5], round(r[5], 9), round(r[6], 9)) for r in df.collect()), key=str)


def test_like_brute_force(spark):
    rng = random.Random(2)
    rows = [(i * 7 + 100, " ".join(rng.choice(["ab", "the", "élan", "x-y", "wordy", "longerword"]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [(5000 + i, rows[3][1]) for i in range(5)]
    got = simhash.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert columns(got) == expected(rows)


def test_odd_rows(spark):
    rows = [r for r in ODD if r[0] is not None]
    once = sorted(set(rows), key=lambda r: r[0])
    assert columns(simhash.report(documents(spark, rows))) == expected(once)
    assert simhash.report(documents(spark, ODD)).filter("doc_id is null").count() == 2
    assert simhash.report(documents(spark, [])).count() == 0
    assert columns(simhash.report(documents(spark, [(1, "a b c")]))) == expected([(1, "a b c")])


def test_tables_find_all_within_the_radius(spark):
    rng = random.Random(4)
    seeds = [rng.getrandbits(128) for _ in range(20)]
    points = {s ^ sum(1 << b for b in rng.sample(range(128), k)) for s in seeds for k in range(0, 11) for _ in range(6)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(p >> 64), signed(p & (1 << 64) - 1)) for p in points]
    df = spark.createDataFrame(rows + rows[:50], "fp_a long, fp_b long")
    asked = spark.createDataFrame(rows[::5], "fp_a long, fp_b long")
    number = lambda a, b: (a % (1 << 64)) << 64 | b % (1 << 64)
    got = sorted((number(r.q_a, r.q_b), number(r.fp_a, r.fp_b), r.dist) for r in simhash.within_radius(asked, df).collect())
    want = sorted((q, p, bin(q ^ p).count("1")) for q in (number(*r) for r in rows[::5]) for p in points if bin(q ^ p).count("1") <= simhash.RADIUS)
    assert got == want and len(want) > len(rows[::5])
    with pytest.raises(ValueError):
        simhash.within_radius(asked, df, simhash.RADIUS + 1)


def test_near_counts(spark):
    rows = [(100, "a b c d e f"), (101, "a b c d e f"), (102, "zz yy xx"), (200, "q")]
    got = {r.doc_id: r.n_near for r in simhash.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {100: 1, 101: None, 102: None, 200: 0}


def broadcast_rows(df):
    """Rows of every broadcast of a frame that was run."""
    out, nodes = [], [df._jdf.queryExecution().executedPlan()]
    while nodes:
        n = nodes.pop()
        name = n.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(n.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes.append(n.plan())
        else:
            if name == "BroadcastExchangeExec":
                out.append(n.metrics().apply("numOutputRows").value())
            nodes += [n.children().apply(k) for k in range(n.children().size())]
    return out


def test_only_the_queries_are_broadcast(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["ab", "the", "élan", "wordy", "longer"]) for _ in range(30))) for i in range(1, 1001)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    tables = len(list(simhash.combinations(range(simhash.BLOCKS), simhash.EQUAL_BLOCKS)))
    got = simhash.report(df)
    first = columns(got)
    near = sorted((r.doc_id, r.n_near) for r in got.collect() if r.n_near is not None)
    asked = len(near)
    assert asked == 10 and sorted(broadcast_rows(got))[-1] == asked * tables
    assert sum(broadcast_rows(got)) <= asked * tables + 2 * asked
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", asked * tables - 1)
    shuffled = simhash.report(df)
    assert columns(shuffled) == first and max(broadcast_rows(shuffled), default=0) <= asked
    assert sorted((r.doc_id, r.n_near) for r in shuffled.collect() if r.n_near is not None) == near
