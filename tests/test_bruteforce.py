"""Set-based rewrites against plain loops on random fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from signalloom.operators import dedup, graph
from signalloom.session import small_table


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_event_duplicates(spark, seed):
    rnd = random.Random(seed)
    day = 86400
    rows = []
    for i in range(120):
        hot = rnd.random() < 0.33      # one title holds a third of the rows
        rows.append((f"i{i:03d}", rnd.choice([None, f"e{rnd.randrange(40)}"]), rnd.choice([None, f"u{rnd.randrange(50)}"]),
                     "hot" if hot else rnd.choice([None, f"t{rnd.randrange(15)}"]), rnd.randrange(0, 60 * day), rnd.randrange(5)))
    order = sorted(rows, key=lambda r: (r[5], r[0]))
    kept, want = [], {}
    for r in order:
        dup = next((k[0] for k in kept if (r[1] and r[1] == k[1]) or (r[2] and r[2] == k[2]) or (r[3] and r[3] == k[3] and abs(r[4] - k[4]) <= 7 * day)), None)
        if dup:
            want[r[0]] = dup
        else:
            kept.append(r)
    df = small_table(spark, rows, "id string, event_key string, url_key string, title_key string, s long, p int").select(
        "id", "event_key", "url_key", "title_key", F.timestamp_seconds("s").alias("ts"), F.struct("p", "id").alias("rank"))
    accepted, rejected = dedup.greedy_event_duplicates(df)
    assert {r.id for r in accepted.collect()} == {k[0] for k in kept}
    assert {r.id: r.duplicate_of for r in rejected.collect()} == want


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    n = 150
    edges = [(f"v{rnd.randrange(n):03d}", f"v{rnd.randrange(n):03d}") for _ in range(90)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(70)] + [("hub", f"h{i:02d}") for i in range(40)]
    names = sorted({x for e in edges for x in e} | {"alone"})
    parent = {x: x for x in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = graph.connected_components(small_table(spark, [(x,) for x in names], "id string"), small_table(spark, edges, "left_id string, right_id string"))
    assert {r.id: r.component for r in got.collect()} == {x: find(x) for x in names}


@pytest.mark.parametrize("seed", [1, 2])
def test_distinct_clusters(spark, seed):
    rnd = random.Random(seed)
    base = [sorted(rnd.sample(range(40), rnd.randrange(2, 14))) for _ in range(25)]
    sets = []
    for i in range(120):
        s = set(rnd.choice(base))
        if rnd.random() < 0.6:
            s.add(rnd.randrange(40))
        if rnd.random() < 0.4 and len(s) > 2:
            s.discard(rnd.choice(sorted(s)))
        sets.append((f"c{i:03d}", [f"d{x:02d}" for x in sorted(s)]))
    kept = []
    for c in sorted(sets, key=lambda c: (-len(c[1]), c[0])):
        if not any(len(set(c[1]) & set(k[1])) / len(set(c[1]) | set(k[1])) >= 0.8 for k in kept):
            kept.append(c)
    df = small_table(spark, sets, "id string, evidence_ids array<string>")
    got = graph.distinct_clusters(df, [-F.size("evidence_ids"), F.col("id")])
    assert [r.id for r in got.collect()] == [k[0] for k in kept]


@pytest.mark.parametrize("seed", [1, 2])
def test_collapse_titles(spark, seed):
    rnd = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    rows = []
    for _ in range(60):
        t = " ".join(rnd.choice(words) for _ in range(rnd.randrange(3, 8)))
        for _ in range(rnd.randrange(1, 4)):
            a, b = rnd.randrange(0, 6), rnd.randrange(0, 6)
            rows.append((rnd.choice("xy"), t[a:len(t) - b], rnd.random() < 0.2))
    want = {}
    for g in "xy":
        kept = []
        for r in sorted([r for r in rows if r[0] == g], key=lambda r: (-len(r[1]), r[1])):
            home = next((k for k in kept if (r[1] in k[0] or k[0] in r[1]) and min(len(r[1]), len(k[0])) / max(len(r[1]), len(k[0])) >= 0.7), None)
            if home:
                home[1] += 1
                home[2] |= r[2]
            else:
                kept.append([r[1], 1, r[2]])
        want |= {(g, k[0]): (k[1], k[2]) for k in kept}
    got = dedup.collapse_titles(small_table(spark, rows, "g string, title string, sponsored boolean"), ["g"])
    assert {(r.g, r.title): (r.duplicate_count, r.sponsor_seen) for r in got.collect()} == want


@pytest.mark.parametrize("ratio", [0.3, 0.7, 1.0])
def test_contained_titles(spark, ratio):
    rnd = random.Random(7)
    texts = [("xy"[i % 2], "".join(rnd.choice(["a", "b", "aa ", "model ", "größe "]) for _ in range(rnd.randrange(0, 40)))) for i in range(40)]
    texts += [("x", "a" * n) for n in (1, 2, 3, 30, 31, 40)] + [("y", ("ab" * 300)[:n]) for n in (500, 510, 599)]
    rows = sorted({(g, t[a:len(t) - b]) for g, t in texts for a in range(0, 9, 4) for b in (0, 1, 6, 15)} | {(None, "a" * 30)}, key=str)
    want = sorted((g, t, u) for g, t in rows for h, u in rows if g and g == h and t and t != u and t in u and len(t) >= ratio * len(u) - 1e-9)
    got = dedup.contained_titles(small_table(spark, rows, "g string, t string"), ["g"], ratio)
    assert sorted(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_coherent_core(spark, seed):
    rnd = random.Random(seed)
    docs = [(f"c{c}", f"d{c}{i}", f"s{rnd.randrange(4)}") for c in range(6) for i in range(rnd.randrange(2, 9))]
    feats = sorted({(c, d, s, f"f{rnd.randrange(9)}") for c, d, s in docs for _ in range(rnd.randrange(0, 3))})
    want = set()
    for c in sorted({d[0] for d in docs}):
        ids = [d[1] for d in docs if d[0] == c]
        source = {d[1]: d[2] for d in docs}
        groups = [{x} for x in ids]
        for f in {x[3] for x in feats if x[0] == c}:
            who = {x[1] for x in feats if x[0] == c and x[3] == f}
            if len(who) >= 2:
                hit = [g for g in groups if g & who]
                groups = [g for g in groups if not g & who] + [set().union(*hit)]
        ok = [g for g in groups if len(g) >= 2 and len({source[x] for x in g}) >= 2]
        if ok:
            best = sorted(ok, key=lambda g: (-len({source[x] for x in g}), -len(g), sorted(g)))[0]
            want |= {(c, x) for x in best}
    core, _ = graph.coherent_core(small_table(spark, docs, "component string, evidence_id string, source_id string"),
                                  small_table(spark, feats, "component string, evidence_id string, source_id string, feature string"))
    assert {(r.component, r.evidence_id) for r in core.collect()} == want
