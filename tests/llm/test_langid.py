import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import BIG

from signalloom.llm import langid

LANGS = {"en": "the and ing tion that with", "de": "der und ung schaft nicht für", "fr": "les et ment tion dans où é"}


def docs(spark, n=40):
    rng = random.Random(1)
    rows = [(k * 3 + j, " ".join(rng.choice(w.split()) + rng.choice(["", "s", "er"]) for _ in range(60)), lang) for k in range(n) for j, (lang, w) in enumerate(LANGS.items())]
    return spark.createDataFrame(rows + [(None, "x", "en"), (9999, None, "de"), (9998, "y", None)], "doc_id long, text string, lang string")


def pages(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for k in range(120):
        lang = list(LANGS)[k % 3]
        text = " ".join(rng.choice(LANGS[lang].split()) + rng.choice(["", "s", "er"]) for _ in range(0 if k % 7 == 0 else 30))
        declared = lang if k % 4 else "en"
        rows.append((k, f"https://www.{lang}{k % 5}.example.com/{k}", f'<html lang="{declared}-XX"><body><article><p>{text}</p></article></body></html>', "z", "z"))
        want[k] = lang
    return rows, want


SCHEMA = "page_id long, url string, html string, host string, p0 string"


def test_evidence_decides(spark):
    rows, want = pages(spark)
    got = langid.identify(spark.createDataFrame(rows, SCHEMA), docs(spark)).collect()
    right = [r.lang == want[r.page_id] for r in got]
    assert len(got) == 120 and sum(right) >= 117
    empty = [r for r in got if r.page_id % 7 == 0]
    assert sum(r.lang == want[r.page_id] for r in empty) >= len(empty) - 2  # no text: host and declaration
    assert all(0 <= r.posterior <= 1 for r in got)


def test_odd_rows(spark):
    rows = [(None, None, None, "a", "b"), (1, "no address", "", "a", "b"), (1, "no address", "", "a", "b"), (BIG, "http://h.example.org/fr/x", "<p>und der schaft nicht", "a", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = langid.identify(df, docs(spark)).collect()
    assert len(got) == 4 and all(r.lang in LANGS for r in got)
    assert {r.page_id for r in got} == {None, 1, BIG}
    close = spark.createDataFrame([(BIG, "a", "<p>und der"), (BIG + 2, "b", "<p>und der"), (None, "c", "<p>und")], "page_id long, url string, html string")
    assert {r.page_id for r in langid.identify(close, docs(spark)).collect()} == {None, BIG, BIG + 2}
    assert langid.identify(df, docs(spark).limit(0)).filter("lang is null").count() == 4
    assert langid.identify(df.limit(0), docs(spark)).count() == 0


SF = "/root/testdata/sf0.001"


def posterior(rows, langs, table):
    """Page by page, with every sum of the other pages taken anew."""
    pages = []
    for url, html in rows:
        text = langid.main_text(html)
        logs = [float(table[langid.buckets(text), k].sum(dtype=np.float64)) * langid.TEMPER if text else 0.0 for k in range(len(langs))]
        top = max(logs)
        p = [math.exp(x - top) for x in logs]
        p = [x / sum(p) for x in p]
        host, _, rest = (url or "").partition("://")[2].partition("/")
        host = host.split("@")[-1].split(":")[0].split("?")[0].lower().removeprefix("www.")
        segment = rest.split("?")[0].split("#")[0].split("/")[0].lower()
        m = langid.DECLARED.search(html or "")
        said = (m.group(1) or m.group(2)).lower() if m else "none"
        pages.append((logs, p, host, ".".join(host.split(".")[-2:]), host.split(".")[-1], said if said in [*langs, "none"] else "other", segment if segment in langs else "none"))
    ks = range(len(langs))
    whole = [sum(x[1][k] for x in pages) + 1 for k in ks]
    base = [x / sum(whole) for x in whole]
    levels = []
    for at in ((4,), (3, 4), (2, 3, 4)):
        sums, count = defaultdict(lambda: [0.0] * len(langs)), Counter()
        for x in pages:
            key = tuple(x[i] for i in at)
            count[key] += 1
            sums[key] = [s + q for s, q in zip(sums[key], x[1])]
        levels.append((at, sums, count))

    def given(at):
        sums = defaultdict(lambda: [0.0] * len(langs))
        for x in pages:
            sums[x[at]] = [s + q for s, q in zip(sums[x[at]], x[1])]
        totals = [sum(v[k] for v in sums.values()) + len(sums) for k in ks]
        return {v: [math.log((s[k] + 1) / totals[k]) for k in ks] for v, s in sums.items()}

    said, path = given(5), given(6)
    out = []
    for x in pages:
        prior = base
        for at, sums, count in levels:
            key = tuple(x[i] for i in at)
            prior = [(sums[key][k] - x[1][k] + langid.STRENGTH * prior[k]) / (count[key] - 1 + langid.STRENGTH) for k in ks]
        z = [x[0][k] + math.log(max(prior[k], 1e-9)) + said[x[5]][k] + path[x[6]][k] for k in ks]
        top = max(z)
        e = [math.exp(v - top) for v in z]
        out.append((langs[max(ks, key=lambda k: (e[k], -k))], max(e) / sum(e)))
    return out


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("hot", [langid.HOT, 20])
def test_every_page_against_plain_sums(spark, monkeypatch, hot):
    monkeypatch.setattr(langid, "HOT", hot)
    pages, texts = spark.read.parquet(f"{SF}/pages.parquet"), spark.read.parquet(f"{SF}/documents.parquet")
    langs, table = langid.fit(texts)
    rows = pages.collect()
    got = {r.page_id: (r.lang, r.posterior) for r in langid.identify(pages, texts).collect()}
    assert len(got) == len(rows)
    for r, (lang, most) in zip(rows, posterior([(r.url, r.html) for r in rows], langs, table)):
        assert got[r.page_id][0] == lang and abs(got[r.page_id][1] - most) < 1e-6
