import os

import numpy as np
import pytest
from helpers import ODD, documents

from signalloom.llm import toxicity

SF = "/root/testdata/sf0.1"


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_documents(spark):
    from signalloom.llm.queries import op4_toxicity

    got = op4_toxicity(spark, SF)
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"), "doc_id").filter("held_out").toPandas()
    y, p = rows["toxic"].to_numpy(), rows["predicted"].to_numpy()
    assert auc(y, rows["score"].to_numpy()) > 0.93
    assert p[y == 1].mean() > 0.6 and p[y == 0].mean() < 0.03
    assert ((rows["score"] >= 0.7) == (rows["predicted"] == 1)).all()


def small(n=200):
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for k in range(n):
        w = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(40)]
        if k % 4 == 0:
            w[3] = w[20] = "scoundrel"
        texts.append(" ".join(w))
        labels.append(int(k % 4 == 0))
    return texts, labels


def test_misspellings_share_ngrams():
    model = toxicity.train(*small())
    clean = small(40)[0][1]
    bad = model.score(clean + " scoundrel scoundrel")
    assert bad > 0.7 > model.score(clean)
    assert model.score(clean + " scoundrell sc0undrel") > model.score(clean + " harmonies accordion") + 0.1


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(11)] + [(4, 1, None), (None, 1, 1), (4, 1, 1)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0), labels.filter("toxic = 1")):
        got = toxicity.report(docs, lab).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    none = toxicity.drop_toxic(docs, labels.limit(0))
    assert sorted(map(tuple, none.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    assert toxicity.report(documents(spark, []), labels).count() == 0
    assert toxicity.drop_toxic(documents(spark, []), labels).columns == docs.columns


def test_held_out_rule(spark):
    import zlib

    got = toxicity.report(documents(spark, [(i, "x") for i in range(50)]), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_like_a_dense_trainer():
    """Softmax regression on averaged embeddings with whole matrices."""
    texts, labels = small()
    model = toxicity.train(texts, labels)
    seen = np.zeros(toxicity.BUCKETS, dtype=int)
    for t in texts:
        seen[np.unique(toxicity.features(t))] += 1
    often = np.flatnonzero(seen >= toxicity.LEAST_TEXTS)
    x = np.zeros((len(texts), len(often)))
    for row, t in zip(x, texts):
        f = toxicity.features(t)
        row += np.bincount(f, minlength=toxicity.BUCKETS)[often] / len(f)
    y = np.eye(2)[labels]
    w = np.where(y[:, 1] == 1, toxicity.TOXIC_WEIGHT / y[:, 1].sum(), (1 - toxicity.TOXIC_WEIGHT) / y[:, 0].sum())[:, None]
    rng, n = np.random.default_rng(1), len(often)
    params = [rng.normal(0, 0.1, (n, toxicity.DIMENSIONS)), rng.normal(0, 0.1, (toxicity.DIMENSIONS, 2)), np.zeros(2)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for epoch in range(1, toxicity.EPOCHS + 1):
        table, soft, bias = params
        z = np.exp(x @ table @ soft + bias)
        g = (z / z.sum(axis=1, keepdims=True) - y) * w
        for p, d, m, v in zip(params, (x.T @ g @ soft.T + toxicity.DECAY / n * table, (x @ table).T @ g, g.sum(axis=0)), first, second):
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            p -= toxicity.STEP * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.999**epoch)) + 1e-10)
    table, soft, bias = params
    for t, row in zip(texts, x):
        z = row @ table @ soft + bias
        assert abs(model.score(t) - 1 / (1 + np.exp(z[0] - z[1]))) < 1e-3


def test_toxic_texts_of_any_length_train(spark):
    """Every toxic text is longer than most samples would like."""
    texts, labels = small(60)
    docs = documents(spark, [(i, (t + " ") * 400 if y else t) for i, (t, y) in enumerate(zip(texts, labels))])
    got = toxicity.sample(docs, spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels)], "doc_id long, quality int, toxic int")).collect()
    assert {r.toxic for r in got} == {0, 1} and max(len(r.text) for r in got) > 80_000
    assert toxicity.sample(docs, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_the_sample_is_bounded_by_characters(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_CHARS", 1_000)
    docs = documents(spark, [(i, "x" * 300) for i in range(100)])
    got = toxicity.sample(docs, spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")).collect()
    assert sorted(r.toxic for r in got) == [0] * 4 + [1] * 4  # the last one taken may cross the bound
