import os
import zlib

import numpy as np
import pytest
from helpers import BIG, LONG, ODD, documents

from signalloom.llm import quality

SF = "/root/testdata/sf0.01"


def voted(model, text):
    """The vote of one text, neighbour by neighbour."""
    z = np.sqrt(quality.bag(text).astype(float)) * model.weight
    if not z.any():
        return model.share
    z = z / np.linalg.norm(z) @ model.basis
    z /= np.linalg.norm(z)
    near = sorted(((float(z @ v), k) for k, v in enumerate(model.vectors)), reverse=True)
    last = near[min(quality.NEIGHBOURS, len(near)) - 1][0]
    yes = no = 0.0
    for c, k in near:
        if c >= last - quality.TIE:
            w = max(c, 0) ** 2 * float(model.says[k])
            yes, no = (yes + w, no) if model.labels[k] else (yes, no + w)
    return (yes + quality.PRIOR * model.share) / (yes + no + quality.PRIOR)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_accuracy_and_plain_votes(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality.report(docs, labels).collect()
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [(r.score, truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    good, bad = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97 and np.mean([p == y for _, y, p in held]) > 0.93 and np.mean([p for _, y, p in held if y]) > 0.97
    model = quality.fit(docs, labels)
    scores = {r.doc_id: r.score for r in got}
    for r in docs.collect():
        assert abs(scores[r.doc_id] - voted(model, r.text)) < 2e-3  # single precision beside double


def test_labels_of_the_fold_have_no_part(spark):
    docs = documents(spark, [(i, f"text number {i} " * 5) for i in range(60)])
    def fit(flip):
        return quality.fit(docs, spark.createDataFrame([(i, (i % 2) ^ (flip and zlib.crc32(str(i).encode()) % 4 == 2), "x") for i in range(60)], "doc_id long, quality int, text string"))
    a, b = fit(0), fit(1)
    assert np.array_equal(a.vectors, b.vectors) and np.array_equal(a.labels, b.labels) and a.share == b.share


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (4, 1, 0), (4, 0, 0), (6, 0, 0), (7, 0, 1), (8, 1, None), (BIG, 1, 0), (BIG, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.report(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert len({round(r.score, 5) for r in got if r.doc_id in (8, 9)}) == 1 and len({round(r.score, 5) for r in got if r.doc_id in (4, 5)}) == 1
    none = spark.createDataFrame([], labels.schema)
    assert {r.score for r in quality.report(docs, none).collect()} == {0.0}
    assert {r.score for r in quality.report(docs, labels.filter("quality = 1")).collect()} == {1.0}
    assert quality.report(documents(spark, []), labels).count() == 0
    assert quality.keep_good(docs, labels.filter("quality = 1")).columns == docs.columns


def test_texts_of_any_length_vote(spark):
    """All labelled texts of one class are very long."""
    docs = documents(spark, [(i, LONG + f" {i}" if i % 2 else f"short line {i}") for i in range(40)])
    model = quality.fit(docs, spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int"))
    assert model.score([LONG])[0] > 0.9 > 0.1 > model.score(["short line 99"])[0]
