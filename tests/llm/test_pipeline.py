
import os

import pytest
from helpers import ODD, documents

import corpus_pipeline
from signalloom.llm import bpe, toxicity
from signalloom.llm.queries import QUERIES, TOKENIZER

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages_against_plain_versions(spark):
    """Each stage on what the one before kept; the plain versions work on lists of rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = toxicity.fit(docs, labels)
    rows = {i: t for i, t in rows.items() if model.score(t) < toxicity.THRESHOLD}
    from test_minhash import brute

    classes = brute(sorted(rows.items()))
    rows = {i: t for i, t in rows.items() if classes[i] == i}
    from test_decontam import brute as hits

    hit = {r[0] for r in hits(sorted(rows.items()), [(r.item_id, r.text) for r in bench.collect()]) if r[5]}
    rows = {i: t for i, t in rows.items() if i not in hit}
    from test_pii import base

    def clean(t):
        out, at = "", 0
        for s, _, kind, e in base(t):
            if s >= at:
                out += t[at:s] + f"[{kind.upper()}]"
            at = max(at, e)
        return out + t[at:]

    want = {i: next(iter(bpe.model_of(open(TOKENIZER, encoding="utf-8").read()).encode([clean(t)]))).tolist() for i, t in rows.items()}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 0 < len(want) < docs.count()


def test_odd_rows_and_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    for rows, name in ((ODD, "odd"), ([], "none")):
        d = f"{sf}/{name}"
        documents(spark, rows).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        docs = spark.read.parquet(f"{d}/documents.parquet")
        for title, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, d)
            assert docs.columns == documents(spark, []).columns, title
        assert corpus_pipeline.run(spark, d).count() == (10 if rows else 0)

