"""A corpus pipeline of five corpus operators: what each stage decides takes effect for the next one.

toxicity: documents scored toxic go. near_dedup: of each class of near copies the first document stays.
decontamination: documents with a benchmark window go. pii: personal data is replaced in the text.
bpe: the ids of what is left. All stages but the last return the columns of `documents`.

Null ids, null texts, repeated rows, extra columns and empty tables are treated as each operator's docstring
says; a table of documents without rows gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from signalloom.llm import bpe, decontam, minhash, pii, toxicity
from signalloom.llm.queries import TOKENIZER, table
from signalloom.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier learns from labelled rows of the given documents."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_documents(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n_chars follows the redacted text where the table has such a column."""
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids: what a trainer reads."""
    ids = bpe.encode(docs, TOKENIZER)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("pii", redact),
    ("bpe", tokenize),
]

ORACLE_SQL = None  # the trained classifier has no SQL form; tests hold the stages against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs, name)
    return docs
