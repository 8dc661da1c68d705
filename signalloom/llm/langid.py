"""Language of web pages by Bayesian fusion of evidence (operator 2).

log P(language | page) adds up
* the text: hashed byte n-grams of the main text under smoothed multinomials, learned from labelled documents;
  n-grams overlap, so their sum counts by `TEMPER`;
* the declared markup language and the language segment of the path: P(value | language) from grouped soft counts;
* the host: a prior smoothed along host -> domain -> address suffix -> all pages. Each level adds `STRENGTH`
  pseudo-pages of the level above. Counts are sums of text posteriors by grouped aggregation, combined before the
  shuffle; a page's own share is taken out of its prior, so that no evidence counts twice.

No group is gathered. Hosts with more than 1 in `HOT` of all pages, fewer than `HOT`, come back to their pages by
broadcast, the others by an equi-join in which no key is hot. The text model is fitted on at most `TRAIN_ROWS`
documents of each language, those first by a hash of the id; their n-grams are counted where they lie, so no
text is too long to take part.

Defined results: a null page has no text and no declaration, a null address an empty host: the remaining evidence
decides; of equal posteriors the language first in the alphabet wins; each input row gives one row; without
labelled documents the language is null; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from signalloom.llm.arrow import map_columns
from signalloom.llm.html_text import main_text
from signalloom.llm.sampling import first_by_hash
from signalloom.llm.words import FOLD, U, mix, window_hashes
from signalloom.session import cut_lineage

TRAIN_ROWS = 400
HOT = 1_000
BUCKETS = 1 << 16
GRAMS = (1, 2, 3, 4)
SMOOTH = 0.5
TEMPER = 0.1
STRENGTH = 2.0
DECLARED = re.compile(r"<html\b[^>]*?\b(?:xml:)?lang\s*=\s*[\"']?\s*([A-Za-z]{2,3})(?![A-Za-z])|<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?\s*([A-Za-z]{2,3})(?![A-Za-z])", re.I)


def buckets(text: str) -> np.ndarray:
    data = FOLD[np.frombuffer(f" {text} ".encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    h = mix(data.astype(U) + U(1))
    return np.concatenate([window_hashes(h, n) & U(BUCKETS - 1) for n in GRAMS]).astype(np.int64)


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log P(n-gram | language)): from a bounded sample."""
    d = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    chosen = first_by_hash(d.select("doc_id", "lang").distinct(), "lang", "doc_id", TRAIN_ROWS)

    def count(batch: pa.RecordBatch) -> Iterator[list]:
        sums: dict[str, np.ndarray] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            sums[lang] = sums.get(lang, 0) + np.bincount(buckets(text), minlength=BUCKETS)
        for lang, n in sums.items():
            u = np.flatnonzero(n)
            yield [[lang] * len(u), pa.array(u), pa.array(n[u])]

    counts = map_columns(d.join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "text"), "lang string, bucket long, n long", count)
    rows = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS for a language
    langs = sorted(rows["lang"].unique())
    table = np.full((BUCKETS, len(langs)), SMOOTH)
    for k, lang in enumerate(langs):
        some = rows[rows["lang"] == lang]
        table[some["bucket"], k] += some["n"]
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def evidence(pages: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """(page_id, url, declared, logs): the declared language and the tempered log likelihood of the text under each language."""
    broadcast = pages.sparkSession.sparkContext.broadcast(table)  # BUCKETS x languages, whatever the input

    def make(batch: pa.RecordBatch) -> Iterator[list]:
        model = broadcast.value
        declared, logs = [], []
        for html in batch.column("html").to_pylist():
            m = DECLARED.search(html or "")
            declared.append((m.group(1) or m.group(2)).lower() if m else None)
            text = main_text(html)
            logs.append((model[buckets(text)].sum(axis=0, dtype=np.float64) * TEMPER).tolist() if text else [0.0] * len(langs))
        yield [batch.column("page_id"), batch.column("url"), declared, logs]

    typed = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_columns(typed, "page_id long, url string, declared string, logs array<double>", make)


def normal(logs: list[Column]) -> list[Column]:
    """Posteriors from log scores."""
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    parts = [F.exp(x - top) for x in logs]
    return [p / sum(parts) for p in parts]


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, url, lang, posterior, text_lang, declared, host, prior: one row per page."""
    langs, table = fit(docs)
    if not langs:
        none = F.lit(None)
        return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), none.cast("string").alias("lang"), none.cast("double").alias("posterior"),
                            none.cast("string").alias("text_lang"), none.cast("string").alias("declared"), none.cast("string").alias("host"), none.cast("double").alias("prior"))
    ks = range(len(langs))
    e = evidence(pages, langs, table)
    url = F.coalesce("url", F.lit(""))
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), r"^www\.", "")
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([A-Za-z]{2,3})(?:[/?#]|$)", 1))
    e = e.withColumn("host", host).withColumn("suffix", F.substring_index("host", ".", -1)).withColumn("domain", F.substring_index("host", ".", -2))
    e = e.withColumn("said", F.when(F.col("declared").isNull(), "none").when(F.col("declared").isin(langs), F.col("declared")).otherwise("other"))
    e = e.withColumn("path", F.when(path.isin(langs), path).otherwise("none"))
    logs = [F.element_at("logs", k + 1) for k in ks]
    e = e.select("page_id", "url", "declared", "said", "path", "host", "domain", "suffix", *[x.alias(f"t{k}") for k, x in zip(ks, logs)])
    e = e.select("*", *[p.alias(f"p{k}") for k, p in zip(ks, normal([F.col(f"t{k}") for k in ks]))])
    e = cut_lineage(e, "evidence")

    def sums(by: list[str], tag: str) -> DataFrame:
        return e.groupBy(*by).agg(F.count("*").alias(f"n_{tag}"), *[F.sum(f"p{k}").alias(f"{tag}{k}") for k in ks])

    whole = sums([], "all").first()
    base = [(whole[f"all{k}"] or 0.0) + 1 for k in ks]
    base = [x / sum(base) for x in base]
    said = {(r["said"], k): r[f"said{k}"] for r in sums(["said"], "said").collect() for k in ks}  # known languages, none, other
    paths = {(r["path"], k): r[f"path{k}"] for r in sums(["path"], "path").collect() for k in ks}

    def given(column: str, counts: dict) -> list[Column]:
        """log P(value | language), one pseudo-page for each value."""
        values = sorted({v for v, _ in counts})
        out = []
        for k in ks:
            total = sum(counts[v, k] for v in values) + len(values)
            c = F.lit(0.0)
            for v in values:
                c = F.when(F.col(column) == v, float(np.log((counts[v, k] + 1) / total))).otherwise(c)
            out.append(c)
        return out

    suffix, domain, hosts = sums(["suffix"], "s"), sums(["suffix", "domain"], "d"), sums(["suffix", "domain", "host"], "h")
    up = hosts.join(domain, ["suffix", "domain"]).join(suffix, "suffix")
    keys = ["suffix", "domain", "host"]
    hot = F.col("n_h") > (whole["n_all"] or 0) // HOT
    up = cut_lineage(up, "hosts")
    known = F.broadcast(up.filter(hot))  # fewer than HOT rows
    rows = e.join(known, keys).unionByName(e.join(known.select(*keys), keys, "left_anti").join(up.filter(~hot), keys))
    prior = [F.lit(b) for b in base]
    for tag in ("s", "d", "h"):
        prior = [(F.col(f"{tag}{k}") - F.col(f"p{k}") + STRENGTH * q) / (F.col(f"n_{tag}") - 1 + STRENGTH) for k, q in zip(ks, prior)]
    rows = rows.select("*", *[F.greatest(q, F.lit(1e-9)).alias(f"q{k}") for k, q in zip(ks, prior)])
    total = [F.col(f"t{k}") + F.log(f"q{k}") + a + b for k, a, b in zip(ks, given("said", said), given("path", paths))]
    rows = rows.select("*", *[p.alias(f"post{k}") for k, p in zip(ks, normal(total))])

    def best(tag: str) -> tuple[Column, Column, Column]:
        """The language, its score and its prior."""
        name, most, q = F.lit(langs[0]), F.col(f"{tag}0"), F.col("q0")
        for k in ks[1:]:
            more = F.col(f"{tag}{k}") > most
            name, q, most = F.when(more, langs[k]).otherwise(name), F.when(more, F.col(f"q{k}")).otherwise(q), F.greatest(most, F.col(f"{tag}{k}"))
        return name, most, q

    lang, posterior, q = best("post")
    return rows.select("page_id", "url", lang.alias("lang"), posterior.alias("posterior"), best("p")[0].alias("text_lang"), "declared", "host", q.alias("prior"))
