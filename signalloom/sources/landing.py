"""Landed files: JSON lines, snapshots, receipts, sanitized imports, marts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.errors import AnalysisException

from signalloom.functions import constants as C, text as X
from signalloom.operators import quality as Q
from signalloom.session import cut_lineage, small_table

EVIDENCE = (
    "id string, source_id string, source_type string, title string, url string, published_at string, summary string, "
    "authors array<string>, tags array<string>, projects array<string>, event_ids array<string>, "
    "artifact_urls array<string>, sponsor_status string, metadata map<string,string>")
RECEIPT = (
    "collected_at string, items int, added int, errors array<string>, "
    "collectors array<struct<source_id:string,status:string,items:int,error:string>>")


def read_jsonl(spark: SparkSession, path: str, schema: str = EVIDENCE) -> DataFrame:
    """JSON lines with a fixed schema; blank lines are skipped and a missing path reads as empty."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines with keys in sorted order."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def write_snapshot(df: DataFrame, path: str, day: Column) -> None:
    """One directory per day (S3); only the days at hand are replaced."""
    out = df.withColumn("snapshot_date", day)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


def read_receipts(spark: SparkSession, root: str, families: dict[str, str]) -> DataFrame:
    """Receipts of every family, with the directory that dates them."""
    out = None
    for family, name in families.items():
        try:
            r = spark.read.schema(RECEIPT).option("multiLine", True).json(f"{root}/*/{name}")
        except AnalysisException as err:
            if err.getCondition() == "PATH_NOT_FOUND":
                continue
            raise
        r = r.withColumn("snapshot", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)).withColumn("family", F.lit(family))
        out = r if out is None else out.unionByName(r)
    return out if out is not None else spark.createDataFrame([], RECEIPT + ", snapshot string, family string")


def sanitized_import(payload: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Split imported JSON records into clean and rejected.

    A record with a blocked or mailbox key is rejected; nothing is repaired.
    """
    keys = F.json_object_keys(column)
    banned = F.array(*[F.lit(k) for k in [*C.BLOCKED_KEYS, "body", "from", "to"]])
    bad = F.coalesce(F.arrays_overlap(keys, banned), F.lit(True))
    marked = payload.withColumn("_bad", bad)
    clean = marked.filter(~F.col("_bad")).select(*[c for c in payload.columns if c != column],
                                                 F.from_json(column, EVIDENCE).alias("r"))
    return clean.select(*[c for c in clean.columns if c != "r"], "r.*"), marked.filter("_bad").drop("_bad")


def _parts(path: Column, pattern: str) -> list[Column]:
    """Family and snapshot of a file by the named groups of a pattern."""
    where = re.compile(pattern).groupindex
    plain = pattern.replace("(?P<", "(?<")  # named groups as Spark's engine writes them
    return [F.regexp_extract(path, plain, where[name]).alias(name) for name in ("family", "snapshot")]


def newest_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(family, snapshot, path) of the files of the newest snapshot of each family.

    `pattern` finds both in a file's path by its groups `snapshot` and `family`. Only names are listed; no
    content is read.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "family string, snapshot string, path string")
        raise
    rows = files.select(*_parts(F.col("path"), pattern), "path").filter("family <> '' and snapshot <> ''")
    newest = rows.groupBy("family").agg(F.max("snapshot").alias("snapshot"))
    return rows.join(newest, ["family", "snapshot"])


def read_newest(spark: SparkSession, root: str, pattern: str, schema: str) -> DataFrame:
    """The JSON records of the newest snapshot of each family, with family and snapshot; older files are never opened.

    The paths of the newest snapshots go through the driver: there are as many as these have files.
    """
    paths = [r["path"] for r in newest_files(spark, root, pattern).select("path").collect()]
    if not paths:
        return spark.createDataFrame([], schema + ", family string, snapshot string")
    return spark.read.schema(schema).json(paths).select("*", *_parts(F.col("_metadata.file_path"), pattern))


LINKS = ("id string, platform string, post_url string, author_name string, author_url string, published_at string, observation string, "
         "event_ids array<string>, linked_urls array<string>, tags array<string>")


def reviewed_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Manually reviewed rows of a small configuration list."""
    return small_table(spark, rows, EVIDENCE)


def load_reviewed(spark: SparkSession, root: str, pattern: str, event_ids: list[str], platforms: dict[str, str],
                  prohibited: list[str]) -> tuple[DataFrame, DataFrame]:
    """Manually reviewed evidence and social links of the newest landed files.

    Families `items` (evidence rows) and `links`. Links that keep the contract (F9) become evidence; the others
    come back with their violations, a repeated id as `duplicate-id` on all but its first row by file order of
    its content hash.
    """
    items = read_newest(spark, root, pattern, EVIDENCE).filter("family = 'items'").drop("family", "snapshot")
    extra = ", ".join(f"{p} string" for p in prohibited)
    raw = read_newest(spark, root, pattern, f"{LINKS}, {extra}" if extra else LINKS).filter("family = 'links'").drop("family", "snapshot")
    raw = cut_lineage(raw, "links")
    judged = Q.link_contract(raw, event_ids, prohibited)
    copies = Window.partitionBy("id").orderBy(F.xxhash64(*raw.columns))
    again = (F.col("id").isNotNull()) & (F.row_number().over(copies) > 1)
    judged = judged.withColumn("violations", F.when(again, F.array_append("violations", F.lit("duplicate-id"))).otherwise(F.col("violations")))
    good = judged.filter(F.size("violations") == 0)
    source = F.create_map(*[F.lit(v) for kv in platforms.items() for v in kv])
    platform, none = F.lower("platform"), F.array().cast("array<string>")
    events = F.array_distinct("event_ids")
    rows = good.select(
        "id", F.try_element_at(source, platform).alias("source_id"), F.lit("curated-social").alias("source_type"), X.compact(F.col("observation")).alias("title"),
        F.col("post_url").alias("url"), "published_at", F.lit("Observation by an analyst, linked to the public post.").alias("summary"), F.array("author_name").alias("authors"),
        F.concat(F.array(platform, F.lit("event-observation")), F.coalesce("tags", none)).alias("tags"), none.alias("projects"), events.alias("event_ids"),
        F.filter(F.coalesce("linked_urls", none), lambda u: u.startswith("https://")).alias("artifact_urls"), F.lit("unknown").alias("sponsor_status"),
        F.create_map(F.lit("event_id"), F.get(events, F.lit(0)), F.lit("event_record_type"), F.lit("observation"), F.lit("platform"), platform,
                     F.lit("author_url"), F.coalesce("author_url", F.lit(""))).alias("metadata"))
    return items.unionByName(rows), judged.filter(F.size("violations") > 0).select("id", "violations")


def write_mart(df: DataFrame, key: str, path: str) -> DataFrame:
    """Write a mart only when no row breaks the privacy rules; returns the violations.

    The rows are computed once, to a table beside; the check and the mart read that table.
    """
    staged = cut_lineage(df, "mart")
    found = Q.privacy_violations(staged, key, Q.text_columns(staged))
    if found.isEmpty():
        staged.write.mode("overwrite").parquet(path)
    return found
