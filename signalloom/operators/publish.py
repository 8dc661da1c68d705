"""Content-addressed publication of marts (X8): what did not change keeps its files and its stamp.

A run writes each table once to a path of its own, takes its fingerprint from what was written, and compares it
with the manifest in force. Tables with the same content keep the path and the stamp of the run that first
published them, and the new files go; the others point to the new files. The manifest is one small table per
version, written last and under a name that must not exist yet: readers see the old state or the new one, and
of two publishers of the same version one fails. Where nothing changed, no version is written.

The fingerprint is the number of rows, two sums of row hashes and the column names with their types: the order of
rows and their partitions have no part in it, repeated rows do.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from signalloom.session import remove_path, small_table

MANIFEST = "name string, path string, fingerprint string, records long, generated_at string"


def hashable(name: str, kind: T.DataType) -> Column:
    """A column that can be hashed; maps, which have no hash, become their sorted entries or JSON."""
    col = F.col(f"`{name}`")
    if isinstance(kind, T.MapType):
        return F.array_sort(F.map_entries(col)) if not isinstance(kind.valueType, (T.MapType, T.StructType, T.ArrayType)) else F.to_json(col)
    return F.to_json(F.struct(col)) if "map<" in kind.simpleString() or "variant" in kind.simpleString() else col


def fingerprint(df: DataFrame) -> tuple[str, int]:
    """(fingerprint, records) of a table."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    cols = [hashable(f.name, f.dataType) for f in fields]
    row = df.agg(F.count("*").alias("n"), *[F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2)]).first()
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in fields)
    return hashlib.sha256(f"{kinds}|{row['n']}|{row['h1']}|{row['h2']}".encode()).hexdigest(), row["n"]


def manifest(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """The version in force and its rows; version 0 is empty."""
    try:
        every = spark.read.schema(MANIFEST + ", version int").parquet(f"{root}/manifest")
        version = every.agg(F.max("version")).first()[0] or 0
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, spark.createDataFrame([], MANIFEST)
    return version, every.filter(F.col("version") == version).drop("version")


def publish(tables: dict[str, DataFrame], root: str, stamp: str) -> DataFrame:
    """Publish the tables of one mart; returns the manifest in force with `changed` for each table.

    A table that is no longer among `tables` leaves the manifest; its files stay for readers of older versions.
    """
    spark = next(iter(tables.values())).sparkSession
    version, rows = manifest(spark, root)
    before = {r["name"]: r for r in rows.collect()}  # a row per table of the mart
    out = []
    for name, df in tables.items():
        path = f"{root}/data/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        mark, records = fingerprint(spark.read.schema(df.schema).parquet(path))
        old = before.get(name)
        if old is not None and old["fingerprint"] == mark:
            remove_path(spark, path)
            out.append((name, old["path"], mark, records, old["generated_at"], False))
        else:
            out.append((name, path, mark, records, stamp, True))
    if any(r[-1] for r in out) or set(before) != set(tables):
        now = small_table(spark, [r[:-1] for r in out], MANIFEST)
        now.coalesce(1).write.mode("errorifexists").parquet(f"{root}/manifest/version={version + 1}")
    return small_table(spark, out, MANIFEST + ", changed boolean")


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the version in force."""
    row = manifest(spark, root)[1].filter(F.col("name") == name).first()
    if row is None:
        raise ValueError(f"nothing published as {name}")
    return spark.read.parquet(row["path"])
