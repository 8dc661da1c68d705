"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

_fallback_dir: str | None = None


def get_session(app: str = "signalloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def small_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Rule or dimension rows as a local relation: its size is known, so Catalyst decides on broadcast."""
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = fields.fieldNames()
    records = [r if isinstance(r, dict) else dict(zip(names, r)) for r in rows]
    arrow = pa.Table.from_pylist(records, schema=to_arrow_schema(fields))
    return spark.createDataFrame(arrow, fields)


def shared_dir(spark: SparkSession) -> str:
    """Folder the cluster names in spark.checkpoint.dir; a temporary one only for a local master where it is unset."""
    global _fallback_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _fallback_dir is None:
        _fallback_dir = tempfile.mkdtemp(prefix="spark-")
    return _fallback_dir


def write_shared(df: DataFrame, label: str = "stage") -> str:
    """Write `df` under a new name in the shared folder; returns the path."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return path


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    A written table survives executor loss, and its exact size lets Catalyst and AQE choose
    broadcast or shuffle joins from facts for the next step.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_shared(df, label))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written table through the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
