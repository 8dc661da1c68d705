"""A durable keyed table for streams (ST2): bucketed files, and a commit record for each batch.

A batch rewrites only the buckets its keys fall in, to paths of its own, and then commits by one small file that
must not exist yet. The newest commit of a bucket says where its rows are. A batch that was committed before is
not applied again, so a replay changes nothing; one that failed before its commit left files that nothing points to.
All state is in the folder: a restarted job goes on where the last commit left it.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from signalloom.session import small_table

COMMITS = "batch long, bucket int, path string"


class KeyedTable:
    """Newest row of each key; `order` decides what is newest, of equal ones the stored row stays."""

    def __init__(self, spark: SparkSession, root: str, key: str, order: str, schema: str, buckets: int = 64):
        self.spark, self.root, self.key, self.order, self.schema, self.buckets = spark, root.rstrip("/"), key, order, schema, buckets

    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMITS)

    def applied(self, batch: int) -> bool:
        return not self.commits().filter(F.col("batch") == batch).isEmpty()

    def _paths(self, buckets: list[int] | None = None) -> list[str]:
        """Where the rows of the buckets are now, one folder for each."""
        rows = self.commits()
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(buckets))
        newest = rows.groupBy("bucket").agg(F.max_by("path", "batch").alias("path"))
        return [f"{r['path']}/bucket={r['bucket']}" for r in newest.collect()]

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        return self._read(self._paths())

    def _newest(self, df: DataFrame, *then: str) -> DataFrame:
        columns = [c for c in df.columns if c not in then]
        rank = F.struct(self.order, *then)
        return df.groupBy(self.key).agg(F.max_by(F.struct(*columns), rank).alias("r")).select("r.*")

    def merge(self, rows: DataFrame, batch: int) -> bool:
        """Apply a batch; False where it was applied before."""
        if self.applied(batch):
            return False
        names = self.spark.createDataFrame([], self.schema).columns
        new = self._newest(rows.select(*names)).withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
        path = f"{self.root}/data/{batch}-{uuid.uuid4().hex}"
        new.write.partitionBy("bucket").parquet(path + "-new")
        landed = self.spark.read.schema(self.schema + ", bucket int").parquet(path + "-new")
        touched = [r[0] for r in landed.select("bucket").distinct().collect()]  # at most `buckets`
        both = self._read(self._paths(touched)).withColumn("_stored", F.lit(1)).unionByName(landed.select(*names).withColumn("_stored", F.lit(0)))
        merged = self._newest(both, "_stored").withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
        merged.write.partitionBy("bucket").parquet(path)
        log = small_table(self.spark, [(batch, b, path) for b in touched], COMMITS)
        log.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/commits/part={batch}")
        return True
