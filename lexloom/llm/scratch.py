"""Tables written to the shared folder, to cut lineage between the steps of an iterative operator.

The folder is the one the cluster names in ``spark.checkpoint.dir``; only where that is unset (tests, a single machine) is a
default used. A lost executor then costs the recomputation of one step at most.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_DIR = "/tmp/checkpoints"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's folder; the default only where driver and executors are one process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return named or DEFAULT_DIR


class Scratch:
    """Names, writes and drops the tables of one operator's run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, f"{shared_dir(spark).rstrip('/')}/lexloom-{name}-{uuid.uuid4().hex[:12]}"
        self._n, self._paths = 0, {}
        path = spark._jvm.org.apache.hadoop.fs.Path(self.base)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)

    def write(self, df: DataFrame) -> DataFrame:
        """df, computed once and read from a table; the shuffle files that it took are freed."""
        self._n += 1
        path, before = f"{self.base}/{self._n}", self.spark.conf.get(_CLEAN, "false")
        self.spark.conf.set(_CLEAN, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(_CLEAN, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for t in tables:
            _, path = self._paths.pop(id(t), (None, None))
            if path:
                p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Python workers get at most so many rows at a time, since texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))
