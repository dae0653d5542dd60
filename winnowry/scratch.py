"""Tables written to the folder that all executors share; they cut lineage and outlive lost executors."""

from __future__ import annotations

import atexit
import contextlib
import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows, and bytes, in an Arrow batch handed to Python: texts may be long, so a batch holds few of them.
ARROW_ROWS, ARROW_BYTES = 512, 8 << 20
#: Keys are broadcast up to this size, at 32 bytes each.
BROADCAST_BYTES = 32 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, as whole texts go to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def among(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows whose ``on`` is in ``keys`` (distinct, a written table): by broadcast if their size allows, else by a shuffle."""
    if keys.count() * 32 <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    return rows.join(keys, on, "left_semi")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Where it is unset the session's checkpoint folder is used; where there is none either, a new temporary one in
    local mode, where all share the machine.  On a cluster a folder must be set.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="winnowry-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir() or found
    return found.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of a Hadoop file system, if the session still runs."""
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Tables written to the shared folder, which cut lineage and outlive lost executors.

    ``drop`` removes those that nothing later reads; what remains goes when the driver's Python ends.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.base = spark, f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
        atexit.register(delete, spark, self.base)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def table(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        df.write.mode("overwrite").option("compression", compression).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str, collect: bool = True) -> None:
        for name in names:
            delete(self.spark, self.path(name))
        if not collect:
            return
        gc.collect()
        # Spark frees the shuffle files of finished jobs when the JVM has collected their handles.
        self.spark.sparkContext._jvm.System.gc()
