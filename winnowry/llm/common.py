"""Helpers that the operators of this subpackage share: shared scratch tables, input adapters, sizing."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import ARROW_BYTES, ARROW_ROWS, BROADCAST_BYTES, Scratch, among, delete, shared_dir
from ..scratch import small_batches as tuned

__all__ = ["ARROW_BYTES", "ARROW_ROWS", "BROADCAST_BYTES", "Scratch", "among", "delete", "shared_dir", "tuned"]

def lean(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function of a mapInArrow, after which the worker gives memory it has freed back to the machine."""

    @wraps(task)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            import pyarrow as pa

            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # no glibc, nothing to trim
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id as long and text, a null text as the empty one; columns besides these are left out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
