"""The half of curation that looks at one row at a time, over a stream.

Cleaning, rules and splits need no state.  Exact deduplication and the sample depend on the order of all rows and stay
in batch: a watermark's dropDuplicates would decide otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.hashing import split_of
from ..plans.decisions import inspected
from ..settings import Settings


def screened(rows: DataFrame, settings: Settings) -> DataFrame:
    """id, domain, text (cleaned), text_hash, reason, split of a stream (or a table) with id, domain, text."""
    made = inspected(rows, settings)
    return made.select("id", "domain", "text", "text_hash", "reason", F.when(F.col("reason").isNull(), split_of(F.col("id"), settings.seed, settings.train_ratio, settings.val_ratio)).alias("split"))


def write_screened(rows: DataFrame, path: str, checkpoint: str, settings: Settings) -> StreamingQuery:
    """Append what is kept to Parquet by split, once each, and stop when the source is used up."""
    kept = screened(rows, settings).filter("reason is null").drop("reason")
    return kept.writeStream.format("parquet").partitionBy("split").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
