"""Exact deduplication by two keys, in the order of a stream.

A row is a duplicate by id if an accepted row before it has its id, by text if one has its text; a row that is turned
away registers neither key.  So two windows won't do: a row whose only forerunner was itself turned away stays.

In parallel: among rows that are undecided, one that is first both for its id and for its text is accepted, and all
others with its id or text are decided by it.  Rounds go on until none is left; a few suffice, as every round decides
all rows of the keys it touches.  If ids are unique, one aggregation by text is exact and no round is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from ..settings import DEDUP_BACKENDS


def open_dedup(backend: str = "memory"):
    """The operator by a backend's name.  All names stand for the same one: shuffles spill to disk by themselves."""
    if backend not in DEDUP_BACKENDS:
        raise ValueError(f"no dedup backend {backend!r}; there are {', '.join(DEDUP_BACKENDS)}")
    return dedup


def unique_ids(rows: DataFrame) -> bool:
    return rows.groupBy("id").count().filter("count > 1").isEmpty()


def dedup_texts(rows: DataFrame) -> DataFrame:
    """The case of unique ids.  Adds ``duplicate``: null or duplicate_text.

    The first of each text is found by an aggregation that adds up before the shuffle, so a text held by a third of
    all rows is no hot key; the rows are joined to it, where Spark splits large keys.
    """
    first = rows.groupBy("text_hash").agg(F.min("seq").alias("_first"))
    return rows.join(first, "text_hash").withColumn("duplicate", F.when(F.col("seq") > F.col("_first"), F.lit("duplicate_text"))).drop("_first")


def dedup(rows: DataFrame, assume_unique_ids: bool | None = None) -> DataFrame:
    """Adds ``duplicate`` (null, duplicate_id, duplicate_text) to rows with seq (unique), id and text_hash."""
    if assume_unique_ids or (assume_unique_ids is None and unique_ids(rows)):
        return dedup_texts(rows)
    scratch = Scratch(rows.sparkSession, "dedup")
    left = scratch.table(rows.select("seq", "id", "text_hash"), "round0")
    accepted = None
    k = 0
    while not left.isEmpty():
        by_id = left.groupBy("id").agg(F.min("seq").alias("i"))
        by_text = left.groupBy("text_hash").agg(F.min("seq").alias("t"))
        won = left.join(by_id, "id").join(by_text, "text_hash").filter((F.col("seq") == F.col("i")) & (F.col("seq") == F.col("t"))).select("seq", "id", "text_hash")
        won = scratch.table(won, f"won{k}")
        accepted = won if accepted is None else accepted.unionByName(won)
        rest = left.join(won.select("id"), "id", "left_anti").join(won.select("text_hash"), "text_hash", "left_anti")
        k += 1
        left = scratch.table(rest.select("seq", "id", "text_hash"), f"round{k}")
    if accepted is None:
        return rows.withColumn("duplicate", F.lit(None).cast("string"))
    by_id = accepted.select("id", F.col("seq").alias("_by_id"))
    taken = accepted.select(F.col("seq").alias("_taken"))
    out = rows.join(by_id, "id", "left").join(taken, rows["seq"] == taken["_taken"], "left")
    why = F.when(F.col("_taken").isNotNull(), F.lit(None)).when(F.col("_by_id") < F.col("seq"), "duplicate_id").otherwise("duplicate_text")
    return out.withColumn("duplicate", why).drop("_by_id", "_taken")


def dedup_stats(decided: DataFrame) -> DataFrame:
    """One row: ids and texts registered, duplicates by id and by text."""
    kept = F.col("duplicate").isNull()
    return decided.agg(F.count_if(kept).alias("ids_retained"), F.count_if(kept).alias("hashes_retained"), F.count_if(F.col("duplicate") == "duplicate_id").alias("duplicate_ids"), F.count_if(F.col("duplicate") == "duplicate_text").alias("duplicate_texts"))
