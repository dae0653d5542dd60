"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """id, label of every item of an edge (a, b): the least id that can be reached.

    Distributed union-find: each round links an item's greater neighbours to its least one, then does the same with
    its smaller ones, until nothing changes; a logarithmic number of rounds.  Every round is written, so that a lost
    executor costs a round's tasks and not the history.
    """

    def state(df: DataFrame) -> tuple:
        # the sum wraps around in either half alone, so it can't overflow
        h = F.xxhash64("u", "v")
        return tuple(df.agg(F.count("*"), F.sum(F.shiftright(h, 32)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))).first())

    now = scratch.table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), f"{name}-0")
    before, rounds = state(now), 0
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.table(large, f"{name}-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        rounds += 1
        now = scratch.table(small, f"{name}-{rounds}")
        scratch.drop(f"{name}-{rounds - 1}", collect=False)
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
