"""Seeded reservoir sampling in closed form, and other deterministic samples.

Algorithm R fills slots 0 to k - 1 with the first k rows and lets row i replace the slot floor(u_i * i) if that is
under k.  With u_i a stable function of i, the slot of every row is known without the rows before it, and the row that
a slot ends with is the last one sent to it: one aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.hashing import stable_float
from ..scratch import Scratch


def with_ordinal(rows: DataFrame, order: str = "seq", name: str = "i", parts: int | None = None) -> DataFrame:
    """Adds the 1-based place of each row in the order of a unique column.

    Rows are put in ranges; a range's first place follows from the sizes of those before it (one number for each
    partition), so no task sees all rows.
    """
    spark = rows.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = Scratch(spark, "ordinal").table(rows.repartitionByRange(n, order).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("_part").count()
    before = sizes.select("_part", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    # one row for each partition
    return ranged.join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + within).cast("long")).drop("_part", "_before")


def slot(i: Column, capacity: int, seed: int) -> Column:
    """The slot of row i (from 1), whether or not it is one of the ``capacity``."""
    u = stable_float("reservoir", seed, i)
    return F.when(i <= capacity, i - 1).otherwise(F.floor(u * i)).cast("long")


def reservoir(rows: DataFrame, capacity: int, seed: int = 42, ordinal: str = "i") -> DataFrame:
    """The rows that stay, with their slot."""
    sent = rows.withColumn("slot", slot(F.col(ordinal), capacity, seed)).filter(F.col("slot") < capacity)
    own = [c for c in rows.columns]
    last = sent.groupBy("slot").agg(F.max_by(F.struct(*own), ordinal).alias("r"))
    return last.select("slot", "r.*")


def offered(rows: DataFrame, capacity: int, take: int, seed: int = 42, ordinal: str = "i") -> DataFrame:
    """The first rows that had a slot when they came, even if they lost it later."""
    return rows.withColumn("slot", slot(F.col(ordinal), capacity, seed)).filter(F.col("slot") < capacity).orderBy(ordinal).limit(take)


def smallest(rows: DataFrame, label: str, seed: int, take: int, pos: str = "pos") -> DataFrame:
    """The rows with the smallest stable number, ties in the order of ``pos``."""
    return rows.orderBy(stable_float(label, seed, F.col("id")), pos).limit(take)
