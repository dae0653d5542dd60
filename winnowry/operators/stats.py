"""Counts and summaries over decided documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import REASONS, SPLITS


def _every(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """A count for each of a closed set of values, 0 where there is none; in the set's order."""
    # rows of the plan itself: a list given to createDataFrame starts Python workers
    dim = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(v) for v in values])).alias("place", column))
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return dim.join(counts, column, "left").orderBy("place").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def removal_counts(decided: DataFrame) -> DataFrame:
    return _every(decided, "reason", REASONS)


def split_counts(rows: DataFrame) -> DataFrame:
    return _every(rows, "split", SPLITS)


def length_summary(rows: DataFrame, column: str = "character_count", compat_percentiles: bool = False) -> DataFrame:
    """count, min, max, mean, median, p90, p95, p99; nulls for no rows.

    ``compat_percentiles`` puts the 91st and 92nd percentile in the places of p95 and p99.
    """
    n = F.col(column)
    high = (0.91, 0.92) if compat_percentiles else (0.95, 0.99)
    return rows.agg(
        F.count(n).alias("count"), F.min(n).alias("min"), F.max(n).alias("max"), F.avg(n).alias("mean"), F.percentile(n, 0.5).alias("median"),
        F.percentile(n, 0.9).alias("p90"), F.percentile(n, high[0]).alias("p95"), F.percentile(n, high[1]).alias("p99"),
    )


def length_histogram(rows: DataFrame, column: str = "character_count", width: int = 1000, bins: int = 10) -> DataFrame:
    """bin, n: so many bins, the last one open, all of them present."""
    counts = rows.groupBy(F.least(F.floor(F.col(column) / width), F.lit(bins - 1)).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    return rows.sparkSession.range(bins).select(F.col("id").alias("bin")).join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def domain_distribution(decided: DataFrame) -> DataFrame:
    """domain, inspected, accepted."""
    return decided.groupBy("domain").agg(F.count("*").alias("inspected"), F.count_if(F.col("reason").isNull()).alias("accepted"))


def run_stats(decided: DataFrame) -> DataFrame:
    """One row: inspected = candidates + rejected, candidates = retained + sampled_out."""
    ok = F.col("reason").isNull()
    return decided.agg(
        F.count("*").alias("inspected"), F.count_if(ok).alias("candidates"), F.count_if(~ok).alias("rejected"), F.count_if(F.col("retained")).alias("retained"),
        (F.count_if(ok) - F.count_if(F.col("retained"))).alias("sampled_out"), F.count_if(F.col("reason").isin("duplicate_id", "duplicate_text")).alias("duplicates"),
    )


def uniqueness(rows: DataFrame) -> DataFrame:
    """For each split and for all: rows, and how many exceed the distinct ids and hashes."""
    # Per-split checks and the check across splits share one pass over (split, key) counts
    def excess(key: str):
        per = rows.groupBy("split", key).agg(F.count("*").alias("c"))
        within = per.groupBy("split").agg(F.sum("c").alias("rows"), (F.sum("c") - F.count("*")).alias(f"extra_{key}"))
        total = per.groupBy(key).agg(F.sum("c").alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("rows"), (F.coalesce(F.sum("c"), F.lit(0)) - F.count("*")).alias(f"extra_{key}")).select(F.lit("all").alias("split"), "rows", f"extra_{key}")
        return within.unionByName(total)

    return excess("id").join(excess("text_hash").drop("rows"), "split").select("split", "rows", F.col("extra_id").alias("extra_ids"), F.col("extra_text_hash").alias("extra_hashes"))


def rejected_examples(decided: DataFrame, take: int = 20) -> DataFrame:
    """The first rows of each reason but duplicates, in stream order."""
    from pyspark.sql.window import Window

    bad = decided.filter(F.col("reason").isNotNull() & ~F.col("reason").isin("duplicate_id", "duplicate_text"))
    # Spark keeps no more than ``take`` rows of a reason per task before the shuffle (a rank limit)
    place = F.row_number().over(Window.partitionBy("reason").orderBy("seq"))
    return bad.withColumn("place", place).filter(F.col("place") <= take)
