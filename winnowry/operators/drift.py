"""How the domains of a corpus shift between what was inspected, what was kept, and the splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import SPLITS


def _percent(part, whole):
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))


def domain_drift(distribution: DataFrame, retained: DataFrame) -> DataFrame:
    """One row for each domain of either input: counts and percentages of every population, and their differences.

    ``distribution``: domain, inspected, accepted; ``retained``: domain, split.  Unrounded.
    """
    kept = retained.groupBy("domain").pivot("split", list(SPLITS)).count()
    rows = distribution.join(kept, "domain", "full_outer").select("domain", *[F.coalesce(c, F.lit(0)).cast("long").alias(f"{c}_n") for c in ("inspected", "accepted", *SPLITS)])
    rows = rows.withColumn("retained_n", sum((F.col(f"{s}_n") for s in SPLITS[1:]), F.col(f"{SPLITS[0]}_n")))
    names = ["inspected", "accepted", "retained", *SPLITS]
    totals = rows.agg(*[F.sum(f"{c}_n").alias(f"{c}_all") for c in names])
    # totals is one row
    rows = rows.crossJoin(F.broadcast(totals)).select("domain", *[f"{c}_n" for c in names], *[_percent(F.col(f"{c}_n"), F.col(f"{c}_all")).alias(f"{c}_pct") for c in names])
    shift = [F.abs(F.col(f"{s}_pct") - F.col("retained_pct")) for s in SPLITS]
    return rows.withColumn("drift_pp", F.col("retained_pct") - F.col("inspected_pct")).withColumn("max_split_drift_pp", F.greatest(*shift))


def worst(drift: DataFrame, key: str = "drift_pp") -> DataFrame:
    """The domain that shifts most, with its signed shift; of equals the first by name."""
    return drift.orderBy(F.desc(F.abs(key)), "domain").limit(1).select("domain", key)


def top_domains(drift: DataFrame, take: int = 12) -> DataFrame:
    return drift.filter("retained_n > 0").orderBy(F.desc("retained_n"), "domain").limit(take)
