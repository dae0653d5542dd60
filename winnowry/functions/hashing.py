"""Stable hashes, numbers between 0 and 1, and splits, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _joined(parts: tuple) -> Column:
    """Parts with bars between; null is written None (concat_ws would leave it out)."""
    out = []
    for p in parts:
        if isinstance(p, Column):
            c = F.coalesce(p.cast("string"), F.lit("None"))
        else:
            c = F.lit(str(p))
        out += [F.lit("|"), c]
    return F.concat(*out[1:])


def stable_hash(*parts) -> Column:
    return F.sha2(_joined(parts), 256)


def stable_float(*parts) -> Column:
    """The hash's first 64 bits as a share of 2^64."""
    return F.conv(F.substring(stable_hash(*parts), 1, 16), 16, 10).cast("double") / F.lit(2.0**64)


def text_hash(t: Column) -> Column:
    return F.sha2(t, 256)


def split_of(doc_id: Column, seed: int = 42, train: float = 0.9, validation: float = 0.05) -> Column:
    """Where a document goes, by its id and the seed alone."""
    u = stable_float("split", seed, doc_id)
    return F.when(u < F.lit(train), "train").when(u < F.lit(train + validation), "validation").otherwise("test")
