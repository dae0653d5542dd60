"""Near duplicates by SimHash: fingerprints, bands, Hamming distance, Jaccard similarity, clusters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch, among, small_batches
from .graph import components
from .sampling import with_ordinal

BANDS, BITS = 4, 16
#: Of a fingerprint, five blocks of 12 or 13 bits.
BLOCKS = [((1 << 64 * (k + 1) // 5) - 1) ^ ((1 << 64 * k // 5) - 1) for k in range(5)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingles(t: Column, n: int = 4) -> Column:
    """Distinct runs of ``n`` characters; the text itself if it is shorter, none if it is empty."""
    # The characters are split once and bound to a name: taking substrings of a long text by place would be quadratic.
    runs = F.transform(F.array(F.split(t, "")), lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.size(c) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(c, i, F.lit(n)), "")))[0]
    return F.when(F.length(t) > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


#: The eight bits of a byte as eight bytes of a number, the highest bit first in memory; up to 255 such numbers add up without a carry.
LANES, LANE_ROWS = 8, 255
#: Runs of which a worker remembers the hashes, at 16 bytes each.
KNOWN_RUNS = 2_000_000


def _votes(hashes, np):
    """How many of the hashes (rows of eight bytes) have each of 64 bits."""
    spread = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), LANE_ROWS):
        ones += spread[hashes[at : at + LANE_ROWS]].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return ones


class _Prints:
    """Fingerprints of texts by sets of runs.  Runs are numbers while code points fit 64 bits; their hashes are remembered."""

    kept: dict[tuple[int, int], _Prints] = {}

    @classmethod
    def of(cls, seed: int, n: int) -> _Prints:
        """One for each worker, from its first batch on."""
        if (seed, n) not in cls.kept:
            cls.kept[seed, n] = cls(seed, n)
        return cls.kept[seed, n]

    def __init__(self, seed: int, n: int):
        import numpy as np

        self.np, self.n, self.head = np, n, f"simhash|{seed}|".encode()
        self.bits = 64 // n if n <= 4 else 0  # of a code point's number in a run
        self.number = np.zeros(0x110000, np.uint32)  # of a code point; 0: not seen yet
        self.points = [0]
        self.forget()

    def forget(self) -> None:
        self.keys, self.hashes = self.np.empty(0, self.np.uint64), self.np.empty(0, self.np.uint64)

    def hash_of(self, run: str) -> int:
        import hashlib

        return int.from_bytes(hashlib.sha256(self.head + run.encode()).digest()[:8], "little")

    def numbered(self, text: str):
        """The code points as small numbers; None if there are too many of them, or a lone surrogate."""
        np = self.np
        try:
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        except UnicodeEncodeError:
            return None
        out = self.number[points]
        if not out.all():
            for p in np.unique(points[out == 0]).tolist():
                self.number[p] = len(self.points)
                self.points.append(p)
            out = self.number[points]
        return out.astype(np.uint64) if len(self.points) <= 1 << self.bits else None

    def all(self, texts: list[str]) -> list[int]:
        """Of texts that are at least ``n`` long, in one go: each text's distinct runs, then all runs' hashes."""
        np, n, bits = self.np, self.n, self.bits
        sets: list = []
        for text in texts:
            c = self.numbered(text) if bits else None
            if c is None:
                sets.append(None)
                continue
            runs = c[: len(c) - n + 1].copy()
            for i in range(1, n):
                runs = (runs << np.uint64(bits)) | c[i : len(c) - n + 1 + i]
            runs.sort()
            sets.append(runs[np.append(True, runs[1:] != runs[:-1])])
        if some := [s for s in sets if s is not None]:
            self.learn(np.unique(np.concatenate(some)))
        return [self.plain(t) if s is None else self.fold(self.hashes[np.searchsorted(self.keys, s)]) for t, s in zip(texts, sets)]

    def learn(self, runs) -> None:
        np = self.np
        if len(self.keys) > KNOWN_RUNS:
            self.forget()
        at = np.searchsorted(self.keys, runs)
        new = runs[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != runs)] if len(self.keys) else runs
        if not len(new):
            return
        mask, points = (1 << self.bits) - 1, self.points
        shifts = [self.bits * (self.n - 1 - i) for i in range(self.n)]
        made = np.fromiter((self.hash_of("".join(chr(points[(k >> s) & mask]) for s in shifts)) for k in new.tolist()), np.uint64, len(new))
        keys, hashes = np.concatenate([self.keys, new]), np.concatenate([self.hashes, made])
        order = np.argsort(keys, kind="stable")
        self.keys, self.hashes = keys[order], hashes[order]

    def plain(self, text: str) -> int:
        """Without numbers for runs: short texts, long runs, very many code points."""
        runs = {text[i : i + self.n] for i in range(max(1, len(text) - self.n + 1))}
        return self.fold(self.np.fromiter((self.hash_of(r) for r in runs), self.np.uint64, len(runs)))

    def fold(self, hashes) -> int:
        ones = _votes(hashes.view(self.np.uint8).reshape(-1, 8), self.np).reshape(64)
        return int.from_bytes(self.np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprint(t: Column, seed: int = 42, n: int = 4) -> Column:
    """64 bits as a long.  Each run votes with the first 64 bits of a hash; a bit is set if more votes are for it.

    Batches of texts are as large as the session says (``small_batches``).
    """
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        prints = _Prints.of(seed, n)
        out = [None if x is None else 0 if not x else prints.plain(x) if len(x) < n else -1 for x in texts]
        long = [i for i, x in enumerate(texts) if x is not None and len(x) >= n]
        for i, fp in zip(long, prints.all([texts.iloc[i] for i in long])):
            out[i] = fp
        return pd.Series(out, dtype="object")

    return simhash(t)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def keyed(docs: DataFrame, threshold: int = 3) -> DataFrame:
    """Rows (id, fp) once for each key they meet others by: at, low, key.

    A band of 16 bits brings together a share of all pairs.  Up to a threshold of 3 rows meet by two of five blocks
    instead, 25 or 26 bits: three bits can spoil three blocks, so two are equal.
    """
    if threshold > 3:
        by = [F.struct(F.lit(b).alias("at"), F.lit(0).alias("low"), F.shiftrightunsigned("fp", b * BITS).bitwiseAND(F.lit((1 << BITS) - 1)).alias("key")) for b in range(BANDS)]
    else:
        by = [F.struct(F.lit(1 << i | 1 << j).alias("at"), F.lit((2 << j) - 1).alias("low"), F.col("fp").bitwiseAND(F.lit(_signed(BLOCKS[i] | BLOCKS[j]))).alias("key")) for j in range(len(BLOCKS)) for i in range(j)]
    return docs.filter("fp is not null").select("id", "fp", F.explode(F.array(*by)).alias("k")).select("id", "fp", "k.at", "k.low", "k.key")


def pairs(docs: DataFrame, threshold: int = 3) -> DataFrame:
    """id_a < id_b, distance of rows (id, fp; ids unique) that share a band of bits and differ in ``threshold`` bits at most.

    Complete up to a threshold of 3; beyond that pairs without a common band are missed, as is the method's way.
    Up to 3 the pairs are all those within the threshold, whatever they meet by; one counts where its first two equal
    blocks meet.
    """
    keys = keyed(docs, threshold)
    a, b = (keys.select("at", "low", "key", F.col("id").alias(f"id_{x}"), F.col("fp").alias(f"fp_{x}")) for x in "ab")
    met = a.join(b.drop("low"), ["at", "key"]).filter((F.col("id_a") < F.col("id_b")) & (hamming(F.col("fp_a"), F.col("fp_b")) <= threshold))
    distance = hamming(F.col("fp_a"), F.col("fp_b")).cast("int").alias("distance")
    if threshold > 3:
        return met.select("id_a", "id_b", distance).distinct()
    differ = F.col("fp_a").bitwiseXOR(F.col("fp_b"))
    equal = sum((F.when(differ.bitwiseAND(F.lit(_signed(m))) == 0, 1 << k).otherwise(0) for k, m in enumerate(BLOCKS[1:], 1)), F.when(differ.bitwiseAND(F.lit(_signed(BLOCKS[0]))) == 0, 1).otherwise(0))
    return met.filter(equal.bitwiseAND(F.col("low")) == F.col("at")).select("id_a", "id_b", distance)


def jaccard(a: Column, b: Column, n: int = 4) -> Column:
    """Of the sets of runs of two texts; 1 if both are empty."""

    @F.pandas_udf("double")
    def alike(xs: pd.Series, ys: pd.Series) -> pd.Series:
        def runs(t):
            return {t[i : i + n] for i in range(max(1, len(t) - n + 1))} if t else set()

        last, own, out = None, set(), []
        for x, y in zip(xs, ys):
            if x != last:
                last, own = x, runs(x)
            other = runs(y)
            both = len(own & other)
            out.append(both / (len(own) + len(other) - both) if own or other else 1.0)
        return pd.Series(out, dtype="float64")

    return alike(a, b)


def with_jaccard(found: DataFrame, docs: DataFrame, n: int = 4) -> DataFrame:
    """Adds the similarity of the pairs' sets, their splits and whether these differ; only texts of pairs are read further."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    small_batches(spark)
    found = scratch.table(found, "found")
    ids = scratch.table(found.select(F.col("id_a").alias("id")).union(found.select("id_b")).distinct(), "ids")
    docs = scratch.table(among(docs, ids, "id").select("id", "split", "text"), "texts")
    side = lambda x: docs.select(F.col("id").alias(f"id_{x}"), F.col("split").alias(f"split_{x}"), F.col("text").alias(f"t_{x}"))
    both = found.join(side("a"), "id_a").join(side("b"), "id_b")
    return both.select("id_a", "id_b", "distance", jaccard(F.col("t_a"), F.col("t_b"), n).alias("jaccard"), "split_a", "split_b", (F.col("split_a") != F.col("split_b")).alias("cross_split"))


def linked(found: DataFrame) -> DataFrame:
    """id, label (the least id that can be reached), size of all documents in a pair."""
    scratch = Scratch(found.sparkSession, "linked")
    label = scratch.table(components(found.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")), scratch), "labels")
    return label.join(label.groupBy("label").agg(F.count("*").alias("size")), "label").select("id", "label", "size")


def clusters(found: DataFrame) -> DataFrame:
    """cluster (from 1, by the first pair in rank), id, size of all documents in a pair.

    Pairs are ranked by distance, then falling similarity, then ids.
    """
    scratch = Scratch(found.sparkSession, "clusters")
    found = scratch.table(found, "pairs")
    label = components(found.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")), scratch)
    label = scratch.table(label, "labels")
    first = found.join(label, found["id_a"] == label["id"]).groupBy("label").agg(F.min(F.struct("distance", (-F.col("jaccard")).alias("j"), "id_a", "id_b")).alias("rank"))
    # numbered by ranges of the rank, in many tasks
    numbered = with_ordinal(scratch.table(first, "first"), "rank").select("label", F.col("i").cast("int").alias("cluster"))
    sizes = label.groupBy("label").agg(F.count("*").alias("size"))
    return label.join(numbered.join(sizes, "label"), "label").select("cluster", "id", "size")


def ranked_pairs(docs: DataFrame, seed: int = 42, threshold: int = 3, n: int = 4) -> DataFrame:
    """Pairs of rows with id, split, text, with their similarity and splits, in a written table."""
    scratch = Scratch(docs.sparkSession, "simhash")
    small_batches(docs.sparkSession)
    prints = scratch.table(docs.select("id", fingerprint(F.col("text"), seed, n).alias("fp")), "prints")
    return scratch.table(with_jaccard(pairs(prints, threshold), docs, n), "pairs")


def find_near_duplicates(docs: DataFrame, seed: int = 42, threshold: int = 3, n: int = 4) -> tuple[DataFrame, DataFrame]:
    """Ranked pairs and clusters of rows with id, split, text.  Advisory: nothing is removed."""
    found = ranked_pairs(docs, seed, threshold, n)
    return found.orderBy("distance", F.desc("jaccard"), "id_a", "id_b"), clusters(found)


def summary(docs: DataFrame, found: DataFrame, grouped: DataFrame) -> DataFrame:
    """One row: indexed, pairs, cross_split, clusters, largest."""
    a = docs.agg(F.count("*").alias("indexed"))
    b = found.agg(F.count("*").alias("pairs"), F.count_if("cross_split").alias("cross_split"))
    c = grouped.agg(F.countDistinct("cluster").alias("clusters"), F.coalesce(F.max("size"), F.lit(0)).alias("largest"))
    return a.crossJoin(b).crossJoin(c)  # one row each
