"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct shingles (runs of words; lower-cased A-Z).  Minima of many hash functions over
the set are banded: documents that share all minima of a band are candidates.  Of each minimum the two low bits are
kept, packed into integers; the share of equal remainders, corrected for chance, estimates the similarity of a
candidate pair by bit counts.  Pairs that may reach the threshold are confirmed on their full sets.  Linked documents
form components.

With 38 bands of 5 minima, a pair of similarity 0.8 is no candidate once in four million cases, a more similar pair
far more rarely.  Documents with equal sets are put together before, whatever their number.

Edge cases: a null text or one without words has an empty set and no link; a text with fewer words than a shingle has
its whole sequence as one; rows that repeat a doc_id have one result each, with the size of their own sets and one
component, as the id is linked where any of its texts is; a row with a null doc_id gets no component (null) and is
kept; further columns are ignored; texts are taken whole; an empty table gives no row.  Of rows that repeat a kept
doc_id, ``deduplicated`` keeps the one with the least hash of its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from . import links
from .common import BROADCAST_BYTES, Scratch, texts

SHAPE = links.Shape(rows=5, bands=38)


class _Words(dict):
    """Hashes of words; the memory for them is bounded by ``Shingles``."""

    def __init__(self):
        import xxhash

        self.hash = xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        h = self[word] = self.hash(word)
        return h


class Shingles:
    """The set of a text's shingles of ``words`` words, as sorted distinct 64-bit hashes."""

    def __init__(self, words: int, remembered: int = 500_000):
        self.words, self.limit, self.known = words, remembered, _Words()

    def of(self, text: str) -> np.ndarray:
        # ASCII alone is lowered, and only ASCII white space parts words
        found = text.encode("utf-8", "surrogatepass").lower().split()
        if len(self.known) > self.limit:
            self.known.clear()
        codes = np.fromiter(map(self.known.__getitem__, found), np.uint64, len(found))
        if not len(codes):
            return codes
        n = min(self.words, len(codes))
        mixed = codes[: len(codes) - n + 1] + np.uint64(n)
        for k in range(1, n):
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed = mixed * np.uint64(0xBF58476D1CE4E5B9) + codes[k : len(codes) - n + 1 + k]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return np.unique(mixed ^ (mixed >> np.uint64(31)))


def reaches(percent: int):
    """Whether sets of m and n elements with ``both`` in common have a Jaccard similarity of ``percent`` or more."""
    return lambda m, n, both: 100 * both >= percent * (m + n - both)


def near_duplicates(docs: DataFrame, words: int = 2, percent: int = 80, shape: links.Shape = SHAPE) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id that can be reached), kept (whether that is the document)."""
    scratch = Scratch(docs.sparkSession, "neardup")
    rows = texts(docs)

    def sketcher():
        import xxhash

        sets, mh = Shingles(words), links.MinHash(shape)
        no = np.zeros(shape.minima, np.uint32)

        def sketch(batch):
            minima, counts, digests = [], [], []
            for text in batch.column("text").to_pylist():
                s = sets.of(text)
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                # a row of zeros has no keys; no minima of a set are all zero in practice, and if so, it is mended
                m = mh.minima(s) if len(s) else no
                minima.append(m if m.any() or not len(s) else m + np.uint32(1))
                counts.append(len(s))
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            more = {"doc_id": batch.column("doc_id"), "of": batch.column("of"), "n": np.array(counts, np.int64), "h1": both[:, 0].copy(), "h2": both[:, 1].copy()}
            return np.array(minima, np.uint32).reshape(len(counts), shape.minima), more

        return sketch

    # Items are rows
    known = rows.filter("doc_id is not null").withColumn("of", F.xxhash64("text"))
    made = links.band(known, sketcher, shape, {"doc_id": "long", "of": "long", "n": "long", "h1": "long", "h2": "long"}, scratch)
    items = made.filter(F.col("kind") == links.ITEM)
    # Equal sets are one class, named by its least row; one of its texts stands for all
    classes = scratch.table(items.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min("id").alias("rep"), F.min(F.struct("doc_id", "of")).alias("one")), "classes")
    sigs = [f"s{w}" for w in range(shape.words)]
    named = scratch.table(items.join(classes.drop("one"), ["h1", "h2", "n"], "left").select("id", "doc_id", "n", F.coalesce("rep", "id").alias("rep"), *sigs), "named")
    reps = named.filter("id = rep and n > 0").select("id", *sigs)
    to_rep = named.select("id", "rep")
    under = made.filter(F.col("kind") == links.UNDER_KEY)
    members = under.join(to_rep, "id").select("key", F.col("rep").alias("id"), "pivot", "pair")
    members = members.join(to_rep.select(F.col("id").alias("pivot"), F.col("rep").alias("p")), "pivot").select("key", "id", F.col("p").alias("pivot"), "pair").distinct()
    members = scratch.table(members.filter("id <> pivot or key is not null"), "members")
    texts_of = classes.select(F.col("rep").alias("id"), "one.doc_id", "one.of")

    def fetch(ids: DataFrame, name: str) -> DataFrame:
        wanted = scratch.table(texts_of.join(ids, "id", "left_semi"), f"{name}-wanted")
        if wanted.count() * 40 <= BROADCAST_BYTES:
            wanted = F.broadcast(wanted)
        return known.join(wanted, ["doc_id", "of"]).select("id", "text").dropDuplicates(["id"])

    labels = links.groups(members, reps, shape, percent / 100, fetch, lambda: Shingles(words).of, reaches(percent), scratch)
    labels = labels.select(F.col("id").alias("rep"), "label")
    placed = scratch.table(named.select("doc_id", "n", "rep").join(labels, "rep", "left").select("doc_id", "n", F.coalesce("label", "rep").alias("group")), "placed")
    # A doc_id with several texts joins their groups
    ids = placed.groupBy("doc_id").agg(F.min("group").alias("a"), F.max("group").alias("b")).filter("a <> b").select("doc_id", "a")
    joins = scratch.table(placed.join(ids, "doc_id").select("a", F.col("group").alias("b")).filter("a <> b").distinct(), "joins")
    if not joins.isEmpty():
        top = scratch.table(components(joins, scratch, "ids"), "top").select(F.col("id").alias("group"), "label")
        placed = placed.join(top, "group", "left").select("doc_id", "n", F.coalesce("label", "group").alias("group"))
    least = placed.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    out = placed.join(least, "group").select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    return out.unionByName(_without_id(rows, words))


def _without_id(rows: DataFrame, words: int) -> DataFrame:
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sets = Shingles(words)
        for batch in batches:
            n = [len(sets.of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.int64()), pa.array(n, pa.int64()), pa.nulls(len(n), pa.int64()), pa.array([True] * len(n))], ["doc_id", "n_shingles", "component_id", "kept"])

    return rows.filter("doc_id is null").mapInArrow(count, "doc_id long, n_shingles long, component_id long, kept boolean")


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` but for those in a component with a smaller doc_id, and one row of each doc_id."""
    scratch = Scratch(docs.sparkSession, "dedup")
    found = scratch.table(near_duplicates(docs, words, percent).filter("doc_id is not null").groupBy("doc_id").agg(F.bool_and("kept").alias("kept"), F.count("*").alias("rows")), "found")
    left = docs.join(found.filter("not kept or rows > 1").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    again = found.filter("kept and rows > 1")
    if again.isEmpty():
        return left
    row, own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]), docs.join(again.select("doc_id"), "doc_id", "left_semi")
    least = own.groupBy("doc_id").agg(F.min_by(row, F.struct(F.xxhash64("text"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))).alias("row"))
    return left.unionByName(least.select("row.*"))
