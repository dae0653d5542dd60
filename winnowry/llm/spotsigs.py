"""Document fingerprints by SpotSigs: chains of content words behind common-word anchors.

At every anchor (a very common word such as an article or a pronoun) a signature is made of the anchor and the next
``chain`` content words, each ``gap`` content words from the one before; anchors themselves are skipped.  Boilerplate
has few anchors, running text has many, so the set of signatures stands for the text's prose.  A text without any
signature (no anchors, as in lists or other languages) falls back to all runs of ``chain`` + 1 words, and a text with
fewer words than that to its words as a whole; a text without words falls back to itself.

A fingerprint is the set of distinct 64-bit hashes of the signatures, written as sorted hexadecimal numbers.  Equal
texts have equal fingerprints; an empty text has the empty one.  Likeness is the Jaccard similarity of two sets; two
empty sets are alike (1), an empty and another are not (0).

Sets are compared with pruning by length: with a threshold t, sets whose sizes differ by more than the factor t can't
reach it.  ``similar_pairs`` uses this on whole tables: sets are partitioned by the logarithm of their size, so that
each need meet only its own and the next class; within a class, only the rarest hashes of each set (a prefix that any
set of likeness t must share) are looked up.

Edge cases: a null text is empty; rows that repeat a doc_id stand each for itself, ordered by their text; a row with
a null doc_id comes last in the descending order; an empty table gives no row; further columns are ignored; the texts
are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, partitions, texts

#: Anchors: the most common function words of the languages the tables hold.
ANCHORS = frozenset(
    """the a an is was are be to of that this it he she they with for as by on at from and in
    le la les un une des du de est et que qui dans pour sur par avec ce il elle ne pas au aux en
    der die das ein eine ist und zu den dem des mit von auf für nicht sich im er sie es als auch an
    el los las una que y es por con para del se lo su al no como más""".split()
)
CHAIN, GAP = 2, 1


class Spots:
    """Signature hashes of texts.  Words' hashes are remembered up to a bound."""

    def __init__(self, anchors=ANCHORS, chain: int = CHAIN, gap: int = GAP, remembered: int = 500_000):
        import xxhash

        if chain < 1 or gap < 1:
            raise ValueError("chain and gap are 1 at least")
        self.anchors, self.chain, self.gap, self.limit = anchors, chain, gap, remembered
        self.hash = xxhash.xxh3_64_intdigest
        self.known = _Words(self)

    def set_of(self, text: str) -> np.ndarray:
        """Sorted distinct unsigned 64-bit hashes."""
        words = text.split()
        if len(self.known) > self.limit:
            self.known.clear()
        codes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        # The lowest bit tells an anchor; a code of 0 is a word without letters and digits.
        codes = codes[codes != 0]
        if not len(codes):
            return np.array([self.hash(text.encode("utf-8", "surrogatepass"))] if text else [], np.uint64)
        anchor = (codes & np.uint64(1)).astype(bool)
        content = codes[~anchor]
        at = np.flatnonzero(anchor)
        first = at - np.arange(len(at))  # content words before each anchor: the next one's place
        first = first[first + self.gap * (self.chain - 1) < len(content)]
        if len(first):
            mixed = codes[at[: len(first)]]
            for k in range(self.chain):
                mixed = _mix(mixed, content[first + k * self.gap])
            return np.unique(mixed)
        n = self.chain + 1
        if len(codes) < n:
            return np.array([self.hash(codes.tobytes(), seed=1)], np.uint64)
        mixed = codes[: len(codes) - n + 1]
        for k in range(1, n):
            mixed = _mix(mixed, codes[k : len(codes) - n + 1 + k])
        return np.unique(mixed)


class _Words(dict):
    def __init__(self, spots: Spots):
        self.spots = spots

    def __missing__(self, word: str) -> int:
        plain = "".join(c for c in word.lower() if c.isalnum())
        if not plain:
            code = 0
        else:
            h = self.spots.hash(plain.encode("utf-8", "surrogatepass")) | 2
            code = h | 1 if plain in self.spots.anchors else h & ~1
        self[word] = code
        return code


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two, in order."""
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def jaccard(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Likeness of two sorted sets; 0 without looking at them, if their sizes alone rule out ``at_least``."""
    if not len(a) and not len(b):
        return 1.0
    small, large = sorted((len(a), len(b)))
    if not small or small < at_least * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def written(spots: np.ndarray) -> str:
    return spots.astype(">u8").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by as many first ones of the following text (or all it has)."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def with_next(docs: DataFrame) -> DataFrame:
    """Texts in descending doc_id order within ranges of it, each range followed by the first text of the next one.

    Columns doc_id, text, place, extra: ``extra`` marks the row that follows the range.  The texts are shuffled once.
    The doc_ids where ranges begin come from the doc_id column alone: about one row for each partition.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    scratch = Scratch(spark, "spots")
    rows = texts(docs)
    ids = rows.select("doc_id")
    # Bounds by quantiles of the ids: as many numbers as there are partitions.
    shares = ", ".join(f"{i / n}D" for i in range(1, max(2, n)))
    cut = ids.filter("doc_id is not null").selectExpr(f"percentile_approx(doc_id, array({shares}), {max(1000, 20 * n)}) b").first()["b"]
    cuts = sorted(set(cut or []))
    # place 0 has the greatest ids; null ids come last
    k = len(cuts)
    place = F.coalesce(F.lit(k) - _rank(F.col("doc_id"), cuts), F.lit(k))
    placed = rows.withColumn("place", place.cast("int"))
    # The first row of a place is its greatest doc_id; it follows the last row of the nearest place before with rows.
    heads = ids.withColumn("place", place.cast("int")).groupBy("place").agg(F.max("doc_id").alias("head"), F.count("*").alias("n"))
    w = Window.orderBy("place")
    firsts = heads.select("place", F.lag("place").over(w).alias("before"), "head", F.max("place").over(Window.partitionBy()).alias("last"))
    heads = scratch.table(firsts.select("place", F.coalesce("before", "last").alias("goes_to"), "head"), "heads").collect()
    # One entry for each partition: a map in the plan, never more than there are partitions.
    if not heads:
        return placed.withColumn("extra", F.lit(False)).limit(0)
    also = F.create_map(*[x for h in heads for x in (F.lit(h["place"]), F.struct(F.lit(h["goes_to"]).alias("goes_to"), F.lit(h["head"]).cast("long").alias("head")))])
    h = also[F.col("place")]
    own = F.struct(F.col("place").alias("place"), F.lit(False).alias("extra"))
    copy = F.struct(h["goes_to"].alias("place"), F.lit(True).alias("extra"))
    is_head = h["head"].eqNullSafe(F.col("doc_id"))
    both = placed.select("doc_id", "text", F.explode(F.when(is_head, F.array(own, copy)).otherwise(F.array(own))).alias("to"))
    return both.select("doc_id", "text", "to.place", "to.extra").repartitionById(k + 1, "place")


def _rank(col, cuts: list[int]):
    """How many of the sorted cuts are less than the value, by a tree of comparisons."""

    def tree(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(col > F.lit(cuts[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return F.when(col.isNotNull(), tree(0, len(cuts)))


def fingerprints(docs: DataFrame, anchors=ANCHORS, chain: int = CHAIN, gap: int = GAP) -> DataFrame:
    """Of every whole text: doc_id, n_chars, its and its edited text's fingerprint, and their likeness.

    ``near_edited`` compares a text with its edited form, ``near_next`` with the next text in descending doc_id order
    (the first one follows the last).
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        spots = Spots(anchors, chain, gap)
        before = None  # doc_id, text, set
        spare = None  # the row that follows the range
        out: list[tuple] = []

        def made(a, b):
            changed = edited(a[1], b[1])
            e = spots.set_of(changed)
            return (a[0], len(a[1]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), written(a[2]), written(e), jaccard(a[2], e), jaccard(a[2], b[2]))

        def block(rows):
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            for d, text, extra in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("extra").to_pylist(), strict=True):
                if extra:  # these stand last; the first of them is the next text
                    spare = spare or (d, text, spots.set_of(text))
                    continue
                now = (d, text, spots.set_of(text))
                if before is not None:
                    out.append(made(before, now))
                before = now
            if out:
                yield block(out)
                out = []
        if before is not None:
            yield block([made(before, spare)])

    ordered = with_next(docs).sortWithinPartitions("extra", F.desc_nulls_last("doc_id"), "text")
    return ordered.select("doc_id", "text", "extra").mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def similar_pairs(prints: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", print_col: str = "fingerprint") -> DataFrame:
    """Pairs id_a < id_b of likeness ``threshold`` or more, with it as ``likeness``; for ids that are unique.

    Rows of equal fingerprints are put together first and stand in one pair with their least id, so that a large
    group of copies gives as many pairs as it has members.  Empty fingerprints take part in no pair.
    """
    rows = prints.select(F.col(id_col).alias("id"), F.col(print_col).alias("print")).filter("id is not null and length(print) > 0")
    groups = rows.groupBy("print").agg(F.min("id").alias("id"))
    same = rows.join(groups.withColumnRenamed("id", "id_a"), "print").filter("id > id_a").select("id_a", F.col("id").alias("id_b"), F.lit(1.0).alias("likeness"))
    size = F.length("print") / 16
    sets = groups.withColumn("n", size.cast("int")).withColumn("class", F.floor(F.log(size) / F.lit(-float(np.log(threshold)))).cast("int"))
    marks = sets.select("id", "n", "class", F.explode(F.expr("transform(sequence(0, n - 1), i -> substring(print, 16 * i + 1, 16))")).alias("spot"))
    often = marks.groupBy("spot").count()
    order = Window.partitionBy("id").orderBy("count", "spot")
    prefix = marks.join(often, "spot").withColumn("k", F.row_number().over(order)).filter(F.col("k") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    left = prefix.select(F.col("id").alias("a"), F.col("n").alias("na"), F.explode(F.array("class", F.col("class") + 1)).alias("class"), "spot")
    right = prefix.select(F.col("id").alias("b"), F.col("n").alias("nb"), "class", "spot")
    near = left.join(right, ["class", "spot"]).filter((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    near = near.filter(F.col("na") >= threshold * F.col("nb") - 1e-9).select("a", "b").distinct()

    def verify(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for x in batches:
            sim = [jaccard(read(p), read(q), threshold) for p, q in zip(x.column("pa").to_pylist(), x.column("pb").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([x.column("a"), x.column("b"), pa.array(sim)], ["a", "b", "likeness"])

    p = groups.select(F.col("id").alias("a"), F.col("print").alias("pa"))
    q = groups.select(F.col("id").alias("b"), F.col("print").alias("pb"))
    kind = dict(prints.dtypes)[id_col]
    checked = near.join(p, "a").join(q, "b").select("a", "b", "pa", "pb").mapInArrow(verify, f"a {kind}, b {kind}, likeness double").filter(F.col("likeness") >= threshold)
    return same.unionByName(checked.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"), "likeness"))
