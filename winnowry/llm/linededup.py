"""Fuzzy line deduplication by MinHash over character shingles.

Lines are compared in lower case with white space collapsed.  Every line that is not blank takes part, in
``op6_line_dedup`` as in the pipeline's stage; with ``min_chars``, those that are shorter are left alone.
Lines that are equal so are one class, whatever their number.  A class shorter than a shingle has no
other relative; each other class has a MinHash signature over its character shingles; bands of minima give
candidates, whose Jaccard similarity is computed from the lines themselves.  Linked classes form components, and of
each component the first line stays: the one with the least doc_id, then the least line number.  All its other lines
are removed.

Lines of one language share common shingles, so the chance that unlike lines share a band grows with their number; a
band has more minima as the table has more rows (five up to ten thousand rows, then one more for ten times as many),
and there are as many bands as leave out one pair of similarity 0.8 in three million, and more similar ones far more
rarely.  A class is named by a number of its own, not by a hash; two lines are equal if 128 bits of hash are.

Edge cases: a null text stays null and has no lines; blank lines, and those under ``min_chars``, stay; rows that repeat
a doc_id with equal text are judged as one row, with different texts in the order of a hash of the text; rows with a
null doc_id come last in the order; a very long line is one line; a document may lose all its lines and then has an
empty text; an empty table gives no row; the columns of ``docs`` are kept, names used inside begin with an underscore.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import links
from .common import Scratch, lean

SHINGLE = 5
#: No character has this number.
OUTSIDE = np.uint64(0x1FFFFF)
#: White space that a normal form doesn't have.
UNEVEN = ("  ", " \n", "\n ", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"))
#: Minima of which low bits are kept for the estimate.
SIGNED = 128
#: Lines whose text a task remembers to have written.
REMEMBERED = 200_000
#: Tables of repeated lines are broadcast up to this size, at 64 bytes a row.
BROADCAST_BYTES = 32 << 20
#: Characters hashed at a time.
STEP = 1 << 17


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def eligible(text: str, min_chars: int) -> Iterator[tuple[int, str]]:
    """Line numbers from 0 and normal forms of the lines that take part."""
    form = normal
    if not any(x in text for x in UNEVEN) and text.strip(" ") == text:
        form = str.lower  # there is nothing to collapse
    for i, line in enumerate(text.split("\n")):
        if len(line) >= min_chars and len(n := form(line)) >= min_chars:
            yield i, n


def codes_of(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes (32 bits) of lines, one after the other; where each line's begin, and how many it has."""
    chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.array([len(x) for x in lines], np.int64)
    begin = np.cumsum(length) - length
    chars = np.concatenate((chars, np.zeros(SHINGLE, np.uint32)))
    h = chars[: len(chars) - SHINGLE + 1].copy()
    for k in range(1, SHINGLE):
        h *= np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h += chars[k : len(chars) - SHINGLE + 1 + k]
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h, begin, np.maximum(length - SHINGLE + 1, 1)


def minima_of(lines: list[str], mh: links.MinHash) -> np.ndarray:
    """Minima of odd multiples of odd hashes: numbers of 32 bits in another order, the last bit (1) left out."""
    out = np.empty((mh.shape.minima, len(lines)), np.uint32)
    at = 0
    while at < len(lines):
        end, chars = at, 0
        while end < len(lines) and (not chars or chars + len(lines[end]) <= STEP):
            chars += len(lines[end])
            end += 1
        h, begin, count = codes_of(lines[at:end])
        first = np.cumsum(count) - count
        x = h[np.repeat(begin - first, count) + np.arange(int(count.sum()))] | np.uint32(1)
        y = np.empty_like(x)
        for k in range(mh.shape.minima):
            np.multiply(x, mh.a[k, 0], out=y)
            np.minimum.reduceat(y, first, out=out[k, at:end])
        at = end
    # the last bits of a product depend on few bits of its factors; the signature takes the last two
    out >>= np.uint32(1)
    out ^= out >> np.uint32(9)
    return np.ascontiguousarray(out.T)


def shingle_hashes(line: str) -> np.ndarray:
    """The set of a line's shingles, as sorted distinct 64-bit hashes."""
    chars = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(chars) < SHINGLE:
        chars = np.append(chars, np.full(SHINGLE - len(chars), OUTSIDE)) if len(chars) else chars
    n = max(0, len(chars) - SHINGLE + 1)
    # a character has 21 bits: three and two of them make two numbers
    two = chars[1:] << np.uint64(21)
    two |= chars[:-1]
    h = chars[2 : 2 + n] << np.uint64(42)
    h |= two[:n]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h += two[3 : 3 + n]
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(31)
    h.sort()
    return h[np.append(True, h[1:] != h[:-1])] if n else h


def _seen(rows: DataFrame, min_chars: int) -> DataFrame:
    """_id, _row, _line, h1, h2 of every line that takes part; place and text where a task has it for the first time."""

    def split(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext

        digest = xxhash.xxh3_128_digest
        known: set[bytes] = set()
        place = TaskContext.get().partitionId() << 32
        for batch in batches:
            whose, line, hashes, places, shown = [], [], [], [], []
            for k, text in enumerate(batch.column("_text").to_pylist()):
                for i, n in eligible(text, min_chars):
                    h = digest(n.encode("utf-8", "surrogatepass"))
                    whose.append(k)
                    line.append(i)
                    hashes.append(h)
                    if h in known:
                        places.append(None)
                        shown.append(None)
                        continue
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known.add(h)
                    places.append(place)
                    shown.append(n)
                    place += 1
            both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            of = pa.array(whose, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_id").take(of), batch.column("_row").take(of), pa.array(line, pa.int32()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array(places, pa.int64()), pa.array(shown, pa.string())], ["_id", "_row", "_line", "h1", "h2", "place", "text"])

    return rows.mapInArrow(lean(split), "_id long, _row long, _line int, h1 long, h2 long, place long, text string")


def _small(table: DataFrame) -> DataFrame:
    """A written table, to be broadcast if its size allows."""
    return F.broadcast(table) if table.count() * 64 <= BROADCAST_BYTES else table


def repeated_lines(rows: DataFrame, threshold: float, min_chars: int, shape: links.Shape | None, scratch: Scratch) -> DataFrame:
    """_id, _row, _line of every line to be removed, of rows with _id, _row, _text."""
    if shape is None:
        shape = links.Shape.for_rows(rows.count(), threshold, SIGNED)

    def sketcher():
        mh = links.MinHash(shape)

        def sketch(batch):
            return minima_of(batch.column("text").to_pylist(), mh), {"place": batch.column("place")}

        return sketch

    seen = scratch.table(_seen(rows, min_chars), "seen", compression="zstd")
    order = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_row").alias("r"), F.col("_line").alias("l"))
    # A class is named by the least place at which its text stands
    classes = scratch.table(seen.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.count("place").alias("places"), F.count("*").alias("times")), "classes")
    several = _small(scratch.table(classes.filter("places > 1").select("h1", "h2", F.col("place").alias("least")), "several"))
    again = _small(scratch.table(seen.filter("place is not null").select("h1", "h2", "place").join(several, ["h1", "h2"]).filter("place <> least").select("place"), "again"))
    written = seen.filter("text is not null").select("place", "text")
    # a line shorter than a shingle is like its equals alone, and they are one class
    made = links.band(written.filter(F.length("text") >= SHINGLE).join(again, "place", "left_anti"), sketcher, shape, {"place": "long"}, scratch)
    signatures = made.filter(F.col("kind") == links.ITEM)
    members = made.filter(F.col("kind") == links.UNDER_KEY)
    reached = lambda m, n, both: both >= threshold * (m + n - both) - 1e-9

    def fetch(ids: DataFrame, name: str) -> DataFrame:
        places = _small(scratch.table(signatures.select("id", "place").join(_small(ids), "id", "left_semi"), f"{name}-places"))
        return written.join(places, "place").select("id", "text")

    labels = links.groups(members, signatures, shape, threshold, fetch, lambda: shingle_hashes, reached, scratch)
    labels = scratch.table(signatures.select("id", "place").join(_small(labels), "id").select("place", "label"), "placed-labels")
    # Classes that are linked, or stand more than once; a class without a link is its own group, by a negative number
    groups = classes.join(_small(labels), "place", "left").filter("times > 1 or label is not null").select("h1", "h2", F.coalesce("label", -1 - F.col("place")).alias("g"))
    groups = _small(scratch.table(groups, "groups"))
    placed = scratch.table(seen.select("_id", "_row", "_line", "h1", "h2").join(groups, ["h1", "h2"]).select("g", "_id", "_row", "_line"), "placed")
    stays = _small(scratch.table(placed.groupBy("g").agg(F.min(order).alias("stays")), "stays"))
    return placed.join(stays, "g").filter(~order.eqNullSafe(F.col("stays"))).select("_id", "_row", "_line")


def dedup_lines(docs: DataFrame, threshold: float = 0.8, min_chars: int = 1, shape: links.Shape | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without repeated lines in their text, with n_lines (before) and n_removed.

    Columns of ``docs`` that have these two names are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    scratch = Scratch(docs.sparkSession, "lines")
    keyed = docs.withColumn("_id", F.col(id_col).cast("long")).withColumn("_row", F.xxhash64(id_col, text_col))
    rows = keyed.select("_id", "_row", F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    gone = scratch.table(repeated_lines(rows, threshold, min_chars, shape, scratch).groupBy("_id", "_row").agg(F.collect_set("_line").alias("_gone")), "gone")
    scratch.drop("bands", "seen")
    # by hash: the texts are not sorted
    joined = keyed.alias("d").join(gone.alias("g").hint("shuffle_hash"), (F.col("d._row") == F.col("g._row")) & F.col("d._id").eqNullSafe(F.col("g._id")), "left")
    lines = F.split(F.col(f"d.`{text_col}`"), "\n", -1)
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("g._gone", i)), "\n")
    text = F.when(F.col("g._gone").isNull(), F.col(f"d.`{text_col}`")).otherwise(kept)
    made = [text.alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns]
    # line ends are one byte each: only texts that lose lines are split
    ends = F.octet_length(f"d.`{text_col}`") - F.octet_length(F.replace(F.col(f"d.`{text_col}`"), F.lit("\n"), F.lit("")))
    n_lines = F.coalesce(ends + 1, F.lit(0)).cast("long")
    return joined.select(*made, n_lines.alias("n_lines"), F.coalesce(F.size("g._gone"), F.lit(0)).cast("long").alias("n_removed"))
