"""From signatures to groups: banding, candidate pairs, verification by the caller, connected components.

Banding without pairs within a group.  The task that makes signatures sorts its items by band key and keeps, of all
that share a key, one pivot; the others are linked to the pivot at once and travel by themselves.  So a key held by a
third of all items sends one entry for each task, not one for each item.  Entries travel packed: one binary row for
each receiving partition, with the differences of sorted keys and 16-bit numbers of items.  Behind the shuffle, a key's pivots are
linked to one of them.  Pivots are picked at random by key, so an item meets many partners; the likeliest few by
signature are verified (all, where a key has two items), and what is linked gets one label by connected components.

This leaves out pairs, so keys of three items or more whose items still have different labels are taken up again.
First each item outside a key's largest label is verified against the likeliest of all it meets in a block of the key.
What then has another label near it, or stands in a key of several blocks, is *open*, and open items are compared by
an exact prefix filter: the elements of each set are ordered by how rare they are among open items, rarest first; two
sets of n elements that reach the threshold t must share one of the first n - ceil(t n) + 1, and behind the first one
they share enough elements must be left.  Each set sends its parities (``Parities``) along, which bound from below how
many elements two sets differ by; pairs that these and the filter allow are confirmed on full sets.  So rows follow
the sizes of sets and the number of pairs near the threshold: members of a group of near copies whose likeness is well
below it leave no row, though those with rare elements in common are looked at, in memory, pair by pair.  No
pair of items of one label is ever looked at, and every pair under a common key whose signatures allow the threshold
is in the end either in one label or known not to be linked.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.graph import components
from .common import Scratch, lean, partitions

#: Items of a key that stand in one block when labels are compared.
BLOCK = 2048
#: Pivots of an item that are verified at first.
PARTNERS = 4


#: Band entries that a task gathers before it sends them on, and open entries.
GATHERED = 1 << 21
#: Bits for the number of an item among those of one sending; the others are its key's.
NUMBER = 16
#: Counters of how often set elements occur among open items; a counter over ``HOT`` splits its elements' items.
COUNTERS, HOT = 1 << 20, 1 << 20
#: Pairs looked at in one go.
PAIRS = 1 << 20
#: Rows of blocks that a task gathers before it compares them; a block is whole.
MET = 1 << 14


@dataclass(frozen=True)
class Shape:
    """``bands`` of ``rows`` minima each; two low bits of up to ``most`` minima (of all, if 0) are kept in ``words`` integers."""

    rows: int
    bands: int
    most: int = 0

    @classmethod
    def for_rows(cls, n: int, threshold: float, most: int = 0, miss: float = 3e-7) -> Shape:
        """A shape for tables of about ``n`` rows: more minima a band as there are more chance partners, and as many
        bands as leave out one of 1 / ``miss`` pairs at the threshold."""
        rows = max(5, 1 + math.ceil(math.log10(max(n, 2))))
        return cls(rows, math.ceil(math.log(miss) / math.log(1 - threshold**rows)), most)

    @property
    def minima(self) -> int:
        return self.rows * self.bands

    @property
    def signed(self) -> int:
        return min(self.minima, self.most or self.minima)

    @property
    def words(self) -> int:
        return -(-self.signed // 32)

    def likeness(self, a: str, b: str) -> Column:
        """The estimate of Jaccard similarity from two packed signatures.

        Two-bit remainders of different minima agree in one case of four, so a share s of agreeing remainders stands
        for a similarity of (s - 1/4) / (3/4).
        """
        differ = F.lit(0)
        for w in range(self.words):
            x = F.col(f"{a}s{w}").bitwiseXOR(F.col(f"{b}s{w}"))
            differ = differ + F.bit_count((x.bitwiseOR(F.shiftrightunsigned(x, 1))).bitwiseAND(F.lit(0x5555555555555555)))
        agree = 1 - differ / F.lit(float(self.signed))
        return (agree - 0.25) / 0.75

    def estimates(self, one: np.ndarray, many: np.ndarray) -> np.ndarray:
        """As likeness, of one packed signature with each of many."""
        x = many ^ one
        differ = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1, dtype=np.int64)
        return (1 - differ / self.signed - 0.25) / 0.75

    def least_estimate(self, threshold: float) -> float:
        """What the estimate of a pair at the threshold stays above, but for about one pair in a billion."""
        agree = 0.25 + 0.75 * threshold
        return threshold - 6 * (agree * (1 - agree) / self.signed) ** 0.5 / 0.75


class MinHash:
    """Minima of a shape's hash functions over sets of 64-bit hashes, their band keys and packed low bits."""

    STEP = 2048

    def __init__(self, shape: Shape, seed: int = 7):
        r = np.random.default_rng(seed)
        self.shape = shape
        self.a = (r.integers(0, 1 << 32, shape.minima, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
        self.b = r.integers(0, 1 << 32, shape.minima, dtype=np.uint64).astype(np.uint32)[:, None]
        self.odd = r.integers(0, 1 << 63, shape.rows, dtype=np.uint64) | np.uint64(1)
        self.salt = r.integers(0, 1 << 63, shape.bands, dtype=np.uint64)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        x = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
        out = None
        for at in range(0, len(x), self.STEP):
            y = self.a * x[None, at : at + self.STEP]
            y += self.b
            low = y.min(axis=1)
            out = low if out is None else np.minimum(out, low)
        return out

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """Items x minima to items x bands of 64-bit keys."""
        m = minima.reshape(len(minima), self.shape.bands, self.shape.rows)
        k = np.zeros(m.shape[:2], np.uint64)
        for r in range(self.shape.rows):
            k += m[:, :, r] * self.odd[r]
        k ^= self.salt
        k = (k ^ (k >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        k = (k ^ (k >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return k ^ (k >> np.uint64(31))

    def packed(self, minima: np.ndarray) -> np.ndarray:
        two = np.zeros((len(minima), self.shape.words * 32), np.uint64)
        two[:, : self.shape.signed] = minima[:, : self.shape.signed] & np.uint32(3)
        two = two.reshape(len(minima), self.shape.words, 32) << (2 * np.arange(32, dtype=np.uint64))
        return np.bitwise_or.reduce(two, axis=2)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def _planes(x: np.ndarray) -> bytes:
    """64-bit integers as differences, byte by byte: rising numbers become runs of zeros that any codec shrinks."""
    return np.diff(x.view(np.uint64), prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64).view(np.int64)


def _starts(sorted_: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(sorted_) else np.zeros(0, np.int64)


#: What a row is: an item under a key, or an item's signature and what comes with it.
UNDER_KEY, ITEM = 0, 1
Sketcher = Callable[[object], tuple[np.ndarray, dict[str, np.ndarray]]]


def band(rows: DataFrame, sketcher: Callable[[], Sketcher], shape: Shape, extra: dict[str, str], scratch: Scratch, name: str = "bands") -> DataFrame:
    """Items under keys that more than one item has, and one row for each item; a written table.

    ``sketcher()`` makes, in a task, a function from an Arrow batch to (minima, extra columns) of its items, which are
    numbered here.  An item whose minima are all 0 has no keys.  Columns: kind, key, id, pivot, pair (whether the key
    has two items), s0.., and those of ``extra`` (name to type), which only rows of items have.  Rows of a pair have
    no key: they stand for themselves.
    """
    spark = rows.sparkSession
    parts = partitions(spark)
    sigs = [f"s{w}" for w in range(shape.words)]
    own = "id long, " + ", ".join(f"{s} long" for s in sigs) + "".join(f", {n} {t}" for n, t in extra.items())
    item = ["id", *sigs, *extra]
    number, mask = np.uint64(NUMBER), np.uint64((1 << NUMBER) - 1)
    whole = 1 << (64 - NUMBER)
    bounds = [-(-whole * p // parts) for p in range(parts + 1)]  # a partition's keys

    def kinds(pa):
        return {"long": pa.int64(), "int": pa.int32()}

    def produce(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        sketch, mh = sketcher(), MinHash(shape)
        types = [pa.int64()] * (1 + shape.words) + [kinds(pa)[t] for t in extra.values()]
        held: list[np.ndarray] = []
        base = at = TaskContext.get().partitionId() << 32  # of what is held; of the next item
        cuts = np.array(bounds, np.uint64)

        def packed() -> Iterator:
            """Entries (key, number of the item, whether others wait behind it) and stars (key, id, pivot), by partition."""
            both = np.concatenate(held)
            both.sort()
            keys, no = both >> number, (both & mask).astype(np.int64)
            start = _starts(keys)
            size = np.diff(np.append(start, len(keys)))
            # the pivot of a key: any of its items, by chance
            chosen = start + (_mixed(keys[start]) % size.astype(np.uint64)).astype(np.int64)
            waits = np.ones(len(keys), bool)
            waits[chosen] = False
            waits = np.flatnonzero(waits)
            of = np.repeat(no[chosen], size)[waits]
            k, i, m = keys[start], no[chosen].astype(np.uint16), size > 1
            stars = np.stack([keys[waits].view(np.int64), base + no[waits], base + of])
            to = (_mixed(keys[waits] ^ no[waits].view(np.uint64)) % np.uint64(parts)).astype(np.int64)
            turn = np.argsort(to, kind="stable")
            stars, to = stars[:, turn], to[turn]
            edges = np.searchsorted(k, cuts)
            ends = np.searchsorted(to, np.arange(parts + 1))
            for p in range(parts):
                a, b, c, d = edges[p], edges[p + 1], ends[p], ends[p + 1]
                if a < b or c < d:
                    yield p, _planes(k[a:b]), i[a:b].tobytes(), np.packbits(m[a:b]).tobytes(), stars[:, c:d].tobytes()

        def blobs() -> Iterator:
            found = list(packed())
            for x in range(0, len(found), 256):
                p, k, i, m, s = zip(*found[x : x + 256], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array([base] * len(p), pa.int64()), *[pa.array(y, pa.binary()) for y in (k, i, m, s)], *[pa.nulls(len(p), t) for t in types]], ["part", "base", "keys", "numbers", "many", "stars", *item])

        for batch in batches:
            minima, more = sketch(batch)
            n = len(minima)
            if not n:
                continue
            ids = at + np.arange(n)
            at += n
            codes = mh.packed(minima).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((_mixed(ids.view(np.uint64)) % np.uint64(parts)).astype(np.int32)), *[pa.nulls(n, t) for t in (pa.int64(), *[pa.binary()] * 4)], pa.array(ids), *[pa.array(codes[:, w]) for w in range(shape.words)], *[pa.array(more[c], kinds(pa)[t]) for c, t in extra.items()]],
                ["part", "base", "keys", "numbers", "many", "stars", *item],
            )
            with_set = np.flatnonzero(minima.any(axis=1))
            step = max(1, min(1 << NUMBER, GATHERED // shape.bands))
            for x in range(0, n, step):
                some = with_set[(with_set >= x) & (with_set < x + step)]
                if ids[min(x + step, n) - 1] - base >= step and held:
                    yield from blobs()
                    held, base = [], int(ids[x])
                elif not held:
                    base = int(ids[x])
                if len(some):
                    keys = mh.keys(minima[some])
                    held.append(((keys >> number) << number | (ids[some] - base).astype(np.uint64)[:, None]).ravel())
        if held:
            yield from blobs()

    def reduce(batches: Iterator) -> Iterator:
        """A key with one item is left out unless others wait behind that one."""
        import pyarrow as pa

        types = [pa.int64()] * shape.words + [kinds(pa)[t] for t in extra.values()]
        names = ["kind", "key", "id", "pivot", "pair", *item[1:]]
        keys, ids, many, part = [], [], [], 0

        def under(key, i, pivot, pair):
            return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(i), np.int32)), pa.array(key, mask=pair), pa.array(i), pa.array(pivot), pa.array(pair), *[pa.nulls(len(i), t) for t in types]], names)

        for batch in batches:
            blob = batch.filter(batch.column("keys").is_valid())
            rest = batch.filter(batch.column("keys").is_null())
            if n := rest.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()), rest.column("id"), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), *[rest.column(c) for c in item[1:]]], names)
            for part, base, k, i, m, s in zip(*(blob.column(c).to_pylist() for c in ("part", "base", "keys", "numbers", "many", "stars")), strict=True):  # noqa: B007
                if k:
                    keys.append(_unplaned(k).view(np.uint64))
                    ids.append(base + np.frombuffer(i, np.uint16).astype(np.int64))
                    many.append(np.unpackbits(np.frombuffer(m, np.uint8), count=len(ids[-1])).astype(bool))
                if s:
                    key, i, pivot = np.frombuffer(s, np.int64).reshape(3, -1)
                    yield under(key, i, pivot, np.zeros(len(key), bool))
        if not keys:
            return
        k, i, m = map(np.concatenate, (keys, ids, many))
        del keys, ids, many
        # One sort of numbers that hold a key, as far as its bits go, and a place
        bits = max(1, (len(k) - 1).bit_length())
        over = max(0, (bounds[part + 1] - bounds[part]).bit_length() + bits - 64)
        both = ((k - np.uint64(bounds[part])) >> np.uint64(over)) << np.uint64(bits) | np.arange(len(k), dtype=np.uint64)
        both.sort()
        order = (both & np.uint64((1 << bits) - 1)).astype(np.int64)
        start = _starts(both >> np.uint64(bits))
        del both
        size = np.diff(np.append(start, len(order)))
        waits = m[order[start]]
        # most keys have one item, behind which no others wait
        shown = np.flatnonzero((size > 1) | waits)
        start, size = start[shown], size[shown]
        if not len(start):
            return
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        order = order[at]
        start = np.cumsum(size) - size
        waits = np.logical_or.reduceat(m[order], start)
        pair = (size == 2) & ~waits
        key = k[order[start]]
        by = np.minimum((_mixed(key) % size.astype(np.uint64)).astype(np.int64), size - 1)
        pivot = i[order[start + by]]
        for x in range(0, len(start), PAIRS):
            runs = np.arange(x, min(x + PAIRS, len(start)))
            n = size[runs]
            at = np.repeat(start[runs] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            who, of, two = i[order[at]], np.repeat(pivot[runs], n), np.repeat(pair[runs], n)
            keep = ~two | (who != of)
            yield under(np.repeat(key[runs], n)[keep].view(np.int64), who[keep], of[keep], two[keep])

    sent = rows.mapInArrow(lean(produce), f"part int, base long, keys binary, numbers binary, many binary, stars binary, {own}")
    out = "kind int, key long, id long, pivot long, pair boolean, " + own.removeprefix("id long, ")
    return scratch.table(sent.repartitionById(parts, "part").mapInArrow(lean(reduce), out), name)


def star_pairs(members: DataFrame, signatures: DataFrame, shape: Shape, threshold: float) -> DataFrame:
    """Pairs (a, b) of items that may reach the threshold: an item and those of its keys' pivots that look most alike, and all keys of two items."""
    pairs = members.filter("id <> pivot").groupBy("id", "pivot").agg(F.max("pair").alias("pair"))
    sigs = [f"s{w}" for w in range(shape.words)]
    a = signatures.select("id", *[F.col(s).alias(f"a{s}") for s in sigs])
    b = signatures.select(F.col("id").alias("pivot"), *[F.col(s).alias(f"b{s}") for s in sigs])
    seen = pairs.join(a.hint("shuffle_hash"), "id").join(b.hint("shuffle_hash"), "pivot").select("id", "pivot", "pair", shape.likeness("a", "b").alias("e")).filter(F.col("e") >= shape.least_estimate(threshold))
    # An item has one pivot for each band at most
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("e"), "pivot"))
    return seen.withColumn("r", rank).filter((F.col("r") <= PARTNERS) | F.col("pair")).select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()


def _meetings(held: DataFrame, labels: DataFrame, signatures: DataFrame | None, shape: Shape, scratch: Scratch, name: str) -> DataFrame:
    """Keys of three items or more with different labels, dealt in blocks; ``asks``: the item is outside the key's largest label.

    ``held``: distinct (key, id), with s0.. if there are no ``signatures`` to take them from.
    """
    sigs = [f"s{w}" for w in range(shape.words)]
    own = [] if signatures is not None else sigs
    sizes = labels.groupBy("label").count().withColumnRenamed("count", "size")
    sized = labels.join(sizes, "label").select("id", "label", "size")
    held = held.join(sized.hint("shuffle_hash"), "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"), F.coalesce("size", F.lit(1)).alias("size"), *own)
    held = scratch.table(held, f"{name}-held")
    keys = held.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.struct("size", "label")).alias("main"), F.count("*").alias("n")).filter("low <> high")
    keys = keys.select("key", F.col("main.label").alias("main"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    active = held.join(keys.hint("shuffle_hash"), "key")
    if signatures is not None:
        active = active.join(signatures.select("id", *sigs).hint("shuffle_hash"), "id")
    block = F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int").alias("block")
    active = active.select("key", block, "id", "label", "size", *sigs, (F.col("label") != F.col("main")).alias("asks"), (F.col("blocks") > 1).alias("split"))
    return scratch.table(active.repartition(partitions(labels.sparkSession), "key", "block").sortWithinPartitions("key", "block"), f"{name}-active")


def _blocks(batches: Iterator, shape: Shape) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """Columns of some whole blocks, where each begins, and how many rows it has; blocks come sorted and may go on over batches."""
    sigs = [f"s{w}" for w in range(shape.words)]
    names = ["key", "block", "id", "label", "size", "asks", "split"]
    held, rows = [], 0

    def joined() -> dict:
        return {n: np.concatenate([h[n] for h in held]) for n in held[0]}

    def some(cols: dict, start: np.ndarray, end: int) -> tuple:
        return {n: c[:end] for n, c in cols.items()}, start, np.diff(np.append(start, end))

    def starts(cols: dict) -> np.ndarray:
        key, block = cols["key"], cols["block"]
        return np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])))

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        held.append(cols | {"codes": np.stack([batch.column(c).to_numpy() for c in sigs], axis=1).view(np.uint64)})
        rows += batch.num_rows
        if rows < MET:
            continue
        cols = joined()
        start = starts(cols)
        if len(start) > 1:  # the last one may go on
            yield some(cols, start[:-1], start[-1])
            cols = {n: c[start[-1] :] for n, c in cols.items()}
        held, rows = [cols], 0
    if held:
        cols = joined()
        start = starts(cols)
        yield some(cols, start, len(cols["key"]))


def _nearest(cols: dict, start: np.ndarray, count: np.ndarray, asks: np.ndarray, shape: Shape, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of items that ask, places of items of larger labels that are near them in their blocks, and the estimates.

    All pairs of an item that asks come together, in order.
    """
    labels, sizes, codes = cols["label"], cols["size"], cols["codes"]
    begin, n = np.repeat(start, count), np.repeat(count, count)
    who = np.flatnonzero(asks)
    total = np.cumsum(n[who])
    k = 0
    while k < len(who):
        to = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + PAIRS // 4, "right")))
        i, c = who[k:to], n[who[k:to]]
        k = to
        x = np.repeat(i, c)
        y = np.repeat(begin[i] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
        ok = np.flatnonzero((sizes[y] > sizes[x]) | ((sizes[y] == sizes[x]) & (labels[y] > labels[x])))
        x, y = x[ok], y[ok]
        e = shape.estimates(codes[x], codes[y])
        near = np.flatnonzero(e >= least)
        yield x[near], y[near], e[near]


def best_pairs(meetings: DataFrame, shape: Shape, threshold: float) -> DataFrame:
    """Pairs (a, b) of an item and, of all that it meets in larger labels, those that look most alike."""
    least = shape.least_estimate(threshold)

    def best(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for cols, start, count in _blocks(batches, shape):
            for x, y, e in _nearest(cols, start, count, cols["asks"], shape, least):
                if len(x):
                    order = np.lexsort((y, -e, x))
                    first = order[_starts(x[order])]
                    yield pa.RecordBatch.from_arrays([pa.array(cols["id"][x[first]]), pa.array(cols["id"][y[first]]), pa.array(e[first])], ["id", "other", "e"])

    # One row for each key of an item at most
    seen = meetings.mapInArrow(lean(best), "id long, other long, e double").distinct()
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("e"), "other"))
    return seen.withColumn("r", rank).filter(F.col("r") <= PARTNERS).select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def open_items(meetings: DataFrame, shape: Shape, threshold: float) -> DataFrame:
    """id, label, asks, s0..: items that may be linked to an item of another label under a common key."""
    least = shape.least_estimate(threshold)
    sigs = [f"s{w}" for w in range(shape.words)]

    def found(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for cols, start, count in _blocks(batches, shape):
            # the other blocks of a key are not seen here
            split, asks = cols["split"].astype(bool), cols["asks"].astype(bool)
            wanted, asking = split.copy(), split & asks
            for x, y, _ in _nearest(cols, start, count, asks & ~split, shape, least):
                asking[x] = wanted[x] = wanted[y] = True
            if wanted.any():
                own = cols["codes"][wanted].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cols["id"][wanted]), pa.array(cols["label"][wanted]), pa.array(asking[wanted]), *[pa.array(own[:, w].copy()) for w in range(shape.words)]], ["id", "label", "asks", *sigs])

    seen = meetings.mapInArrow(lean(found), "id long, label long, asks boolean, " + ", ".join(f"{s} long" for s in sigs))
    return seen.groupBy("id", "label").agg(F.max("asks").alias("asks"), *[F.max(s).alias(s) for s in sigs])


Fetch = Callable[[DataFrame, str], DataFrame]
Sets = Callable[[], Callable[[str], np.ndarray]]
Test = Callable[[int, int, int], bool]


def verified(pairs: DataFrame, fetch: Fetch, sets: Sets, test: Test, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) whose full sets pass the test."""
    pairs = scratch.table(pairs, f"{name}-pairs")
    ids = scratch.table(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), f"{name}-ids")
    needed = scratch.table(fetch(ids, name), f"{name}-texts")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        set_of = sets()
        last, a = None, None
        for batch in batches:
            ok = []
            for ta, tb in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                if ta != last:  # pairs of one text come together
                    last, a = ta, set_of(ta)
                b = set_of(tb)
                both = np.concatenate((a, b))
                both.sort()
                ok.append(test(len(a), len(b), int(np.count_nonzero(both[1:] == both[:-1]))))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    with_b = pairs.join(needed.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    both = with_b.join(needed.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    return both.select("a", "b", "ta", "tb").mapInArrow(lean(run), "a long, b long").distinct()


def _rarity(items: DataFrame, sets: Sets) -> np.ndarray:
    """How often set elements occur among the items, by a hash of theirs: ``COUNTERS`` numbers, whatever the input."""
    slice_ = 1 << 14

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        set_of, sums = sets(), np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for t in batch.column("text").to_pylist():
                s = set_of(t) & np.uint64(COUNTERS - 1)
                np.add.at(sums, s.astype(np.int64), 1)
        if sums.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(COUNTERS // slice_), pa.int32()), pa.array([sums[k : k + slice_].tobytes() for k in range(0, COUNTERS, slice_)], pa.binary())], ["slice", "sums"])

    def add(key, rows):
        import pandas as pd

        total = sum((np.frombuffer(x, np.int64) for x in rows["sums"]), np.zeros(slice_, np.int64))
        return pd.DataFrame({"slice": [key[0]], "sums": [total.tobytes()]})

    out = np.zeros(COUNTERS, np.int64)
    for r in items.select("text").mapInArrow(lean(count), "slice int, sums binary").groupBy("slice").applyInPandas(add, "slice int, sums binary").collect():
        out[r["slice"] * slice_ : (r["slice"] + 1) * slice_] = np.frombuffer(r["sums"], np.int64)
    return out


class Parities:
    """Parities of sets, by which most pairs under the threshold are ruled out for certain.

    A set has one bit for each value of some bits of its elements' hashes: whether an odd number of elements has it.
    What two sets have in common cancels out, so they differ in no more bits than in elements; halves folded by xor
    are the parities of half as many values.  Sets of over ``LARGEST`` elements have their signature instead, whose
    size is fixed, and a set of either kind is not compared with one of the other here.
    """

    LARGEST = 4096
    #: Rank of a signature; parities of rank k have 64 << k bits.
    SIGNED = 255

    def __init__(self, shape: Shape, threshold: float):
        self.shape, self.threshold, self.least = shape, threshold, shape.least_estimate(threshold)

    def of(self, s: np.ndarray, codes: np.ndarray) -> tuple[int, np.ndarray]:
        """Rank and words of a set: three bits for each two elements at least, three times that at most."""
        if len(s) > self.LARGEST:
            return self.SIGNED, codes
        rank = max(0, math.ceil(math.log2(max(1.5 * len(s), 1) / 64)))
        odd = np.bincount((s >> np.uint64(20)).astype(np.int64) & ((64 << rank) - 1), minlength=64 << rank) & 1
        return rank, np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)

    def allow(self, words: np.ndarray, start: np.ndarray, rank: np.ndarray, n: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the sets x and y, one by one, may reach the threshold; their words begin at ``start``."""
        ok = np.ones(len(x), bool)
        rx, ry = rank[x], rank[y]
        both = np.flatnonzero((rx == self.SIGNED) & (ry == self.SIGNED))
        for at in range(0, len(both), PAIRS // 16):
            some = both[at : at + PAIRS // 16]
            span = np.arange(self.shape.words)
            ok[some] = self.shape.estimates(words[start[x[some], None] + span], words[start[y[some], None] + span]) >= self.least
        sided = (rx != self.SIGNED) & (ry != self.SIGNED)
        low = np.minimum(rx, ry)
        for k in np.unique(low[sided]):
            some_k = np.flatnonzero(sided & (low == k))
            step = max(1, PAIRS >> int(k))
            for at in range(0, len(some_k), step):
                some = some_k[at : at + step]
                differ = np.bitwise_count(self._folded(words, start, rank, x[some], int(k)) ^ self._folded(words, start, rank, y[some], int(k))).sum(axis=1, dtype=np.int64)
                # sets at the threshold t differ in (1 - t) / (1 + t) of their elements, counted in both
                ok[some] = differ <= (1 - self.threshold) / (1 + self.threshold) * (n[x[some]] + n[y[some]]) + 1e-6
        return ok

    @staticmethod
    def _folded(words: np.ndarray, start: np.ndarray, rank: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
        span = np.arange(1 << k)
        out = words[start[x, None] + span]
        for fold in range(1, 1 << (int(rank[x].max()) - k)):
            more = np.flatnonzero(fold < 1 << (rank[x].astype(np.int64) - k))
            out[more] ^= words[start[x[more], None] + (fold << k) + span]
        return out


#: What travels of an element of a set, and of a set to each partition that has an element of it.
ENTRY = np.dtype([("element", "<u8"), ("item", "<u4"), ("at", "<u4")])
SET = np.dtype([("id", "<i8"), ("label", "<i8"), ("n", "<u4"), ("asks", "?"), ("rank", "u1")])
#: Bytes of entries and sets that a task gathers before it sends them on.
GATHERED_BYTES = 1 << 26


def under_elements(rows: np.ndarray, own: np.ndarray, words: np.ndarray, parities: Parities) -> Iterator[np.ndarray]:
    """Pairs of ids (two columns, the lesser first) under common elements of a partition: entries, sets and their words.

    An entry looks only at sets of a size that leaves enough elements behind it.
    """
    t = parities.threshold
    n = own["n"].astype(np.int64)
    count = np.where(own["rank"] == Parities.SIGNED, parities.shape.words, 1 << np.minimum(own["rank"], 32).astype(np.int64))
    start = np.cumsum(count) - count
    rows = rows[np.lexsort((n[rows["item"]], rows["element"]))]
    item = rows["item"].astype(np.int64)
    left = n[item] - rows["at"]  # elements from this one on
    first = _starts(rows["element"])
    size = np.diff(np.append(first, len(rows)))
    place = np.repeat(np.arange(len(first)), size) << 32 | n[item]
    who = np.flatnonzero(own["asks"][item] & np.repeat(size > 1, size))
    nw, group = n[item[who]], place[who] >> 32 << 32
    least = np.ceil(t * nw - 1e-5).astype(np.int64)
    most = np.floor(np.minimum((nw + 1e-5) / t, (left[who] + 1e-5) * (1 + t) / t - nw)).astype(np.int64)
    begin, stop = np.searchsorted(place, group | np.maximum(least, 0)), np.searchsorted(place, group | np.maximum(most, 0), "right")
    # some at a time, of one entry as of many
    long = np.maximum(0, -(-(stop - begin) // PAIRS))
    a = np.repeat(who, long)
    turn = np.arange(len(a)) - np.repeat(np.cumsum(long) - long, long)
    at = np.repeat(begin, long) + turn * PAIRS
    end = np.minimum(at + PAIRS, np.repeat(stop, long))
    total = np.cumsum(end - at)
    held, pairs, k = [], 0, 0
    while k < len(a):
        to = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + PAIRS, "right")))
        length = end[k:to] - at[k:to]
        x = np.repeat(a[k:to], length)
        y = np.repeat(at[k:to] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        k = to
        ix, iy = item[x], item[y]
        ok = own["label"][ix] != own["label"][iy]
        ok &= ~(own["asks"][iy] & (own["id"][iy] < own["id"][ix]))
        # behind the first element that both have, enough must be left
        ok &= np.minimum(left[x], left[y]) >= t / (1 + t) * (n[ix] + n[iy]) - 1e-6
        # a pair comes once, however many elements it shares here
        one = np.unique(ix[ok] << 32 | iy[ok])
        ix, iy = one >> 32, one & 0xFFFFFFFF
        ok = parities.allow(words, start, own["rank"], n, ix, iy)
        if ok.any():
            held.append(np.sort(np.stack([own["id"][ix[ok]], own["id"][iy[ok]]], axis=1), axis=1))
            pairs += len(held[-1])
        if pairs >= PAIRS:
            yield np.unique(np.concatenate(held), axis=0)
            held, pairs = [], 0
    if held:
        yield np.unique(np.concatenate(held), axis=0)


def prefix_pairs(items: DataFrame, shape: Shape, sets: Sets, threshold: float) -> DataFrame:
    """Pairs (a, b) of different labels, one of which asks, that neither an exact prefix filter nor their parities rule out.

    ``items``: id, label, asks, text, s0.., a written table.  Entries of an element that many items have are dealt over
    several groups: each item that does not ask stands in one, an item that asks in all.
    """
    parts = partitions(items.sparkSession)
    rare = np.minimum(_rarity(items, sets), np.iinfo(np.uint32).max).astype(np.uint32)
    shared = items.sparkSession.sparkContext.broadcast(rare)
    sigs = [f"s{w}" for w in range(shape.words)]
    parities = Parities(shape, threshold)

    def produce(batches: Iterator) -> Iterator:
        import pyarrow as pa

        set_of, often = sets(), shared.value
        held, own, words, weight = [], [], [], 0

        def blobs() -> Iterator:
            rows, known = np.concatenate(held), np.array(own, SET)
            count = np.array([len(w) for w in words])
            start, flat = np.cumsum(count) - count, np.concatenate(words)
            to = (_mixed(rows["element"]) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            rows, to = rows[order], to[order]
            bounds = np.searchsorted(to, np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(bounds)):
                sent = rows[bounds[p] : bounds[p + 1]]
                here, sent["item"] = np.unique(sent["item"], return_inverse=True)
                c = count[here]
                at = np.repeat(start[here] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
                yield int(p), sent.tobytes(), known[here].tobytes(), flat[at].tobytes()

        def batches_of(found: Iterator) -> Iterator:
            for some in iter(lambda: list(itertools.islice(found, 64)), []):
                p, *rest = zip(*some, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), *[pa.array(r, pa.binary()) for r in rest]], ["part", "rows", "sets", "words"])

        for batch in batches:
            codes = np.stack([batch.column(c).to_numpy() for c in sigs], axis=1).view(np.uint64)
            for i, label, asks, t, code in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "asks", "text")), codes, strict=True):
                s = set_of(t)
                n = len(s)
                rank, own_words = parities.of(s, code)
                times = often[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
                first = np.lexsort((s, times))[: n - math.ceil(threshold * n - 1e-9) + 1]
                s, groups = s[first], 1 + times[first].astype(np.int64) // HOT
                at = np.arange(len(s))
                turn = np.zeros(len(s), np.int64)
                if (groups > 1).any():
                    if asks:
                        at = np.repeat(at, groups)
                        turn = np.arange(len(at)) - np.repeat(np.cumsum(groups) - groups, groups)
                    else:
                        turn = (_mixed(s ^ np.uint64(i & 0xFFFFFFFFFFFFFFFF)) % groups.astype(np.uint64)).astype(np.int64)
                rows = np.empty(len(at), ENTRY)
                rows["element"] = s[at] + turn.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                rows["item"], rows["at"] = len(own), at
                held.append(rows)
                own.append((i, label, n, asks, rank))
                words.append(own_words)
                weight += rows.nbytes + min(parts, len(rows)) * (SET.itemsize + own_words.nbytes)
                if weight >= GATHERED_BYTES:
                    yield from batches_of(blobs())
                    held, own, words, weight = [], [], [], 0
        if held:
            yield from batches_of(blobs())

    def meet(batches: Iterator) -> Iterator:
        import pyarrow as pa

        rows, own, words, known = [], [], [], 0
        for batch in batches:
            for r, o, w in zip(*(batch.column(c).to_pylist() for c in ("rows", "sets", "words")), strict=True):
                rows.append(np.frombuffer(r, ENTRY).copy())
                rows[-1]["item"] += np.uint32(known)
                own.append(np.frombuffer(o, SET))
                words.append(np.frombuffer(w, np.uint64))
                known += len(own[-1])
        if not rows:
            return
        rows, own, words = map(np.concatenate, (rows, own, words))
        for pairs in under_elements(rows, own, words, parities):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    sent = items.select("id", "label", "asks", "text", *sigs).mapInArrow(lean(produce), "part int, rows binary, sets binary, words binary")
    return sent.repartitionById(parts, "part").mapInArrow(lean(meet), "a long, b long").distinct()


def groups(members: DataFrame, signatures: DataFrame, shape: Shape, threshold: float, fetch: Fetch, sets: Sets, test: Test, scratch: Scratch) -> DataFrame:
    """id, label of all items that have a verified link: stars first, then what stars have left out.

    ``fetch(ids, name)`` gives id and text for the ids of a written table, ``sets()`` makes in a task the function
    from a text to its set (sorted distinct hashes), ``test(m, n, both)`` says whether sets of m and n elements with
    ``both`` in common are linked.
    """
    first = scratch.table(verified(star_pairs(members, signatures, shape, threshold), fetch, sets, test, scratch, "stars"), "links")
    labels = scratch.table(components(first, scratch, "first"), "labels")

    def joined(labels: DataFrame, more: DataFrame, name: str) -> DataFrame:
        """Labels after more links: these join labels, which are far fewer than items."""
        if more.isEmpty():
            return labels
        named = lambda c: labels.select(F.col("id").alias(c), F.col("label").alias(f"l{c}"))
        held = scratch.table(more.join(named("a"), "a", "left").join(named("b"), "b", "left").select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")), f"{name}-held")
        top = scratch.table(components(held.select(F.col("la").alias("a"), F.col("lb").alias("b")), scratch, name), f"{name}-top").select(F.col("id").alias("label"), F.col("label").alias("to"))
        every = labels.unionByName(held.select(F.col("a").alias("id"), F.col("la").alias("label"))).unionByName(held.select(F.col("b").alias("id"), F.col("lb").alias("label"))).distinct()
        return scratch.table(every.join(top, "label", "left").select("id", F.coalesce("to", "label").alias("label")), f"{name}-labels")

    met = _meetings(members.filter("not pair").select("key", "id").distinct(), labels, signatures, shape, scratch, "best")
    labels = joined(labels, scratch.table(verified(best_pairs(met, shape, threshold), fetch, sets, test, scratch, "best"), "best-links"), "second")
    # labels have only grown together: a key of one label before is one still
    met = _meetings(met.select("key", "id", *[f"s{w}" for w in range(shape.words)]), labels, None, shape, scratch, "rest")
    open_ = scratch.table(open_items(met, shape, threshold), "open")
    if open_.isEmpty():
        return labels
    items = scratch.table(fetch(scratch.table(open_.select("id"), "open-ids"), "open").join(open_, "id"), "open-items")
    more = scratch.table(verified(prefix_pairs(items, shape, sets, threshold), fetch, sets, test, scratch, "rest"), "rest-links")
    return joined(labels, more, "third")
