"""Exact search for the highest inner products with KD-trees, one for each shard of the vectors.

Vectors are dealt evenly over shards.  A shard is split at the median of its widest component until a
leaf is small; every node has the tight box around its vectors.  A query walks a shard's tree best first: the node
whose box allows the highest inner product comes next, and the walk ends when no box can reach the k-th best score.
That score is propagated: each query first searches the shard it lives in and takes its k-th score along to all
others, which begin with it.

Components become floor(scale * x), x as double, so that scores are integers and comparison is exact: in doubles while
all components stay small, in Python's integers else.  A query's own row is no candidate; ties go to the smaller id.

The queries are a stated share of the rows, so their blocks meet all shards: one row for each block and shard is
shuffled, never a pair of vectors; with n rows that are n / (every * BLOCK_ROWS) * n / SHARD_ROWS rows of a block.
Equal vectors of a shard are searched once: of each such group only the k + 1 smallest ids can be in a result.

Edge cases: vectors that are null, empty, or hold a null or a component that is not finite take no part, nor do rows
with a null id; rows that share an id all take part, each as a query and a candidate of its own; vectors of different
length are not compared with each other; a score beyond 64 bits counts as the nearest number of 64 bits; fewer
candidates than k give fewer rows; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, partitions

LEAF = 256
#: Vectors of a shard, and queries of a block.
SHARD_ROWS, BLOCK_ROWS = 16_384, 512
#: Products of components up to this bound add up exactly in doubles for thousands of components.
EXACT = 1 << 20


def numbers(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x): as doubles if sums of products are exact in them, else as Python's integers."""
    big = np.abs(vectors).max(initial=0) * scale
    if big < EXACT and vectors.shape[1] < 8192:
        return np.floor(vectors * scale)

    def whole(x: float) -> int:
        # a double of 2^53 or more is an integer
        return int(x) * int(scale) if abs(x) >= 2.0**53 and scale == int(scale) else math.floor(Fraction(x) * Fraction(scale)) if abs(x) * scale >= 2.0**53 else math.floor(x * scale)

    out = np.empty(vectors.shape, object)
    out[:] = [[whole(x) for x in v] for v in vectors.tolist()]
    return out


NONE, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _held(scores: np.ndarray) -> np.ndarray:
    """Python's integers brought into 64 bits."""
    return np.minimum(np.maximum(scores, int(NONE)), int(MOST)) if scores.dtype == object else scores


class Tree:
    """Vectors (rows of integers) with their ids and row numbers, in boxes."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, k: int, leaf: int = LEAF):
        if vectors.dtype != object:
            order = np.lexsort((rows, ids, *vectors.T[::-1]))
            ids, rows, vectors = ids[order], rows[order], vectors[order]
            new = np.ones(len(ids), bool)
            new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
            start = np.flatnonzero(new)
            run = np.arange(len(ids)) - np.repeat(start, np.diff(np.append(start, len(ids))))
            kept = run <= k  # of equal vectors the k + 1 smallest ids
            ids, rows, vectors = ids[kept], rows[kept], vectors[kept]
        self.ids, self.numbers, self.vectors = ids, rows, vectors
        self.lo: list[np.ndarray] = []
        self.hi: list[np.ndarray] = []
        self.sons: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray | None] = []
        self._build(np.arange(len(self.ids)), leaf)
        self.lo_, self.hi_ = np.array(self.lo), np.array(self.hi)

    def exact(self, k: int) -> Tree:
        """The same vectors as Python's integers."""
        as_int = np.empty(self.vectors.shape, object)
        as_int[:] = [[int(x) for x in v] for v in self.vectors.tolist()]
        return Tree(self.ids, self.numbers, as_int, k)

    def _build(self, rows: np.ndarray, leaf: int) -> int:
        todo = [(rows, -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            node = len(self.lo)
            v = self.vectors[rows]
            lo, hi = v.min(axis=0), v.max(axis=0)
            self.lo.append(lo)
            self.hi.append(hi)
            self.sons.append(None)
            self.rows.append(None)
            if parent >= 0:
                a, b = self.sons[parent] or (0, 0)
                self.sons[parent] = (node, b) if side == 0 else (a, node)
            if len(rows) <= leaf or (lo == hi).all():
                self.rows[node] = rows
                continue
            wide = int(np.argmax(hi - lo))
            cut = np.argsort(v[:, wide], kind="stable") if v.dtype == object else np.argpartition(v[:, wide], len(rows) // 2)
            todo += [(rows[cut[: len(rows) // 2]], node, 0), (rows[cut[len(rows) // 2 :]], node, 1)]
        return 0

    def best(self, own: int, q: np.ndarray, k: int, least: int | None) -> list[tuple[int, int]]:
        """The k best (score, id) but the row ``own``, leaving out those under ``least``: highest score, then smallest id."""
        reach = _held(np.maximum(self.lo_ * q, self.hi_ * q).sum(axis=1))
        heap = [(-reach[0], 0)]
        top: list[tuple] = []  # a heap of (score, -id, -row)
        floor = least
        while heap:
            bound, node = heapq.heappop(heap)
            if floor is not None and -bound < floor:
                break
            rows = self.rows[node]
            if rows is None:
                for son in self.sons[node]:
                    heapq.heappush(heap, (-reach[son], son))
                continue
            scores = _held(self.vectors[rows] @ q)
            good = np.arange(len(rows)) if floor is None else np.flatnonzero((scores >= floor).astype(bool))
            if len(good) > 4 * k + 4:  # those beyond the k + 1 best of a leaf can't be in the result
                worst = np.sort(scores[good])[len(good) - k - 1]
                good = good[(scores[good] >= worst).astype(bool)]
            for i in good:
                row = int(self.numbers[rows[i]])
                if row == own:
                    continue
                x = (scores[i], -int(self.ids[rows[i]]), -row)
                if len(top) < k:
                    heapq.heappush(top, x)
                elif x > top[0]:
                    heapq.heapreplace(top, x)
            if len(top) == k and (floor is None or top[0][0] > floor):
                floor = top[0][0]
        return sorted(((int(s), -i) for s, i, _ in top), key=lambda x: (-x[0], x[1]))


PACKED = "shard int, kind int, dim int, ids binary, rows binary, vectors binary, least binary, query long, query_id long, vec_id long, score long"
#: What a packed row is: a shard's vectors, a block of queries, a result.
VECTORS, QUERIES, RESULT = 0, 1, 2


def _packed(pa, rows: dict) -> object:
    types = {"shard": pa.int32(), "kind": pa.int32(), "dim": pa.int32(), "ids": pa.binary(), "rows": pa.binary(), "vectors": pa.binary(), "least": pa.binary(), "query": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}
    n = max(len(v) for v in rows.values())
    return pa.RecordBatch.from_arrays([pa.array(rows.get(c) or [None] * n, t) for c, t in types.items()], list(types))


def top_inner_products(vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """For each row whose id is divisible by ``every``: query_id, rank (from 1), vec_id, score of its k best rows."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "kd")
    valid = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & valid)
    n_rows = rows.count()
    shards = max(1, min(-(-n_rows // shard_rows), 1 << 20), min(partitions(spark), n_rows // 2048))

    def home(batches: Iterator) -> Iterator:
        """One shard: its vectors, its queries with their k-th scores, their results here."""
        import pyarrow as pa
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        by_dim: dict[int, tuple[list, list]] = {}
        for batch in batches:
            column = batch.column("v")
            flat = np.asarray(column.flatten(), dtype=np.float64)
            ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
            for i, (d, e) in enumerate(zip(batch.column("id").to_pylist(), ends.tolist(), strict=True)):
                v = flat[int(ends[i - 1]) if i else 0 : e]
                have = by_dim.setdefault(len(v), ([], []))
                have[0].append(d)
                have[1].append(v)
        first = shard << 40
        for dim, (names, found) in sorted(by_dim.items()):
            ids, values = np.array(names, np.int64), np.array(found)
            own = first + np.arange(len(ids))
            first += len(ids)
            yield _packed(pa, {"shard": [shard], "kind": [VECTORS], "dim": [dim], "ids": [ids.tobytes()], "rows": [own.tobytes()], "vectors": [values.tobytes()]})
            asks = np.flatnonzero(ids % every == 0)
            whole = numbers(values, scale) if len(asks) else None
            tree = Tree(ids, own, whole, k) if len(asks) else None
            for at in range(0, len(asks), BLOCK_ROWS):
                some = asks[at : at + BLOCK_ROWS]
                found = [tree.best(int(own[i]), whole[i], k, None) for i in some]
                least = [f[-1][0] if len(f) == k else NONE for f in found]
                yield _packed(pa, {"shard": [shard], "kind": [QUERIES], "dim": [dim], "ids": [ids[some].tobytes()], "rows": [own[some].tobytes()], "vectors": [values[some].tobytes()], "least": [np.array(least, np.int64).tobytes()]})
                yield from _results(pa, own[some], ids[some], found)

    def away(batches: Iterator) -> Iterator:
        """Blocks of queries from other shards, behind the vectors of one shard each."""
        import pyarrow as pa

        tree, key = None, None
        for batch in batches:
            for x in batch.to_pylist():
                ids, own = np.frombuffer(x["ids"], np.int64), np.frombuffer(x["rows"], np.int64)
                whole = numbers(np.frombuffer(x["vectors"], np.float64).reshape(len(ids), x["dim"]), scale)
                if x["kind"] == VECTORS:
                    tree, key = (Tree(ids, own, whole, k), (x["shard"], x["dim"]))
                elif key == (x["shard"], x["dim"]):
                    least = np.frombuffer(x["least"], np.int64)
                    if whole.dtype == object and tree.vectors.dtype != object:
                        tree = tree.exact(k)
                    elif whole.dtype != object and tree.vectors.dtype == object:
                        whole = np.array([[int(c) for c in v] for v in whole.tolist()], object)
                    found = [tree.best(int(r), q, k, None if low == NONE else int(low)) for r, q, low in zip(own, whole, least, strict=True)]
                    yield from _results(pa, own, ids, found)

    first = scratch.table(rows.repartition(shards).mapInArrow(home, PACKED), "home")
    blocks = first.filter(F.col("kind") == QUERIES).withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("`to` <> shard").withColumn("shard", F.col("to").cast("int")).drop("to")
    meet = first.filter(F.col("kind") == VECTORS).unionByName(blocks).repartitionById(shards, "shard").sortWithinPartitions("shard", "dim", "kind")
    partial = first.filter(F.col("kind") == RESULT).unionByName(meet.mapInArrow(away, PACKED)).select("query", "query_id", "vec_id", "score")
    # At most k rows from each shard meet for a query.
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return partial.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _results(pa, own: np.ndarray, ids: np.ndarray, found: list[list[tuple[int, int]]]) -> Iterator:
    q = [(int(r), int(d)) for r, d, f in zip(own, ids, found, strict=True) for _ in f]
    if q:
        yield _packed(pa, {"kind": [RESULT] * len(q), "query": [r for r, _ in q], "query_id": [d for _, d in q], "vec_id": [i for f in found for _, i in f], "score": [s for f in found for s, _ in f]})


def oracle_sql(k: int = 5, every: int = 50, scale: int = 256) -> str:
    return f"""WITH v AS (SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid AS rid, q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {every} = 0 AND q.rid <> c.rid AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
