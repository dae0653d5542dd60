"""Best-fit packing of documents into sequences of bounded length, by hierarchical residual packing.

1. Each text is encoded; documents longer than a sequence are cut into pieces (only these are cut).
2. Pieces are dealt evenly over partitions.  Each partition takes its pieces in descending length and puts each into
   the bin with the least room that still holds it (a bin's room indexes the open bins, a bit set finds the next).
3. Bins that are nearly full are final.  The others rise to the next level as items, a bounded number from each
   partition: all bins filled to half or less (of which best fit leaves one at most) and as many of the emptiest
   others as the level above can use.  A bin over half full can't go together with another such bin, so the rest can
   gain nothing from one another and is final as well.  Groups of partitions repeat the best fit with these bins as
   items, and so on up the tree, until one group is left.  What a task of an upper level holds is bounded by the
   number of its children, not by the input.

Edge cases: a null text is empty and has only the end id; an empty table gives no row; rows that repeat a doc_id are
packed each on its own; a null doc_id stays null; further columns are ignored.  Ties in length are broken by doc_id
and piece, so equal partitions give equal bins.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import Scratch, partitions, texts

#: Partitions (or groups of them) whose residual bins meet at the next level.
FAN_IN = 16
#: Bins over half full that a partition hands up beside its one filler.
HOSTS = 64
#: Pieces of a partition of the lowest level, if there are so many.
ROWS_AT_LEAST = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32.  No shuffle."""

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc, end = tokens.encoder(tokenizer, False), struct.pack("<I", end_id)
        for batch in batches:
            rows: list[tuple] = []
            for d, ids in zip(batch.column("doc_id").to_pylist(), enc.encode_all(batch.column("text").to_pylist()), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((d, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts(docs).mapInArrow(cut, PIECES)


class BestFit:
    """Bins of one capacity; ``put`` finds the bin with the least sufficient room in time that does not depend on their number."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.room = capacity, 0, []
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.some = 0  # bit r: there is a bin with room r

    def put(self, size: int) -> tuple[int, int]:
        """The bin and the place in it for an item of 1 to ``capacity``."""
        fit = self.some >> size
        if fit:
            r = size + (fit & -fit).bit_length() - 1
            k = self.by_room[r].pop()
            if not self.by_room[r]:
                self.some &= ~(1 << r)
        else:
            r, k = self.capacity, self.bins
            self.bins += 1
            self.room.append(r)
        left = r - size
        self.room[k] = left
        if left:
            self.by_room[left].append(k)
            self.some |= 1 << left
        return k, self.capacity - r

    def rising(self, hosts: int) -> set[int]:
        """The bins that the next level may fill further: those up to half full, and the emptiest of the others."""
        half, found, more = self.capacity // 2, set(), hosts
        for r in range(self.capacity - 1, 0, -1):
            for k in self.by_room[r]:
                if r >= half:
                    found.add(k)
                elif more:
                    found.add(k)
                    more -= 1
            if not more and r < half:
                break
        return found


def pack(pieces: DataFrame, capacity: int = 2048, fan_in: int = FAN_IN, hosts: int = HOSTS) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length (1 to ``capacity``).

    ``pieces`` is read twice and must be stable, as a written table is; extra columns are kept.
    """
    spark = pieces.sparkSession
    # Small partitions pack worse: a partition gets some thousand pieces at least.
    parts = max(1, min(partitions(spark), pieces.count() // ROWS_AT_LEAST))
    scratch = Scratch(spark, "packing")
    # bin ids: level, partition and number, so that no two are alike: 8, 24 and 31 bits
    base = lambda level, part: (level << 55) | (part << 31)

    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, fit, fill = TaskContext.get().partitionId(), BestFit(capacity), []
        for batch in batches:
            placed = [fit.put(n) for n in batch.column("length").to_pylist()]
            fill = [base(0, part) + k for k, _ in placed]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fill, pa.int64()), pa.array([at for _, at in placed], pa.int64()), pa.nulls(batch.num_rows, pa.int64())], [*batch.schema.names, "bin", "at", "room"])
        # The bins that rise: rows without a piece
        up = sorted(fit.rising(hosts))
        none = [pa.nulls(len(up), f.type) for f in batch.schema] if fit.bins else []
        if up:
            yield pa.RecordBatch.from_arrays([*none, pa.array([base(0, part) + k for k in up], pa.int64()), pa.array([part] * len(up), pa.int64()), pa.array([fit.room[k] for k in up], pa.int64())], [*batch.schema.names, "bin", "at", "room"])

    own = pieces.columns
    dealt = pieces.repartition(parts, F.xxhash64("doc_id", "piece", "length")).sortWithinPartitions(F.desc("length"), "doc_id", "piece")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", bin long, at long, room long"
    placed = scratch.table(dealt.mapInArrow(local, schema), "placed")
    items = placed.filter("room is not null").select("bin", F.col("at").alias("group"), (F.lit(capacity) - F.col("room")).alias("size"))
    moved = None
    level, groups = 1, parts
    while groups > 1:
        groups = -(-groups // fan_in)
        merged = scratch.table(_merge(items, level, fan_in, capacity, hosts, base), f"level{level}")
        steps = merged.select("bin", "into", "shift")
        if moved is None:
            moved = steps
        else:  # follow each bin of the lower levels to where it went
            s = steps.select(F.col("bin").alias("into"), F.col("into").alias("further"), F.col("shift").alias("more"))
            moved = moved.join(s, "into", "left").select("bin", F.coalesce("further", "into").alias("into"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
        items = merged.filter("rises is not null").select(F.col("into").alias("bin"), "group", F.col("rises").alias("size")).dropDuplicates(["bin"])
        level += 1
    out = placed.filter("room is null")
    if moved is None:
        return out.select(*own, F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    return out.join(moved, "bin", "left").select(*own, F.coalesce("into", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("shift", F.lit(0))).alias("offset"))


def _merge(items: DataFrame, level: int, fan_in: int, capacity: int, hosts: int, base) -> DataFrame:
    """Best fit of the bins that have risen, by groups of partitions: bin, into, shift, group, rises (the new bin's fill, if it rises)."""

    def merge(key, rows):
        import pandas as pd

        group = int(key[0])
        rows = rows.sort_values(["size", "bin"], ascending=[False, True], kind="stable")
        fit = BestFit(capacity)
        placed = [fit.put(int(n)) for n in rows["size"]]
        up = fit.rising(hosts)
        return pd.DataFrame({"bin": rows["bin"].to_numpy(), "into": [base(level, group) + k for k, _ in placed], "shift": [at for _, at in placed], "group": group, "rises": pd.array([capacity - fit.room[k] if k in up else None for k, _ in placed], dtype="Int64")})

    grouped = items.withColumn("group", F.floor(F.col("group") / fan_in).cast("long"))
    return grouped.groupBy("group").applyInPandas(merge, "bin long, into long, shift long, group long, rises long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document."""
    pieces = Scratch(docs.sparkSession, "pieces").table(token_pieces(docs, tokenizer, end_id, capacity), "pieces")
    return pack(pieces, capacity)
