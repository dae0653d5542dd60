"""Token ids as binary files: Elias-Fano coded document boundaries over one concatenated id array.

A shard holds the ids of consecutive documents as one array of 16- or 32-bit integers.  Where the documents end is a
non-decreasing sequence, stored by Elias-Fano coding: the low bits of every value are packed, the high bits are a bit
vector with one set bit per value.  The end of document i is read by a select on that vector, helped by the position
of every 64th set bit as a 32-bit integer, so that no table of 64-bit offsets is kept.  The document ids of a shard
are Elias-Fano coded as well.

Shards are written by Spark's own text writer (one row, one file), so task retries and output commits are Spark's
and any file system that Spark knows will do.  The folder names hold a shard's range, its first place in the range and
its number of ids; where it begins in the whole sequence follows from these names and the sizes of the ranges (as
many numbers as there are partitions), without reading any file.  There is one folder for each shard.

Edge cases: a null text is empty and has only the end id; an empty table gives no shard and no row; rows that repeat
a doc_id are all kept, next to one another, in the order of a hash of their texts; rows whose doc_id is null come
first, in this order; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import tokens
from .common import Scratch, partitions, texts

MAGIC = b"EFTS"
#: magic, version, bytes per id, documents, of these without id, ids, lengths of the two Elias-Fano parts
HEADER = struct.Struct("<4sBBxxIIQqII")
SAMPLE = 64
#: A shard is closed when it holds so many ids.
SHARD_IDS = 4_000_000


class EliasFano:
    """A non-decreasing sequence of integers from 0 on, in about 2 + log2(greatest / count) bits each."""

    HEAD = struct.Struct("<IBxxxQI")

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray, greatest: int):
        self.n, self.low_bits, self.low, self.high, self.samples, self.greatest = n, low_bits, low, high, samples, greatest

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        greatest = int(v[-1]) if n else 0
        bits = max(0, (greatest // n).bit_length() - 1) if n else 0
        if bits:
            planes = ((v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
            low = np.packbits(planes.ravel(), bitorder="little")
        else:
            low = np.zeros(0, np.uint8)
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        vector = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        vector[ones] = 1
        return cls(n, bits, low, np.packbits(vector, bitorder="little"), ones[::SAMPLE].astype("<u4"), greatest)

    def to_bytes(self) -> bytes:
        return self.HEAD.pack(self.n, self.low_bits, self.greatest, len(self.high)) + self.samples.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, bits, greatest, n_high = cls.HEAD.unpack_from(data)
        at = cls.HEAD.size
        samples = np.frombuffer(data, "<u4", -(-n // SAMPLE), at)
        at += samples.nbytes
        low = np.frombuffer(data, np.uint8, -(-n * bits // 8), at)
        return cls(n, bits, low, np.frombuffer(data, np.uint8, n_high, at + low.nbytes), samples, greatest)

    def _low(self, i: int) -> int:
        at = i * self.low_bits
        word = int.from_bytes(self.low[at >> 3 : (at + self.low_bits + 7) >> 3].tobytes(), "little")
        return (word >> (at & 7)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The value at place i: the place of the i-th set bit less i, and the low bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        word = int(self.high[byte]) >> (at & 7) << (at & 7)
        while (count := word.bit_count()) <= left:
            left -= count
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        return (one - i) << self.low_bits | self._low(i)

    def to_array(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        v = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            planes = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
            v |= (planes.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return v


def pack_shard(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """doc_ids ascending, without ids first; ids: the documents' ids as bytes of 32-bit integers."""
    known = [d for d in doc_ids if d is not None]
    base = known[0] if known else 0
    ends = EliasFano.of(np.cumsum([len(b) // 4 for b in ids], dtype=np.uint64)).to_bytes()
    names = EliasFano.of(np.array([d - base for d in known], dtype=np.uint64)).to_bytes()
    flat = np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}")
    return HEADER.pack(MAGIC, 1, width, len(ids), len(ids) - len(known), len(flat), base, len(names), len(ends)) + names + ends + flat.tobytes()


class Shard:
    """A shard's bytes, read in place."""

    def __init__(self, data: bytes):
        magic, version, width, self.n_docs, self.n_null, self.n_ids, self.base, n_names, n_ends = HEADER.unpack_from(data)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token shard")
        at = HEADER.size
        self.names = EliasFano.from_bytes(data[at : at + n_names])
        self.ends = EliasFano.from_bytes(data[at + n_names : at + n_names + n_ends])
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, at + n_names + n_ends)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + [self.base + int(x) for x in self.names.to_array()]

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds(i)
        return self.ids[start:end]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, glued: bool = True, shard_ids: int = SHARD_IDS) -> None:
    """Encode the whole texts of ``docs`` and write them as shards below ``path`` in ascending doc_id order.

    One shuffle by ranges of doc_id and a hash of the text puts the texts in order; rows that repeat a doc_id, or have
    none, are spread over ranges by their texts.
    """

    def shards(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        enc = tokens.encoder(tokenizer, glued)
        width = 2 if max(enc.tok.get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else 4
        end = struct.pack("<I", end_id)
        names: list = []
        ids: list[bytes] = []
        first, count, part = 0, 0, TaskContext.get().partitionId()

        def row():
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "first": pa.array([first], pa.int64()), "n_ids": pa.array([count], pa.int64()), "data": pa.array([pack_shard(names, ids, width)], pa.binary())})

        for batch in batches:
            found = enc.encode_all(batch.column("text").to_pylist())
            for d, b in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                names.append(d)
                ids.append(b + end)
                count += len(b) // 4 + 1
                if count >= shard_ids:
                    yield row()
                    names, ids, first, count = [], [], first + count, 0
        if ids:
            yield row()

    order = ["doc_id", F.xxhash64("text"), "text"]
    rows = texts(docs).repartitionByRange(partitions(docs.sparkSession), *order[:2]).sortWithinPartitions(*order)
    made = rows.mapInArrow(shards, "part int, first long, n_ids long, data binary")
    made.select("part", "first", "n_ids", F.col("data").cast("string").alias("value")).write.mode("overwrite").partitionBy("part", "first", "n_ids").text(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The shards below ``path``: content, and shard_start, the number of ids in all shards before.

    Contents stay where they are read: what they meet is one number for each range, which is broadcast.
    """
    schema = "path string, modificationTime timestamp, length long, content binary, part int, first long, n_ids long"
    files = spark.read.format("binaryFile").schema(schema).load(path)
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranges = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("range_start"))
    found = files.select("part", "first", "content").join(F.broadcast(ranges), "part")
    return found.select("content", (F.col("range_start") + F.col("first")).alias("shard_start"))


def documents_of(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document of the shards that read_tokens has found."""

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for data, start in zip(batch.column("content"), batch.column("shard_start").to_pylist(), strict=True):
                shard = Shard(data.as_buffer().to_pybytes())
                ends = np.fromiter(map(shard.ends.select, range(shard.ends.n)), np.int64, shard.ends.n)
                starts = np.concatenate(([0], ends[:-1]))
                crcs = [zlib.crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(shard.doc_ids(), pa.int64()), "start": pa.array(starts + start), "n_tokens": pa.array(ends - starts), "ids_crc32": pa.array(crcs, pa.int64())})

    return shards.select("content", "shard_start").mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store(docs: DataFrame, tokenizer: str, end_id: int, glued: bool = True, path: str | None = None) -> DataFrame:
    """Write the documents' ids, read the files back, return doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    if path is None:
        path = Scratch(spark, "token-store").path("shards")
    write_tokens(docs, path, tokenizer, end_id, glued)
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/part=*"))
    if not len(parts):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return documents_of(read_tokens(spark, path))
