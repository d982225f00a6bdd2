"""Shared pieces of the training-data operators: tables, scratch space, packed arrays and two-way exchanges.

The heavy operators send *packed arrays* instead of one row per n-gram: a task turns its documents into sorted
64-bit keys, cuts them by key range into shards and emits one binary row per shard.  Spark shuffles those rows;
a shard's task merges what it gets with a few numpy calls and answers in the same form.  Sorted keys are stored
as differences, byte plane by byte plane, so a random 64-bit key costs about 5 bytes.  Equal keys of one task
collapse before the shuffle: a batch that holds a key several times knows by itself that it is shared, answers its own
rows and tells the shard of the key once.  So a key that fills a third of the corpus weighs an entry or two per batch.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import scratch, stage  # noqa: F401

U64 = np.uint64

#: Text bytes that one shard or one side partition answers for; their number follows the input's size.
SHARD_BYTES = 24 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop(*staged: DataFrame) -> None:
    """Delete staged steps that nothing reads any more."""
    for df in staged:
        jvm = df.sparkSession.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def small(x: np.ndarray) -> np.ndarray:
    """Non-negative integers as 32-bit ones if they fit, else as 64-bit ones."""
    return x.astype(np.uint32 if not len(x) or int(x.max()) < 1 << 32 else U64)


def key_bits(size: int) -> int:
    """Bits of a hash that a filter over ``size`` bytes of text needs: a chance match is rarer than one in a thousand."""
    return min(64, max(40, int(size).bit_length() + 11))


def shards_for(docs: DataFrame, text: str = "text", each: int = SHARD_BYTES) -> int:
    """How many shards the text of ``docs`` asks for: at least the session's shuffle partitions."""
    return shard_count(docs.sparkSession, text_bytes(docs, text), each)


def shard_count(spark: SparkSession, size: int, each: int = SHARD_BYTES) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def row_key(*columns: str) -> Column:
    """An id made of a row's content, the same in every scan: repeated rows share it."""
    return F.xxhash64(*columns)


# ---------------------------------------------------------------------------------------------- packed arrays
def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays to bytes.  Non-descending unsigned arrays are stored as differences.  ``level``: of the compression."""
    out = [struct.pack("<B", len(arrays))]
    squeeze = zstandard.ZstdCompressor(level=level)
    for a in arrays:
        a = np.ascontiguousarray(a)
        n, kind = len(a), a.dtype.str.encode()
        rising = a.dtype.kind == "u" and n > 1 and bool((a[1:] >= a[:-1]).all())
        if rising:
            a = np.concatenate([a[:1], np.diff(a)])
        planes = np.ascontiguousarray(a.view(np.uint8).reshape(n, -1).T) if n else np.zeros(0, np.uint8)
        body = squeeze.compress(planes.tobytes())
        out += [struct.pack("<4sBII", kind, rising, n, len(body)), body]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 1
    expand = zstandard.ZstdDecompressor()
    for _ in range(data[0]):
        kind, rising, n, size = struct.unpack_from("<4sBII", data, at)
        at += 13
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        raw = np.frombuffer(expand.decompress(data[at : at + size]), np.uint8)
        at += size
        a = np.ascontiguousarray(raw.reshape(dtype.itemsize, n).T).view(dtype).ravel() if n else np.zeros(0, dtype)
        out.append(np.cumsum(a, dtype=dtype) if rising else a)
    return out


def shard_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Shard by range of the top 32 bits, so that sorted keys fall into shards in order."""
    return ((keys >> U64(32)) * U64(n)) >> U64(32)


def cut(keys: np.ndarray, n: int) -> Iterator[tuple[int, slice]]:
    """(shard, slice) of each shard that sorted ``keys`` reach."""
    if len(keys):
        shard = shard_of(keys, n).astype(np.int64)
        at = np.flatnonzero(np.diff(shard)) + 1
        for a, b in zip(np.r_[0, at], np.r_[at, len(keys)], strict=True):
            yield int(shard[a]), slice(int(a), int(b))


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each run of equal keys, and the run's length."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.r_[0, np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1]
    return start, np.diff(np.r_[start, len(sorted_keys)])


def copies(names: np.ndarray, most: int) -> np.ndarray:
    """Mask of the first ``most`` rows of each row key."""
    order = np.argsort(names, kind="stable")
    start, length = runs(names[order])
    keep = np.empty(len(names), bool)
    keep[order] = np.arange(len(names)) - np.repeat(start, length) < most
    return keep


# ---------------------------------------------------------------------------------------------- answers by row
def answer_rows(names: np.ndarray, n: int, *values: np.ndarray) -> list[tuple[int, bytes]]:
    """Pack values by the partition of their row key: sorted by row, then by the first value, each pair of these once.

    Copies of a row share its key, so what many copies are told is kept once.
    """
    if not len(names):
        return []
    part = part_of(names, n)
    order = np.lexsort((values[0], names, part))
    again = (names[order][1:] == names[order][:-1]) & (values[0][order][1:] == values[0][order][:-1])
    order = order[np.r_[True, ~again]]
    names, values, part = names[order], [v[order] for v in values], part[order]
    out = []
    for a, k in zip(*runs(part), strict=True):
        own = slice(a, a + k)
        start, length = runs(names[own])
        out.append((int(part[a]), pack(names[own][start], length.astype(np.uint32), *[v[own] for v in values])))
    return out


class Answers:
    """All answers of one partition, looked up by row key."""

    def __init__(self, payloads: list[bytes], width: int):
        names, values = [], [[] for _ in range(width)]
        while payloads:
            name, length, *rest = unpack(payloads.pop())
            names.append(np.repeat(name, length))
            for held, v in zip(values, rest, strict=True):
                held.append(v)
        self.names = np.concatenate(names) if names else np.zeros(0, U64)
        self.values = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in values]
        order = np.lexsort((self.values[0], self.names))
        self.names, self.values = self.names[order], [v[order] for v in self.values]

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """For each key in turn its answers: the key's number, and the values."""
        a, b = np.searchsorted(self.names, keys), np.searchsorted(self.names, keys, side="right")
        size = b - a
        take = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return np.repeat(np.arange(len(keys)), size), [v[take] for v in self.values]


# ---------------------------------------------------------------------------------------------- exchanges
PACKED = "shard int, payload binary"
#: First byte of a payload: a question to the shard of its keys, or an answer that only passes through to its partition.
ASK, PASS = b"Q", b"A"


def packed_rows(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "payload"])


def by_shard(df: DataFrame, n: int, fn: Callable[[list[bytes]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Bring each shard's rows together and answer with ``fn(payloads)``, once per partition of shards."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for s, p in zip(b.column("shard").to_pylist(), b.column("payload").to_pylist(), strict=True):
                held.setdefault(s, []).append(p)
        for s in sorted(held):
            yield from fn(held.pop(s))

    return df.repartitionById(n, F.col("shard")).mapInArrow(task, schema)


def passed_on(payloads: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Questions, and answers that pass through, without their first byte."""
    ask, through = [], []
    while payloads:
        p = payloads.pop()
        (ask if p[:1] == ASK else through).append(p[1:])
    return ask, through


def part_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Partition of a row key, as ``part_column`` gives it."""
    return (keys.view(np.int64) % np.int64(n)).astype(np.int64)


def part_column(key: Column, n: int) -> Column:
    return F.pmod(key, F.lit(n)).cast("int")


def with_side(docs: DataFrame, side: DataFrame, n: int, fn: Callable, schema: str) -> DataFrame:
    """Bring documents and packed answers of the same partition together, answers first.

    ``docs`` has ``key long``, ``doc_id long`` and ``text string``; ``side`` is ``PACKED`` with the partition in ``shard``.
    ``fn(payloads, batches)`` gets a partition's answers as a list and its documents as record batches.
    """
    left = docs.select(part_column(F.col("key"), n).alias("shard"), F.lit(1).alias("kind"), "key", "doc_id", "text", F.lit(None).cast("binary").alias("payload"))
    right = side.select("shard", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("key"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "payload")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payloads: list[bytes] = []

        def rows() -> Iterator[pa.RecordBatch]:
            for b in batches:
                kind = np.asarray(b.column("kind"))
                sides = int(np.searchsorted(kind, 1))
                payloads.extend(b.column("payload").slice(0, sides).to_pylist())
                if sides < b.num_rows:
                    yield b.slice(sides).select(["key", "doc_id", "text"])

        yield from fn(payloads, rows())

    return left.unionByName(right).repartitionById(n, F.col("shard")).sortWithinPartitions("kind").mapInArrow(task, schema)
