"""Packing along a space-filling curve.

A document's hashed bag of ids (64 signed buckets, unit length) is projected to four dimensions by a fixed random
matrix and placed on a Hilbert curve.  Documents are range-sorted by that key and laid end to end; the line is cut
every 4096 ids.  So every sequence but the last is full, a sequence's documents are neighbours on the curve, and
no partition border wastes room: positions come from per-partition sums, not from a global window.

Defined cases: a null text is its end id only; equal keys are ordered by id and row; documents with equal ids are
packed each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textblocks as tb
from .common import shards_for, stage
from .tokens import default_path, tokenizer, with_end

BUCKETS, DIMS, BITS = 64, 4, 12
LENGTH = 4096
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _projection() -> np.ndarray:
    return np.random.default_rng(17).standard_normal((BUCKETS, DIMS)).astype(np.float32)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (n, d), each coordinate below 2**bits; d * bits at most 63.

    Per bit level from the top: undo the rotation that the levels above imply, then read the level's bits in Gray order.
    """
    x = points.astype(np.int64).T.copy()
    d = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(d):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
        level >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where((x[d - 1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


@lru_cache(maxsize=2)
def _id_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and sign of each id below ``size``."""
    mixed = tb.mix(np.arange(1, size + 1, dtype=np.uint64))
    return (mixed % np.uint64(BUCKETS)).astype(np.int64), np.where((mixed >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)


def curve_keys(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hilbert key of each document of ids."""
    n = len(offsets) - 1
    bucket, sign = _id_table(1 << max(int(ids.max(initial=0)).bit_length(), 16))
    doc = np.repeat(np.arange(n) * BUCKETS, np.diff(offsets))
    bags = np.bincount(doc + bucket[ids], weights=sign[ids], minlength=n * BUCKETS).astype(float).reshape(n, BUCKETS)
    bags /= np.maximum(np.linalg.norm(bags, axis=1, keepdims=True), 1e-9)
    flat = np.tanh(bags @ _projection())
    return hilbert(((flat + 1) / 2 * ((1 << BITS) - 1)).astype(np.int64), BITS)


def place_documents(docs: DataFrame, *, tokenizer_path: str | None = None, end_id: int | None = 2, width: int = 2) -> DataFrame:
    """rid, doc_id, curve, n_tokens, ids (little-endian, ``width`` bytes each) of each document, staged."""
    where = tokenizer_path or default_path()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = tokenizer(where)
        at = TaskContext.get().partitionId() << 40
        for batch in tb.joined(batches, "text", tb.BATCH_BYTES):
            ids, offsets = lib.encode(tb.Batch.of(batch.column("text")))
            keys = curve_keys(ids, offsets)
            raw, offsets = with_end(ids, offsets, end_id, width)
            n = len(keys)
            values = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer((offsets * width).astype(np.int64)), pa.py_buffer(raw)])
            yield pa.record_batch([pa.array(np.arange(at, at + n)), batch.column("doc_id"), pa.array(keys), pa.array(np.diff(offsets)), values.cast(pa.binary())], ["rid", "doc_id", "curve", "n_tokens", "ids"])
            at += n

    return stage(docs.select("doc_id", "text").mapInArrow(task, "rid long, doc_id long, curve long, n_tokens long, ids binary"), "packing-ids")


def lay_out(placed: DataFrame, order: list[str], size: str, n: int) -> DataFrame:
    """rid, at: the sum of ``size`` over all rows before this one in ``order``, which must end in a unique column."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            ends = at + np.cumsum(np.asarray(b.column(size)))
            yield pa.record_batch([b.column("rid"), pa.array([part] * b.num_rows, pa.int32()), pa.array(ends - np.asarray(b.column(size))), pa.array(ends)], ["rid", "part", "at", "ends"])
            at = int(ends[-1]) if len(ends) else at

    ordered = placed.select(*order, size).repartitionByRange(n, *order).sortWithinPartitions(*order)
    local = stage(ordered.mapInArrow(task, "rid long, part int, at long, ends long"), "packing-order")
    sums = local.groupBy("part").agg(F.max("ends").alias("total"))
    before = sums.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    return local.join(F.broadcast(before), "part").select("rid", (F.col("at") + F.col("before")).alias("at"))  # a row per partition


def cut_sequences(placed: DataFrame, places: DataFrame, length: int = LENGTH, width: int = 2) -> DataFrame:
    """A row per piece of a document: ``PIECES`` and the ids themselves are cut at every ``length`` ids of the line."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = tb.Batch.of(b.column("ids"))
            wide = memoryview(raw.data.view(f"<u{width}").astype("<u4").tobytes())
            at, n = np.asarray(b.column("at")), np.asarray(b.column("n_tokens"))
            first = at // length
            pieces = np.where(n > 0, (at + n - 1) // length - first + 1, 0)
            own = np.repeat(np.arange(len(n)), pieces)
            seq = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin, end = np.maximum(seq * length, at[own]), np.minimum((seq + 1) * length, (at + n)[own])
            byte = 4 * (raw.offsets[own] // width + begin - at[own])
            crc = [zlib.crc32(wide[x:y]) for x, y in zip(byte.tolist(), (byte + 4 * (end - begin)).tolist(), strict=True)]
            columns = (begin - at[own], end - begin, np.array(crc, np.int64), n[own], seq, begin - seq * length)
            yield pa.record_batch([b.column("doc_id").take(pa.array(own)), *map(pa.array, columns)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return placed.select("rid", "doc_id", "n_tokens", "ids").join(places, "rid").select("doc_id", "at", "n_tokens", "ids").mapInArrow(task, PIECES)


def pack(docs: DataFrame, width: int = 2, **kw) -> DataFrame:
    """Pieces of all documents, packed along the curve.  ``width``: bytes an id takes on its way (2: vocabularies up to 65,536)."""
    n = shards_for(docs)
    placed = place_documents(docs, width=width, **kw)
    return cut_sequences(placed, lay_out(placed, ["curve", "doc_id", "rid"], "n_tokens", n), width=width)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return pack(table(spark, sf_dir, "documents"))
