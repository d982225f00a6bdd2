"""Token-id output: raw id shards and a minimal perfect hash index for constant-time keyed access.

Files.  ``write_shards`` range-partitions documents by id and writes one file per partition: a 16-byte header
(``LFIDS001``, the id width in bytes as u32, u32 zero) and the documents' ids as little-endian integers, end to end.
A task writes under a name of its own attempt and reports it in the rows it returns; only rows of finished attempts
reach the staged manifest, so a lost executor or a repeated task leaves at worst an unreferenced file.

Index.  Keys are dealt into buckets of a bounded size by hash.  Each bucket holds a minimal perfect hash in levels of
bits: a key sits at the first level where its place is its own, its slot is the number of set bits before that place.
A slot stores a 32-bit fingerprint, the shard, the offset and the length, so a lookup reads one bucket, a few bits and
one byte range of one file.  A key is a bijection of the document's id, so different documents never share one; what the
levels leave over (at most ``LEVELS`` of them are built) stands in a sorted list behind the slots.  Repeated ids beyond the
first and null ids are no keys of the hash: they are looked up by an equi-join on (doc_id, occurrence).

Defined cases: a null text has no ids but its end id; documents with equal ids are told apart by their order of text
(key ``(doc_id, occurrence)``); a null id comes first; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textblocks as tb
from .common import pack, runs, scratch, shards_for, stage, unpack
from .tokens import default_path, tokenizer, with_end

MAGIC = b"LFIDS001"
HEADER = 16
#: Keys in one bucket of the index, on average, and in one partition of buckets.
BUCKET_KEYS, PART_KEYS = 20_000, 1_000_000
#: Levels of a perfect hash; a random key needs more with a chance of about 0.4 ** 48.
LEVELS = 48
#: Bytes that one read of a shard asks for at most, and bytes between two documents that it rather reads than skips.
READ_BYTES, GAP_BYTES = 4 << 20, 64 << 10
ENTRIES = "doc_id long, occurrence long, part int, name string, at long, n_tokens long"


def _open_dir(uri: str):
    from pyarrow import fs

    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[5:]
    files, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://"))
    return files, path


def write_shards(docs: DataFrame, uri: str, *, tokenizer_path: str | None = None, end_id: int | None = 1, width: int = 2) -> DataFrame:
    """Write ``docs`` (doc_id, text) as id shards below ``uri``; one entry row per document, staged as a table.

    ``width``: bytes an id takes in the files (2 holds vocabularies up to 65,536; an id that doesn't fit is an error).
    """
    where = tokenizer_path or default_path()
    n = shards_for(docs)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib, part = tokenizer(where), TaskContext.get().partitionId()
        files, path = _open_dir(uri)
        files.create_dir(path, recursive=True)
        name = f"ids-{part:06d}-{uuid.uuid4().hex}.bin"
        at, last, seen = 0, object(), 0
        sink = None
        for batch in tb.joined(batches, "text", tb.BATCH_BYTES):
            if sink is None:
                sink = files.open_output_stream(f"{path}/{name}")
                sink.write(MAGIC + struct.pack("<II", width, 0))
            ids, offsets = lib.encode(tb.Batch.of(batch.column("text")))
            ids, offsets = with_end(ids, offsets, end_id, width)
            counts = np.diff(offsets)
            sink.write(ids)
            occurrence = []
            for d in (doc_ids := batch.column("doc_id").to_pylist()):
                seen = seen + 1 if d == last else 0
                last = d
                occurrence.append(seen)
            ends = at + np.cumsum(counts)
            k = len(doc_ids)
            yield pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(occurrence, pa.int64()), pa.array([part] * k, pa.int32()), pa.array([name] * k), pa.array(ends - counts), pa.array(counts)], ["doc_id", "occurrence", "part", "name", "at", "n_tokens"])
            at = int(ends[-1])
        if sink is not None:
            sink.close()

    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    entries = stage(ordered.mapInArrow(task, ENTRIES), "id-entries")
    return _numbered(entries)


def _numbered(entries: DataFrame) -> DataFrame:
    """Equal ids may straddle partitions: they go on counting where the partition before stopped.

    Only a partition's first and last id can straddle, so what is joined has at most two ids for each partition.
    """
    edges = entries.groupBy("part").agg(F.min_by("doc_id", "at").alias("a"), F.max_by("doc_id", "at").alias("b"))
    edges = edges.select(F.explode(F.array("a", "b")).alias("edge")).distinct()
    here = entries.join(F.broadcast(edges), F.col("doc_id").eqNullSafe(F.col("edge"))).groupBy("edge", "part").agg(F.count("*").alias("k"))
    before = here.select("edge", F.col("part").alias("in_part"), (F.sum("k").over(Window.partitionBy("edge").orderBy("part")) - F.col("k")).alias("before")).filter("before > 0")
    on = F.col("doc_id").eqNullSafe(F.col("edge")) & (F.col("part") == F.col("in_part"))
    return entries.join(F.broadcast(before), on, "left").withColumn("occurrence", F.col("occurrence") + F.coalesce("before", F.lit(0))).drop("edge", "in_part", "before")


def shard_starts(entries: DataFrame) -> DataFrame:
    """part, name, start: ids before each shard.  One row per file goes through the window, not one per document."""
    sizes = entries.groupBy("part", "name").agg(F.sum("n_tokens").alias("ids"))
    return sizes.select("part", "name", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("start"))


# ---------------------------------------------------------------------------------------------- index
def keys_of(doc_ids: np.ndarray) -> np.ndarray:
    """Keys of ids: a bijection of 64-bit integers."""
    return tb.mix(doc_ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return tb.mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)


def build_mph(keys: np.ndarray, most: int = LEVELS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Levels of bits, the sorted keys that ``most`` levels leave over, and each key's slot in 0..n-1."""
    levels: list[np.ndarray] = []
    slots, left, base = np.zeros(len(keys), np.int64), np.arange(len(keys)), 0
    while len(left) and len(levels) < most:
        size = max(64, 2 * len(left))
        at = _place(keys[left], len(levels), size)
        alone = np.bincount(at.astype(np.int64), minlength=size) == 1
        mine = alone[at.astype(np.int64)]
        rank = np.cumsum(alone) - 1
        slots[left[mine]] = base + rank[at[mine].astype(np.int64)]
        base += int(alone.sum())
        levels.append(alone)
        left = left[~mine]
    left = left[np.argsort(keys[left], kind="stable")]
    slots[left] = base + np.arange(len(left))
    return levels, keys[left], slots


def find_slots(levels: list[np.ndarray], rest: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Slot of each key; -1 where nothing holds it.  A key that was never put in may get another's slot."""
    out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for k, bits in enumerate(levels):
        at = _place(keys[left], k, len(bits)).astype(np.int64)
        hit = bits[at]
        out[left[hit]] = base + (np.cumsum(bits) - 1)[at[hit]]
        base += int(bits.sum())
        left = left[~hit]
    if len(rest):
        at = np.minimum(np.searchsorted(rest, keys[left]), len(rest) - 1)
        hit = rest[at] == keys[left]
        out[left[hit]] = base + at[hit]
    return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (tb.mix(keys ^ np.uint64(0xA5A5A5A55A5A5A5A)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


#: A document that the perfect hash holds; the others are found by a join.
HASHED = "doc_id is not null and occurrence = 0"


def _dealt(df: DataFrame, buckets: int) -> tuple[DataFrame, int]:
    """``df`` with the bucket of each id, and how many partitions the buckets are dealt into."""
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")
    spark = df.sparkSession
    return df.withColumn("bucket", bucket), max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-buckets * BUCKET_KEYS // PART_KEYS))


def build_index(entries: DataFrame) -> tuple[DataFrame, int]:
    """bucket, levels, slots: one row per bucket; and the number of buckets."""
    hashed = entries.filter(HASHED)
    buckets = max(1, -(-hashed.count() // BUCKET_KEYS))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        bucket = np.asarray(table.column("bucket"))
        order = np.argsort(bucket, kind="stable")
        start, size = runs(bucket[order])
        ids, part, at, n = (np.asarray(table.column(c)) for c in ("doc_id", "part", "at", "n_tokens"))
        for s, k in zip(start, size, strict=True):
            rows = order[s : s + k]
            own = keys_of(ids[rows])
            levels, rest, slots = build_mph(own)
            place = np.argsort(slots)
            bits = pack(np.array([len(b) for b in levels], np.int64), rest, *[np.packbits(b) for b in levels])
            held = pack(fingerprints(own[place]), part[rows[place]].astype(np.int32), at[rows[place]].astype(np.int64), n[rows[place]].astype(np.int64))
            yield pa.record_batch([pa.array([int(bucket[rows[0]])], pa.int32()), pa.array([bits], pa.binary()), pa.array([held], pa.binary())], ["bucket", "levels", "slots"])

    keyed, parts = _dealt(hashed.select("doc_id", "part", "at", "n_tokens"), buckets)
    dealt = keyed.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int"))
    return stage(dealt.mapInArrow(task, "bucket int, levels binary, slots binary"), "id-index"), buckets


PLACE = ("doc_id", "occurrence", "part", "at", "n_tokens")


def locate(keys: DataFrame, index: DataFrame, buckets: int, entries: DataFrame) -> DataFrame:
    """Look up (doc_id, occurrence) rows: adds part, at, n_tokens; keys that aren't there are left out.

    First occurrences come from the index; repeated and null ids, which it doesn't hold, from their entries.
    """
    left, parts = _dealt(keys.select("doc_id", "occurrence").filter(HASHED), buckets)
    both = left.withColumns({"kind": F.lit(1), "levels": F.lit(None).cast("binary"), "slots": F.lit(None).cast("binary")}).unionByName(index.withColumn("kind", F.lit(0)), allowMissingColumns=True)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for b in batches:
            kind, bucket = np.asarray(b.column("kind")), np.asarray(b.column("bucket"))
            for s, k in zip(*runs(bucket), strict=True):
                if bucket[s] != now:
                    now, held = bucket[s], None
                if kind[s] == 0:
                    sizes, rest, *bits = unpack(b.column("levels")[int(s)].as_py())
                    held = ([np.unpackbits(x)[:size].astype(bool) for size, x in zip(sizes, bits, strict=True)], rest, *unpack(b.column("slots")[int(s)].as_py()))
                    s, k = s + 1, k - 1
                if not k or held is None:
                    continue
                levels, rest, prints, part, at, n = held
                mine = b.slice(int(s), int(k))
                own = keys_of(np.asarray(mine.column("doc_id")))
                slot = find_slots(levels, rest, own)
                good = (slot >= 0) & (prints[np.maximum(slot, 0)] == fingerprints(own))
                pick, slot = pa.array(np.flatnonzero(good)), slot[good]
                yield pa.record_batch([mine.column("doc_id").take(pick), mine.column("occurrence").take(pick), pa.array(part[slot]), pa.array(at[slot]), pa.array(n[slot])], list(PLACE))

    dealt = both.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int")).sortWithinPartitions("bucket", "kind")
    found = dealt.mapInArrow(task, "doc_id long, occurrence long, part int, at long, n_tokens long")
    other = keys.filter(f"not ({HASHED})").select(F.col("doc_id").alias("__id"), F.col("occurrence").alias("__n"))
    again = entries.filter(f"not ({HASHED})").join(other, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("occurrence") == F.col("__n"))).select(*PLACE)
    return found.unionByName(again)


def read_ids(places: DataFrame, files: DataFrame, uri: str, width: int = 2) -> DataFrame:
    """Read each place's ids back from its shard: doc_id, occurrence, start, n_tokens, ids_crc32.

    Places are read in the order of the files, neighbours in one read.
    """
    kind = np.dtype(f"<u{width}")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open_dir(uri)
        name, source = None, None
        for b in batches:
            names, at, n = b.column("name").to_pylist(), np.asarray(b.column("at")), np.asarray(b.column("n_tokens"))
            crc, i = np.zeros(len(names), np.int64), 0
            while i < len(names):
                if names[i] != name:
                    if source is not None:
                        source.close()
                    name, source = names[i], store.open_input_file(f"{path}/{names[i]}")
                    if source.read_at(16, 0) != MAGIC + struct.pack("<II", width, 0):
                        raise ValueError(f"{name} is not a shard of {width}-byte ids")
                low, high, j = int(at[i]), int(at[i] + n[i]), i + 1
                while j < len(names) and names[j] == name and (at[j] - high) * width <= GAP_BYTES and (at[j] + n[j] - low) * width <= READ_BYTES:
                    high, j = max(high, int(at[j] + n[j])), j + 1
                ids = memoryview(np.frombuffer(source.read_at((high - low) * width, HEADER + low * width), kind).astype("<u4")).cast("B")
                for k in range(i, j):
                    first = 4 * (int(at[k]) - low)
                    crc[k] = zlib.crc32(ids[first : first + 4 * int(n[k])])
                i = j
            yield pa.record_batch([b.column("doc_id"), b.column("occurrence"), b.column("start"), b.column("n_tokens"), pa.array(crc)], ["doc_id", "occurrence", "start", "n_tokens", "ids_crc32"])
        if source is not None:
            source.close()

    shards = files.count()
    known = F.broadcast(files) if shards <= 200_000 else files
    found = places.join(known, "part").select("doc_id", "occurrence", "part", "name", "at", (F.col("start") + F.col("at")).alias("start"), "n_tokens")
    n = max(1, shards)
    dealt = found.withColumn("part", F.pmod("part", F.lit(n)).cast("int")).repartitionById(n, F.col("part")).sortWithinPartitions("name", "at")
    return dealt.mapInArrow(task, "doc_id long, occurrence long, start long, n_tokens long, ids_crc32 long")


def op10_token_output(spark, sf_dir: str) -> DataFrame:
    """Write every document's ids, index them, and read each back through the index."""
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    uri = scratch(spark, "id-shards")
    entries = write_shards(docs, uri)
    index, buckets = build_index(entries)
    places = locate(entries.select("doc_id", "occurrence"), index, buckets, entries)
    back = read_ids(places, shard_starts(entries), uri)
    return back.select("doc_id", "start", "n_tokens", "ids_crc32")
