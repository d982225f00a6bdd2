"""N-gram Jaccard self-join with prefix filters under several global token orders.

1.  Each text's set of 5-word shingles is hashed; texts with equal sets form one *set*, known by its key.
2.  Shingles travel to shards by hash, packed; a shard counts in how many sets each occurs and sends back those
    that at least two sets share.  A shingle of one set can link nothing, so only its number matters.
3.  Per set, shared shingles are ordered by ascending frequency, ties by a hash; the unshared ones come first.  Two
    sets with Jaccard similarity of at least t share one of the first ``n - ceil(t n) + 1`` shingles of each, under *every*
    such order.  Three orders (frequency with two tie-breaks, and logarithmic frequency with a third) give three prefixes.
4.  The first order's prefixes are the index.  Instead of all pairs of a posting list, one leader per list is compared
    with the rest.  A pair must pass the length and position filters, then share a prefix token under the second and under the
    third order too; whole sets are fetched for the pairs that pass all three, and their shared shingles are counted exactly.
    Lists whose members ended in several components get further leaders, spread over these components, eight times as many in
    each round, until every list is one component or all its pairs of different components are compared.  So no link between
    components is lost, a group of near copies costs its size, not its square, and the rounds are the logarithm of the longest list.

Sets and shingles are told apart by 64-bit hashes.  Defined cases: null or wordless text has an empty set, linked with
nothing; a text of fewer than five words is one shingle; repeated rows and equal texts share a set and so a component;
null ids never name a component unless all its ids are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .common import U64, by_shard, cut, drop, key_bits, pack, packed_rows, part_of, row_key, runs, shard_count, stage, text_bytes, unpack
from .components import components

SHINGLE, PERCENT = 5, 80
#: By how much the leaders of an open list grow from round to round.
MORE_LEADERS = 8


def shingle_sets(batch: tb.Batch, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each document, and offsets by document."""
    data = tb.lower_ascii(batch.data)
    starts, ends, first = tb.words(tb.Batch(data, batch.offsets))
    hashes = tb.word_hashes(data, starts, ends)
    n = np.diff(first)
    place = np.flatnonzero(tb.within(first, width))
    keys = tb.rolling(hashes, width)[place]
    doc = np.searchsorted(first, place, side="right") - 1
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        whole = []
        for d in short:
            own = hashes[first[d] : first[d + 1]]
            whole.append(tb.mix(tb.rolling(own, len(own)) + U64(len(own))))
        keys, doc = np.concatenate([keys, *whole]), np.concatenate([doc, short])
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    keys, doc = keys[new], doc[new]
    return keys, np.searchsorted(doc, np.arange(len(batch) + 1))


def set_keys(keys: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set; 0 for the empty one."""
    n = np.diff(offsets)
    out = np.zeros(len(n), U64)
    full = np.flatnonzero(n)
    if len(full):
        sums = np.add.reduceat(tb.mix(keys + U64(0x1234567)), offsets[full])
        turns = np.bitwise_xor.reduceat(tb.mix(keys ^ U64(0xFEDCBA987654321)), offsets[full])
        out[full] = tb.mix(sums ^ tb.mix(turns + n[full].astype(U64))) | U64(1)
    return out


def documents_sets(docs: DataFrame) -> DataFrame:
    """Row key, doc_id, n_shingles and set key of each document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tb.joined(batches, "text", tb.BATCH_BYTES):
            keys, offsets = shingle_sets(tb.Batch.of(rows.column("text")))
            yield pa.record_batch([rows.column("key"), rows.column("doc_id"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(set_keys(keys, offsets).view(np.int64))], ["key", "doc_id", "n_shingles", "set_key"])

    keyed = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    return stage(keyed.mapInArrow(task, "key long, doc_id long, n_shingles long, set_key long"), "shingle-sets")


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (n * PERCENT + 99) // 100 + 1


def _log2(x: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(x)).astype(np.int64)


def candidate_sets(docs: DataFrame, n: int, bits: int) -> DataFrame:
    """set_key, n, shared, rank, the prefixes p1 (longs), p2 and p3 (32-bit cuts of the shingles), rest (packed: all shared shingles).

    Only sets whose first prefix reaches a shared shingle appear.  Shingles keep ``bits`` bits, so many that a chance
    match within a pair of sets is rarer than one in a million.  ``rank`` is the mean logarithm of the shingles' frequency.
    """
    low = U64(64 - bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tb.joined(batches, "text", tb.BATCH_BYTES):
            keys, offsets = shingle_sets(tb.Batch.of(rows.column("text")))
            names, size = set_keys(keys, offsets), np.diff(offsets)
            _, at = np.unique(names, return_index=True)
            once = np.zeros(len(names), bool)
            once[at] = True
            once &= size > 0
            doc = np.repeat(np.arange(len(names)), size)
            keep = once[doc]
            keys, doc = keys[keep] >> low, doc[keep]
            order = np.argsort(keys)
            keys, doc = keys[order], doc[order]
            out = []
            for shard, own in cut(keys << low, n):
                used, local = np.unique(doc[own], return_inverse=True)
                out.append((shard, pack(keys[own], local.astype(np.uint16 if len(used) <= 65_536 else np.uint32), names[used], size[used].astype(np.uint32))))
            yield packed_rows(out)

    def count(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        keys, names, sizes = [], [], []
        while payloads:
            k, local, name, size = unpack(payloads.pop())
            keys.append(k), names.append(name[local]), sizes.append(size[local])
        key, name, size = np.concatenate(keys), np.concatenate(names), np.concatenate(sizes)
        del keys, names, sizes
        order = np.argsort(key)
        ordered = key[order]
        same = ordered[1:] == ordered[:-1]
        order = order[np.r_[False, same] | np.r_[same, False]]
        key, name, size = key[order], name[order], size[order]
        order = np.lexsort((name, key))
        key, name, size = key[order], name[order], size[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
        key, name, size = key[new], name[new], size[new]
        start, length = runs(key)
        often = np.repeat(length, length).astype(np.uint32)
        keep = often > 1
        key, name, size, often = key[keep], name[keep], size[keep], often[keep]
        part = part_of(name, n)
        order = np.lexsort((key, name, part))
        part, key, name, size, often = part[order], key[order], name[order], size[order], often[order]
        out = []
        for a, k in zip(*runs(part), strict=True):
            own = slice(a, a + k)
            s, length = runs(name[own])
            out.append((int(part[a]), pack(name[own][s], length.astype(np.uint32), size[own][s], key[own], often[own])))
        yield packed_rows(out)

    def prefixes(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        names, sizes, keys, oftens = [], [], [], []
        while payloads:
            name, length, size, key, often = unpack(payloads.pop())
            names.append(np.repeat(name, length)), sizes.append(np.repeat(size, length)), keys.append(key), oftens.append(often)
        name, size, key, often = (np.concatenate(x) for x in (names, sizes, keys, oftens))
        del names, sizes, keys, oftens
        size = size.astype(np.int64)
        start, shared = runs(np.sort(name))
        order = np.lexsort((tb.mix(key), often, name))
        name, size, key, often = name[order], size[order], key[order], often[order]
        take = prefix_length(size[start]) - (size[start] - shared)
        rows: list[tuple] = []
        for i in np.flatnonzero(take > 0):
            own = slice(start[i], start[i] + shared[i])
            k, f = key[own], often[own].astype(np.int64)
            second, third = np.lexsort((tb.mix(k ^ U64(0x5DEECE66D)), f)), np.lexsort((tb.mix(k ^ U64(0x9E3779B9)), _log2(f)))
            rank = int(1000 * np.log2(f).sum() / size[own.start])
            prefixes = [(tb.mix(k[order[: take[i]]]) >> U64(32)).astype(np.uint32).view(np.int32) for order in (second, third)]
            rows.append((int(name[own.start].view(np.int64)), int(size[own.start]), len(k), rank, k[: take[i]].view(np.int64), *prefixes, pack(np.sort(k))))
            if len(rows) == 2000:
                yield _rows(rows)
                rows = []
        yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
        return pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["set_key", "n", "shared", "rank", "p1", "p2", "p3", "rest"])

    sent = docs.select("text").mapInArrow(send, "shard int, payload binary")
    counted = by_shard(sent, n, count, "shard int, payload binary")
    return stage(by_shard(counted, n, prefixes, "set_key long, n long, shared long, rank long, p1 array<long>, p2 array<int>, p3 array<int>, rest binary"), "jaccard-candidates")


def other_orders(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v of each pair, and whether they share a prefix token under the second and under the third order."""
    left = sets.select(F.col("set_key").alias("u"), F.col("p2").alias("u2"), F.col("p3").alias("u3"))
    right = sets.select(F.col("set_key").alias("v"), F.col("p2").alias("v2"), F.col("p3").alias("v3"))
    both = pairs.join(right, "v").join(left, "u")
    return both.select("u", "v", F.arrays_overlap("u2", "v2").alias("second"), F.arrays_overlap("u3", "v3").alias("third"))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (u, v) that are similar: their whole sets are fetched and the shared shingles counted."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}

        def opened(raw: bytes) -> np.ndarray:
            got = held.get(raw)
            if got is None:
                if len(held) > 256:
                    held.clear()
                got = held[raw] = unpack(raw)[0]
            return got

        for b in batches:
            good = np.zeros(b.num_rows, bool)
            for i, (n, m, x, y) in enumerate(zip(b.column("n").to_pylist(), b.column("m").to_pylist(), b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)):
                p, q = sorted((opened(x), unpack(y)[0]), key=len)
                both = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
                good[i] = 100 * both >= PERCENT * (n + m - both)
            yield b.select(["u", "v"]).filter(pa.array(good))

    left = sets.select(F.col("set_key").alias("u"), "n", F.col("rest").alias("x"))
    right = sets.select(F.col("set_key").alias("v"), F.col("n").alias("m"), F.col("rest").alias("y"))
    return pairs.join(right, "v").join(left, "u").select("u", "v", "n", "m", "x", "y").mapInArrow(task, "u long, v long")


def link(sets: DataFrame) -> DataFrame:
    """node, root of every set that is linked to another, with all components found."""
    spark = sets.sparkSession
    # ``left``: shared shingles from this one on in the first order.  If it is the first that two sets have in common,
    # they have no more than that in common.
    lists = sets.select(F.posexplode("p1").alias("at", "token"), "set_key", "n", "shared", "rank").withColumn("left", F.col("shared") - F.col("at")).drop("at", "shared")
    several = lists.groupBy("token").agg(F.count("*").alias("k")).filter("k > 1").select("token")
    lists = stage(lists.join(several, "token", "left_semi"), "jaccard-lists")
    active = lists.withColumn("root", F.col("set_key"))
    roots = spark.createDataFrame([], "node long, root long")
    leaders, used = 1, [lists]
    while True:
        # lists with sets of several components, and in them the sets that may still meet another one
        still = active.groupBy("token").agg(F.min("n").alias("least_n"), (F.min("root") != F.max("root")).alias("open")).filter("open")
        named = active.join(still, "token").filter(9 * F.col("left") >= 4 * (F.col("n") + F.col("least_n"))).drop("least_n", "open")
        named = stage(named, "jaccard-open")
        drop(*used)
        if named.isEmpty():
            drop(named)
            return roots
        # leaders: the set whose shingles are most shared (later: one of the smallest component), and others by chance, as many
        # from each component of a list
        by_root = named.groupBy("token", "root").agg(F.count("*").alias("k"), F.max(F.struct("rank", "set_key"))["set_key"].alias("u"), F.max("rank").alias("rank"))
        first = F.struct("rank", "u") if leaders == 1 else F.struct(-F.col("k"), "rank", "u")
        heads = by_root.groupBy("token").agg(F.max(first)["u"].alias("u"), F.count("*").alias("parts"))
        each = heads.select("token", "u")
        if leaders > 1:
            members = named.select("token", "root", "set_key").join(by_root.select("token", "root", "k"), ["token", "root"]).join(heads.select("token", "parts"), "token")
            chance = members.filter(F.pmod(F.xxhash64("set_key", "token", F.lit(leaders)), F.col("k") * F.col("parts")) < leaders)
            each = each.unionByName(chance.select("token", F.col("set_key").alias("u"))).distinct()
        each = stage(each, "jaccard-heads")
        own = each.join(named.select("token", F.col("set_key").alias("u"), F.col("root").alias("u_root"), F.col("n").alias("u_n"), F.col("left").alias("u_left")), ["token", "u"])
        # length and position filters: both must be large enough, and what is left of them must suffice
        fits = 9 * F.least("left", "u_left") >= 4 * (F.col("n") + F.col("u_n"))
        pairs = named.join(own, (named.token == own.token) & (F.col("root") != F.col("u_root")) & (100 * F.least("n", "u_n") >= PERCENT * F.greatest("n", "u_n")) & fits)
        pairs = stage(pairs.select("u", F.col("set_key").alias("v")).distinct(), "jaccard-pairs")
        passed = stage(other_orders(pairs, sets).filter("second AND third").select("u", "v"), "jaccard-passed")
        found = stage(verify(passed, sets), "jaccard-links")
        drop(pairs, passed)
        used = [named, each]
        active = named.join(each.withColumnRenamed("u", "set_key"), ["token", "set_key"], "left_anti")
        if not found.isEmpty():
            # earlier components enter as stars
            roots = components(found.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v"))))
            active = active.drop("root").join(roots.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))
        leaders *= MORE_LEADERS


def near_duplicates(docs: DataFrame) -> DataFrame:
    """key (of the row), doc_id, n_shingles, set_key, component_id: the least doc_id that links reach."""
    size = text_bytes(docs)
    n = shard_count(docs.sparkSession, size)
    members = documents_sets(docs)
    sets = candidate_sets(docs, n, max(48, min(64, key_bits(size) + 8)))
    roots = link(sets).select(F.col("node").alias("set_key"), "root")
    by_set = members.filter("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("least"), F.count("*").alias("k"))
    rooted = stage(by_set.join(roots, "set_key", "left").withColumn("root", F.coalesce("root", "set_key")), "jaccard-rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"), F.sum("k").alias("k")).filter("k > 1")
    named = rooted.join(least, "root").select("set_key", "component")
    # texts without words have no set to join on
    full = members.filter("n_shingles > 0").join(named, "set_key", "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    empty = members.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["key", "doc_id", "n_shingles", "set_key", "component_id"]
    return full.select(columns).unionByName(empty.select(columns))


def op7_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
