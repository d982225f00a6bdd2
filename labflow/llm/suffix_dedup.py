"""Suffix-array deduplication over a sparse suffix array.

Every 50-byte string owns one *anchor*: the place of its 24-byte substring with the least hash.  Equal strings have the
same anchor at the same distance, so only suffixes that begin at anchors (7 in 100 places) need sorting.  The strings
with one anchor are consecutive; they form its *zone*.

1.  Anchor keys meet by hash, packed; an anchor whose 24 bytes occur in one document only is done.
2.  The other suffixes are range-partitioned by their 24 leading bytes with splitters from a sample.  A splitter is a pair
    (leading bytes, salt), so leading bytes that are more frequent than a bucket spread over several buckets.
3.  A bucket sorts its suffixes by multikey quicksort, 8 bytes a key, 50 bytes deep, and takes the longest common prefix
    (LCP) of neighbours; likewise for what lies to the left of the anchors.  Two strings with their anchor at distance d are
    equal exactly if no LCP between their suffixes is under 50 - d and no left LCP between them is under d.  So neighbours'
    LCPs number the classes of equal strings, and a string is covered if a smaller id has one of its class.
4.  Suffixes with a splitter's leading bytes may continue in a neighbouring bucket: each bucket keeps these aside and sends
    its distinct strings with their least ids; equal strings meet, and the least id over all buckets returns to each.
5.  Covered places return to their documents, which drop the covered bytes.

A batch that has an anchor in two documents answers these by itself and sends the key once; it sends the bytes around equal
zones once, so copies cost one entry per batch; copies of a row are sent once.  Classes are exact; the anchors in step 1 and
the strings in step 4 meet by 64-bit hashes.  At most ``SAMPLE_MOST`` sampled suffixes go to the driver and ``MOST_BUCKETS``
splitters to the tasks.  Above 1.5 TB of text a splitter's range is cut once more, by a hash of the 24 bytes (suffixes that share
them still meet; those at the edges meet in step 4 anyhow), so a bucket holds no more than below.

Defined cases: null text is empty; a text under 50 bytes keeps all; rows with one id never remove each
other's bytes; a null id is larger than any other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .common import ASK, PASS, U64, Answers, answer_rows, by_shard, copies, cut, drop, key_bits, pack, packed_rows, part_of, passed_on, row_key, runs, shard_count, stage, text_bytes, unpack, with_side

WINDOW, GRAM = 50, 24
REACH = WINDOW - GRAM  # how far an anchor may lie from its string's start
#: Sampled suffixes per bucket, in all, and buckets.
SAMPLE, SAMPLE_MOST, MOST_BUCKETS = 64, 1 << 19, 1 << 16
#: Text bytes hashed at a time, and suffixes compared at a time; both bound a task's memory.
BATCH, PIECE = 2 << 20, 1 << 14
NULL_ID = np.iinfo(np.int64).max


def zones(batch: tb.Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each zone its first string's place, number of strings, anchor place, anchor hash and document."""
    ok = tb.within(batch.offsets, WINDOW)
    if not len(ok):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, U64, np.int64))
    grams = tb.rolling(tb.byte_hashes(batch.data), GRAM)
    # the place in the low half: of equal hashes the first one counts, in every batch alike
    ranked = (grams & U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U64)
    least = tb.sliding_least(ranked, REACH + 1)[: len(ok)]
    turn = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (ok[1:] != ok[:-1])])
    count = np.diff(np.r_[turn, len(least)])
    good = ok[turn]
    start, count = turn[good], count[good]
    anchor = (least[start] & U64(0xFFFFFFFF)).astype(np.int64)
    return start, count, anchor, grams[anchor], np.searchsorted(batch.offsets, start, side="right") - 1


def leading(data: np.ndarray, at: np.ndarray, skip: int = 0) -> np.ndarray:
    """Eight bytes from each place as a big-endian number, so that numbers sort as the bytes do."""
    padded = np.concatenate([data, np.zeros(8 + skip, np.uint8)])
    return np.ndarray((len(data) + skip + 1,), ">u8", padded, strides=(1,))[at + skip].astype(U64)


def trailing(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes before each place, last one first, as a big-endian number; 0 before the data."""
    padded = np.concatenate([np.zeros(8, np.uint8), data])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))[np.maximum(at, 0)].astype(U64)


def heads(data: np.ndarray, at: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """The ``GRAM`` bytes from each place and its salt, as byte strings that compare in order."""
    return np.ascontiguousarray(np.stack([*(leading(data, at, k) for k in range(0, GRAM, 8)), salt], axis=1).astype(">u8")).view(f"S{GRAM + 8}").ravel()


def neighbour_lcp(keys: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Common bytes of each suffix in ``order`` with the one before it (0 for the first), as far as the keys reach."""
    out = np.zeros(len(order), np.int64)
    same = np.arange(1, len(order))
    for key in keys:
        ordered = key[order[same]] ^ key[order[same - 1]]
        out[same] += 8 - np.searchsorted(_BYTES, ordered, side="right")
        same = same[ordered == 0]
    return out


_BYTES = U64(1) << (np.arange(8, dtype=U64) * U64(8))


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """Order by the first key; runs of equal keys are sorted by the next one, and so on."""
    order = np.argsort(keys[0], kind="stable")
    group = np.cumsum(np.r_[False, keys[0][order][1:] != keys[0][order][:-1]]) if len(order) else order
    for key in keys[1:]:
        start, length = runs(group)
        open_ = np.flatnonzero(np.repeat(length > 1, length))
        if not len(open_):
            break
        own = order[open_]
        inner = np.lexsort((key[own], group[open_]))
        order[open_] = own[inner]
        split = np.r_[False, (group[1:] != group[:-1]) | (key[order][1:] != key[order][:-1])]
        group = np.cumsum(split)
    return order


def _ids(column: pa.Array) -> np.ndarray:
    return np.asarray(pa.compute.fill_null(column, NULL_ID))


def _shared(docs: DataFrame, n: int, bits: int) -> DataFrame:
    """Zones whose anchor bytes at least two rows have: row keys and first places, packed by partition."""
    low = U64(64 - bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tb.joined(batches, "text", BATCH):
            batch = tb.Batch.of(rows.column("text"))
            names = np.asarray(rows.column("key")).view(U64)
            start, _, _, key, doc = zones(batch)
            once = copies(names, 1)[doc]
            start, key, doc = start[once], tb.mix(key[once]) >> low, doc[once]
            order = np.argsort(key, kind="stable")
            key, doc, at = key[order], doc[order], (start - batch.offsets[doc])[order].astype(np.uint32)
            first, length = runs(key)
            several = doc[first] != doc[first + length - 1]  # documents rise within a key
            here = np.repeat(several, length)
            out = [(p, PASS + x) for p, x in answer_rows(names[doc[here]], n, at[here])]
            shared, key, doc, at = key[first[several]], key[~here], doc[~here], at[~here]
            told, asked = dict(cut(shared << low, n)), dict(cut(key << low, n))
            for shard in sorted(told.keys() | asked.keys()):
                own = asked.get(shard, slice(0, 0))
                used, local = np.unique(doc[own], return_inverse=True)
                out.append((shard, ASK + pack(key[own], local.astype(np.uint16 if len(used) < 65_536 else np.uint32), at[own], names[used], shared[told.get(shard, slice(0, 0))])))
            yield packed_rows(out)

    def meet(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        keys, names, places, task, shared = [], [], [], [], []
        ask, through = passed_on(payloads)
        if through:
            yield packed_rows([(int(part_of(unpack(p)[0][:1], n)[0]), p) for p in through])
        if not ask:
            return
        while ask:
            key, local, at, name, told = unpack(ask.pop())
            keys.append(key), names.append(name[local]), places.append(at), shared.append(told)
        key, name, place, told = np.concatenate(keys), np.concatenate(names), np.concatenate(places), np.unique(np.concatenate(shared))
        order = np.argsort(key, kind="stable")
        key, source = key[order], name[order]
        start, length = runs(key)
        if len(start):
            several = np.minimum.reduceat(source, start) != np.maximum.reduceat(source, start)
            if len(told):
                several |= told[np.minimum(np.searchsorted(told, key[start]), len(told) - 1)] == key[start]
            pick = order[np.repeat(several, length)]
            yield packed_rows(answer_rows(name[pick], n, place[pick]))

    sent = docs.select("key", "text").mapInArrow(send, "shard int, payload binary")
    return stage(by_shard(sent, n, meet, "shard int, payload binary"), "shared-anchors")


def splitters(docs: DataFrame, n: int, size: int) -> np.ndarray:
    """Bounds (leading bytes, salt) of n buckets, from suffixes of rows taken by hash."""
    wanted = min(n * SAMPLE, SAMPLE_MOST)
    rate = max(1, size * 7 // 100 // wanted)
    rows = max(1, rate // 32)  # of one row in so many, one suffix in 32

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tb.joined(batches, "text", BATCH):
            batch = tb.Batch.of(part.column("text"))
            names = np.asarray(part.column("key")).view(U64)
            _, _, anchor, _, doc = zones(batch)
            salt = _salt(names[doc], anchor - batch.offsets[doc])
            pick = salt % U64(max(1, rate // rows)) == 0
            yield pa.record_batch([pa.array(heads(batch.data, anchor[pick], tb.mix(salt[pick])).tolist(), pa.binary())], ["head"])

    sample = docs.filter(F.pmod(F.xxhash64("key", F.lit(5)), F.lit(rows)) == 0).select("key", "text").mapInArrow(task, "head binary")
    got = np.sort(np.array([bytes(r["head"]) for r in sample.toLocalIterator()], f"S{GRAM + 8}"))
    return got[np.arange(1, n) * len(got) // n] if len(got) else got


def _salt(names: np.ndarray, at: np.ndarray) -> np.ndarray:
    return tb.mix(names + at.astype(U64) * U64(0x9E3779B97F4A7C15))


def _suffixes(docs: DataFrame, shared: DataFrame, bounds: np.ndarray, n: int, cuts: int = 1) -> DataFrame:
    """Suffixes of shared anchors with the bytes their zones reach, packed by bucket; each splitter's range is ``cuts`` buckets.

    Kind 1 has those that start with a splitter's bytes, kind 0 the others.
    """
    edges = np.unique(bounds.astype(f"S{GRAM}"))

    def task(payloads: list[bytes], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Answers | None = None
        done: set[int] = set()  # rows of this partition whose copies need not be sent again
        for rows in tb.joined(batches, "text", BATCH):
            known = known or Answers(payloads, 1)
            new = [i for i, k in enumerate(rows.column("key").to_pylist()) if not (k in done or done.add(k))]
            rows = rows.take(pa.array(new, pa.int64())) if len(new) < rows.num_rows else rows
            batch = tb.Batch.of(rows.column("text"))
            names, ids = np.asarray(rows.column("key")).view(U64), _ids(rows.column("doc_id"))
            which, (place,) = known.of(names)
            wanted = np.sort(batch.offsets[which] + place.astype(np.int64))
            if not len(wanted):
                continue
            start, count, anchor, _, doc = zones(batch)
            pick = np.searchsorted(start, wanted)
            start, count, anchor, doc = start[pick], count[pick], anchor[pick], doc[pick]
            # equal zones go once, with all their places
            content = _zone_hashes(batch.data, start, count) + tb.mix((anchor - start).astype(U64))
            order = np.lexsort((ids[doc], content))
            s, length = runs(content[order])
            head = order[s]
            lead = heads(batch.data, anchor[head], tb.mix(_salt(names[doc[head]], anchor[head] - batch.offsets[doc[head]])))
            bucket = np.searchsorted(bounds, lead, side="right")
            edge = np.isin(lead.astype(f"S{GRAM}"), edges)
            if cuts > 1:
                a, b, c, salt = lead.view("<u8").reshape(-1, (GRAM + 8) // 8).T
                bucket = bucket * cuts + (tb.mix(np.where(edge, salt, a + tb.mix(b + tb.mix(c)))) % U64(cuts)).astype(np.int64)
            out = []
            target = bucket * 2 + edge
            by_bucket = np.lexsort((leading(batch.data, anchor[head]), target))
            for a, k in zip(*runs(target[by_bucket]), strict=True):
                own = by_bucket[a : a + k]
                h, sizes = head[own], count[head[own]] + WINDOW - 1
                take = np.repeat(start[h] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                refs = order[np.repeat(s[own] - (np.cumsum(length[own]) - length[own]), length[own]) + np.arange(int(length[own].sum()))]
                used, local = np.unique(doc[refs], return_inverse=True)
                out.append((int(edge[own[0]]), int(bucket[own[0]]), pack(batch.data[take], count[h].astype(np.uint8), (anchor[h] - start[h]).astype(np.uint8), length[own].astype(np.uint32), local.astype(np.uint16 if len(used) < 65_536 else np.uint32), (start[refs] - batch.offsets[doc[refs]]).astype(np.uint32), names[used], ids[used], level=5)))
            yield _kinds(out)

    return with_side(docs, shared, n, task, KINDS)


def _zone_hashes(data: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A hash of the bytes that each zone's strings cover."""
    return tb.word_hashes(data, start, start + count + WINDOW - 1)


class _Bucket:
    """The zones of a bucket, and the places (row, id, first byte) of each."""

    def __init__(self, payloads: list[bytes]):
        data, count, skip, copies, names, ids, places = [], [], [], [], [], [], []
        while payloads:
            d, c, k, length, local, at, name, own = unpack(payloads.pop())
            data.append(d), count.append(c.astype(np.int64)), skip.append(k.astype(np.int64)), copies.append(length.astype(np.int64))
            names.append(name[local]), ids.append(own[local]), places.append(at)
        self.data, self.count, self.skip, self.copies, self.names, self.ids, self.places = (np.concatenate(x) for x in (data, count, skip, copies, names, ids, places))
        sizes = self.count + WINDOW - 1
        self.start = np.cumsum(sizes) - sizes
        self.ref = np.cumsum(self.copies) - self.copies
        self.least = np.minimum.reduceat(self.ids, self.ref) if len(self.ref) else self.ids

    def sort(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the zones by what follows their anchors, LCP with the one before, and where the first 24 bytes change."""
        anchor = self.start + self.skip
        keys = [leading(self.data, anchor, k) for k in range(0, WINDOW, 8)]
        keys[-1] &= ~U64(0) << U64(8 * (-WINDOW % 8))
        order = multikey_order(keys)
        lcp = neighbour_lcp(keys, order)
        return order, lcp, np.flatnonzero(lcp < GRAM)[1:]

    def strings(self, zone: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, zone and number in the zone of each 50-byte string of neighbouring zones, given in order."""
        anchor, m = (self.start + self.skip)[zone], len(zone)
        keys = [trailing(self.data, anchor - k) for k in range(0, REACH, 8)]
        keys[-1] &= ~U64(0) << U64(8 * (-REACH % 8))
        left = multikey_order(keys)
        left_lcp = neighbour_lcp(keys, left)
        distance = np.arange(REACH + 1)[:, None]
        right_rank = np.cumsum(lcp[None, :] < WINDOW - distance, axis=1)
        left_rank = np.empty((REACH + 1, m), np.int64)
        left_rank[:, left] = np.cumsum(left_lcp[None, :] < distance, axis=1)
        n = self.count[zone]
        owner = np.repeat(np.arange(m), n)
        number = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        d = self.skip[zone][owner] - number
        return (d * (m + 1) + right_rank[d, owner]) * (m + 1) + left_rank[d, owner], zone[owner], number

    def hashes(self, owner: np.ndarray, number: np.ndarray) -> np.ndarray:
        """A hash of each string's bytes."""
        at = self.start[owner] + number
        return tb.word_hashes(self.data, at, at + WINDOW)

    def covered_places(self, owner: np.ndarray, number: np.ndarray, smaller: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (row key, byte) of strings of which ``smaller`` is the least id anywhere."""
        copies = self.copies[owner]
        ref = np.repeat(self.ref[owner] - (np.cumsum(copies) - copies), copies) + np.arange(int(copies.sum()))
        hit = np.repeat(smaller, copies) < self.ids[ref]
        ref = ref[hit]
        return self.names[ref], (self.places[ref] + np.repeat(number, copies)[hit]).astype(np.uint32)


KINDS = "kind int, shard int, payload binary"


def _by_bucket(df: DataFrame, n: int, fn) -> DataFrame:
    """``fn(bucket, payloads by kind)`` for each bucket."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[int, list[bytes]]] = {}
        for b in batches:
            for kind, s, p in zip(*(b.column(c).to_pylist() for c in ("kind", "shard", "payload")), strict=True):
                held.setdefault(s, {}).setdefault(kind, []).append(p)
        for bucket in sorted(held):
            yield from fn(bucket, held.pop(bucket))

    return df.repartitionById(n, F.col("shard")).mapInArrow(task, KINDS)


def _sort_buckets(suffixes: DataFrame, buckets: int, n: int) -> DataFrame:
    """Kind 0: covered places by partition; kind 1: strings at the edges by their hash; kind 2: the edges' suffixes by bucket."""

    def task(bucket: int, payloads: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        if 0 in payloads:
            own = _Bucket(payloads.pop(0))
            for zone, lcp in _pieces(own, PIECE):
                label, owner, number = own.strings(zone, lcp)
                order, start, length = _classes(label)
                smaller = np.empty(len(label), np.int64)
                smaller[order] = np.repeat(np.minimum.reduceat(own.least[owner[order]], start), length)
                names, at = own.covered_places(owner, number, smaller)
                yield _kinds([(0, p, x) for p, x in answer_rows(names, n, at)])
        if 1 in payloads:
            yield _kinds([(2, bucket, p) for p in payloads[1]])
            own = _Bucket(payloads.pop(1))
            for zone, lcp in _pieces(own, PIECE):
                label, owner, number = own.strings(zone, lcp)
                order, start, _ = _classes(label)
                least, one = np.minimum.reduceat(own.least[owner[order]], start), order[start]
                key = own.hashes(owner[one], number[one])
                order = np.argsort(key)
                yield _kinds([(1, s, pack(key[order[at]], least[order[at]], np.array([bucket], np.int64))) for s, at in cut(key[order], n)])

    return stage(_by_bucket(suffixes, buckets, task), "bucket-results")


def _classes(label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(label)
    return order, *runs(label[order])


def _pieces(own: _Bucket, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """About ``step`` sorted zones at a time, with their LCPs; pieces end where the 24 bytes change."""
    order, lcp, change = own.sort()
    ends = np.r_[change, len(order)]
    at = 0
    while at < len(order):
        stop = int(ends[min(np.searchsorted(ends, at + step), len(ends) - 1)])
        yield order[at:stop], np.r_[0, lcp[at + 1 : stop]]
        at = stop


def _kinds(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], ["kind", "shard", "payload"])


def _compare_across(results: DataFrame, buckets: int, n: int) -> DataFrame:
    """Covered places of the suffixes at the buckets' edges."""

    def meet(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = [unpack(p) for p in payloads]
        key, ids = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        source = np.repeat([int(p[2][0]) for p in parts], [len(p[0]) for p in parts])
        order, start, length = _classes(key)
        least = np.empty(len(key), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(ids[order], start), length)
        order = np.lexsort((key, source))
        yield packed_rows([(int(source[order[a]]), pack(key[order[a : a + k]], least[order[a : a + k]])) for a, k in zip(*runs(source[order]), strict=True)])

    def task(bucket: int, payloads: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        key, least = (np.concatenate(x) for x in zip(*map(unpack, payloads[0]), strict=True))
        order = np.argsort(key)
        key, least = key[order], least[order]
        own = _Bucket(payloads.pop(2))
        for a in range(0, len(own.count), PIECE):
            n_strings = own.count[a : a + PIECE]
            owner = np.repeat(np.arange(a, a + len(n_strings)), n_strings)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(n_strings) - n_strings, n_strings)
            smaller = least[np.searchsorted(key, own.hashes(owner, number))]
            names, at = own.covered_places(owner, number, smaller)
            yield _kinds([(0, p, x) for p, x in answer_rows(names, n, at)])

    answers = by_shard(results.filter("kind = 1").select("shard", "payload"), n, meet, "shard int, payload binary")
    both = results.filter("kind = 2").unionByName(answers.select(F.lit(0).alias("kind"), "shard", "payload"))
    return _by_bucket(both, buckets, task).select("shard", "payload")


def _remove(docs: DataFrame, covered: DataFrame, n: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def task(payloads: list[bytes], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Answers | None = None
        for rows in tb.joined(batches, "text", BATCH):
            known = known or Answers(payloads, 1)
            batch = tb.Batch.of(rows.column("text"))
            doc, (place,) = known.of(np.asarray(rows.column("key")).view(U64))
            size = len(batch.data)
            gone = tb.covered(batch.offsets[doc] + place.astype(np.int64), WINDOW, size)
            total = np.r_[0, np.cumsum(gone)]
            removed = total[batch.offsets[1:]] - total[batch.offsets[:-1]]
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = batch.offsets[:-1][(batch.offsets[:-1] < size)]
            begins[inner] = gone[inner]
            spans = np.r_[0, np.cumsum(begins)]
            spans = spans[batch.offsets[1:]] - spans[batch.offsets[:-1]]
            kept = [batch.data[a:b][~gone[a:b]].tobytes() if r else batch.text(i) for i, (a, b, r) in enumerate(zip(batch.offsets[:-1], batch.offsets[1:], removed, strict=True))]
            yield pa.record_batch([rows.column("doc_id"), pa.array(np.diff(batch.offsets)), pa.array(removed), pa.array(spans), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary())], schema=schema)

    return with_side(docs, covered, n, task, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of each document."""
    spark = docs.sparkSession
    size = text_bytes(docs)
    n = shard_count(spark, size)
    keyed = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    shared = _shared(keyed, n, key_bits(size))
    ranges = buckets or min(n, MOST_BUCKETS)
    bounds, cuts = splitters(keyed, ranges, size), 1 if buckets else -(-n // ranges)
    buckets = (len(bounds) + 1) * cuts
    results = _sort_buckets(_suffixes(keyed, shared, bounds, n, cuts), buckets, n)
    drop(shared)
    covered = results.filter("kind = 0").select("shard", "payload")
    return _remove(keyed, covered.unionByName(_compare_across(results, buckets, n)), n)


def op3_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
