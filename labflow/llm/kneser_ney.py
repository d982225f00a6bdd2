"""Quality classifier: perplexity under an interpolated modified Kneser-Ney bigram model of trusted text.

Words and bigrams are told apart by hashes of their content, whose bits grow with the input (45 at 1 GB of text, one more
each time it doubles), so the model grows with the trusted text.  All bigrams of the trusted documents are counted in shards; discounts come from the counts of counts, the lower order from
continuation counts, which word shards add up and answer to every bigram shard that holds the word.  The mass of unseen
words is spread over the counted distinct words and one more, or over ``VOCABULARY`` if they are fewer.  With g(v) the
weight left to the lower order after v, p1 the lower order and u that of an unseen word,

    log p(w | v) = log g(v) + log p1(w) + d(v, w),    d(v, w) = log p2(w | v) - log g(v) - log p1(w), 0 if vw is unseen.

So a document's score is log u for each word, and gains by key: log p1(w) - log u + log g(w) for each word, -log g(w) for
the last one, which is nobody's context, and d(v, w) for each bigram.  The gains of the most frequent keys are a table of
at most ``HOME`` slots that every task holds; for the others documents send their keys, packed with a row number, and the
shard that holds the gains returns one partial sum per document.  Gains travel with 16 bits of mantissa.  A filter of 2**28 bits with two bits a key, whatever the
input, keeps most unseen keys at home.

An eighth of the trusted documents, taken by hash, is not trained on.  From these come, for each language and each band
of lengths, a quantile of the perplexity; a document above its threshold is rejected.  A band with few held-out
documents takes the language's, a language with few the common threshold of that band, then of all.

Defined cases: null or wordless text has perplexity 1 and is kept; null ids and languages are scored like others; repeated
rows are scored each on their own; without trusted text every document is kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .common import PACKED, U64, by_shard, cut, drop, key_bits, pack, packed_rows, row_key, runs, shard_count, shard_of, small, stage, text_bytes, unpack

#: The mass of unseen words is spread over at least so many words.
VOCABULARY = 1 << 18
#: Bits of a slot of the table of frequent keys; bigram shards that one word shard serves.
HOME_BITS, WORD_SHARE = 21, 8
#: Text bytes taken at a time: what a Python worker keeps between tasks follows it.
BATCH = 2 << 20
MAP_BITS = 28
#: Quantile of held-out trusted perplexity, factor above it, held-out documents that a threshold needs, and the width of
#: the grid on which logarithms of perplexities are counted.
QUANTILE, SLACK, MIN_HELD, GRID = 0.98, 1.15, 60, 0.001
#: Documents are scored in so many parts, taken by hash, one after the other: what they send is on disk for one part at a time.
PARTS = 2
#: Documents numbered in a row whose sums meet in one part.
BLOCK_BITS = 10
#: Trusted ids up to this number are broadcast (8 bytes each); more are joined by shuffle.
BROADCAST_IDS = 2_000_000
_PAIR, _WORD, _END = U64(0xA24BAED4963EE407), U64(0x9FB21C651E98DF25), U64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class Keys:
    """Keys of words and bigrams: the top ``bits`` bits of a hash."""

    bits: int

    @property
    def rest(self) -> int:
        return 64 - self.bits

    def _cut(self, hashes: np.ndarray) -> np.ndarray:
        return hashes & (~U64(0) << U64(self.rest))

    def words(self, batch: tb.Batch) -> tuple[np.ndarray, np.ndarray]:
        """Key of every word (0 marks a text's start), and ``first``."""
        starts, ends, first = tb.words(batch)
        return np.maximum(self._cut(tb.word_hashes(batch.data, starts, ends)), U64(1) << U64(self.rest)), first

    def pair(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        return self._cut(tb.mix(tb.mix(v + _PAIR) + w))

    def word(self, w: np.ndarray) -> np.ndarray:
        return self._cut(tb.mix(w ^ _WORD))

    def end(self, w: np.ndarray) -> np.ndarray:
        return self._cut(tb.mix(w ^ _END))


def keys_for(size: int) -> Keys:
    """Keys for ``size`` bytes of text: a chance match is rarer than one in ten thousand at any size."""
    return Keys(min(64, key_bits(size) + 4))


def before(word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The word before each word, 0 at the start of a text."""
    out = np.r_[np.zeros(1, word.dtype), word[:-1]][: len(word)]
    out[first[:-1][np.diff(first) > 0]] = 0
    return out


def rounded(gain: np.ndarray) -> np.ndarray:
    """32-bit floats with 16 bits of mantissa."""
    return ((gain.astype(np.float32).view(np.uint32) + np.uint32(64)) & np.uint32(0xFFFFFF80)).view(np.float32)


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.xxhash64(doc_id, F.lit(29)), F.lit(8)) == 0


@dataclass
class Words:
    """The lower order: its staged counts by word, and the numbers that turn them into probabilities."""

    table: DataFrame
    d1: np.ndarray
    d2: np.ndarray
    entries: int
    unseen: float  # p1 of a word that was not counted
    log_g_start: float

    def numbers(self) -> tuple:
        return self.d1, self.d2, self.entries, self.unseen


def lower_order(numbers: tuple, follow: np.ndarray, total: np.ndarray, *by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log p1 and log g of words from their counts."""
    d1, d2, entries, unseen = numbers
    cut1 = np.choose(np.minimum(follow, 3), [0, *d1])
    p1 = np.maximum(follow - cut1, 0) / entries + unseen
    g = np.where(total > 0, sum(d * x for d, x in zip(d2, by, strict=True)) / np.maximum(total, 1), 1.0)
    return np.log(p1), np.log(np.clip(g, 1e-6, 1.0))


def _places(key: np.ndarray) -> list[np.ndarray]:
    """A key's two bits of the filter, both in one block of 512, so that a range of keys has a range of bits."""
    block = (key >> U64(73 - MAP_BITS)) << U64(9)
    return [(block | (key >> U64(shift) & U64(511))).astype(np.uint32) for shift in (0, 9)]


def maybe_seen(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    """False for keys that certainly have no gain."""
    a, b = ((bitmap[x >> np.uint32(3)] >> (np.uint8(7) - (x & np.uint32(7)).astype(np.uint8))) & np.uint8(1) for x in _places(key))
    return (a & b).astype(bool)


def _stretch(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and bytes of the filter that sorted keys set; a shard's keys are one range."""
    if not len(key):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    places = [x.astype(np.int64) for x in _places(key)]
    low, high = int(places[0][0] >> 9 << 6), int((places[0][-1] >> 9) + 1 << 6)
    bits = np.zeros((high - low) * 8, bool)
    for x in places:
        bits[x - low * 8] = True
    return np.array([low], np.int64), np.packbits(bits)


def _slot(key: np.ndarray, keys: Keys) -> np.ndarray:
    return (key >> U64(keys.rest) & U64((1 << HOME_BITS) - 1)).astype(np.int64)


def _tag(key: np.ndarray, keys: Keys) -> np.ndarray:
    """What tells keys of one slot apart; a key has no more bits than slot and tag but for inputs above 500 GB."""
    return (key >> U64(keys.rest + HOME_BITS)).astype(np.uint32) + np.uint32(1)


def at_home(gains: DataFrame, keys: Keys) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tags and gains by slot, the most frequent key of each slot, and the filter: tables of fixed size."""
    tags, values, best = np.zeros(1 << HOME_BITS, np.uint32), np.zeros(1 << HOME_BITS, np.float32), np.zeros(1 << HOME_BITS, np.uint32)
    seen = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    for r in gains.filter("shard < 0").coalesce(8).toLocalIterator():
        got = unpack(bytes(r["payload"]))
        if r["shard"] == -2:
            low, part = int(got[0][0]), got[1]
            seen[low : low + len(part)] |= part
            continue
        order = np.argsort(got[2], kind="stable")  # of one slot's keys the last one written stays
        key, gain, count = (x[order] for x in got)
        slot, count = _slot(key, keys), np.minimum(count.astype(U64) + U64(1), U64(0xFFFFFFFF)).astype(np.uint32)
        more = count > best[slot]
        slot = slot[more]
        tags[slot], values[slot], best[slot] = _tag(key[more], keys), gain[more], count[more]
    return tags, values, seen


def discounts(n: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ from the numbers of entries with count 1, 2, 3 and 4."""
    n = np.maximum(n.astype(float), 1e-9)
    y = n[0] / (n[0] + 2 * n[1])
    d = np.array([1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]])
    return np.clip(d, 0.1, np.array([0.95, 1.9, 2.85]))


def count_bigrams(docs: DataFrame, ids: DataFrame, n: int, keys: Keys) -> DataFrame:
    """shard, payload (first words, second words, counts): all bigrams of the trusted documents that are trained on.

    Rows with shard -2 hold the numbers of a shard's bigrams that occur 1, 2, 3 and 4 times.
    """
    trained = ids.filter(~held_out())
    own = F.broadcast(trained) if trained.count() <= BROADCAST_IDS else trained

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tb.joined(batches, "text", BATCH):
            word, first = keys.words(tb.Batch.of(rows.column("text")))
            order = np.argsort(word)
            start, _ = runs(word[order])
            names = np.r_[U64(0), word[order[start]]]
            number = np.empty(len(word), U64)
            number[order] = np.repeat(np.arange(1, len(names)), np.diff(np.r_[start, len(word)]))
            pair = np.sort(before(number, first) << U64(32) | number)
            start, count = runs(pair)
            v, w = names[(pair[start] >> U64(32)).astype(np.int64)], names[(pair[start] & U64(0xFFFFFFFF)).astype(np.int64)]
            shard = shard_of(keys.pair(v, w), n).astype(np.uint16 if n <= 65_536 else np.uint32)
            order = np.argsort(shard, kind="stable")  # in a shard the words still rise
            v, w, count = v[order], w[order], small(count[order])
            yield packed_rows([(int(shard[order[a]]), pack(v[a : a + k], w[a : a + k], count[a : a + k])) for a, k in zip(*runs(shard[order]), strict=True)])

    def add(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        v, w, count = (np.concatenate(x) for x in zip(*map(unpack, payloads), strict=True))
        payloads.clear()
        order = np.lexsort((w, v))
        v, w, count = v[order], w[order], count[order]
        start = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])])
        total = np.add.reduceat(count.astype(U64), start)
        of = np.array([(total == c).sum() for c in (1, 2, 3, 4)], np.int64)
        shard = int(shard_of(keys.pair(v[:1], w[:1]), n)[0])
        yield packed_rows([(shard, pack(v[start], w[start], small(total))), (-2, pack(of))])

    return stage(by_shard(docs.select("doc_id", "text").join(own, "doc_id", "left_semi").select("text").mapInArrow(send, PACKED), n, add, PACKED), "bigram-counts")


def word_tables(counts: DataFrame) -> tuple[Words, np.ndarray]:
    """The lower order, and the bigrams' discounts.

    A bigram shard sends each of its words once, in order.  The word's shard adds up and answers each sender in the same
    order (shard, payload with the sender's stretch first); a row with shard -1 holds its words once, a row with -2 its sums.
    """
    counted = counts.filter("shard >= 0")
    m = max(shard_count(counts.sparkSession, 0), (counted.agg(F.max("shard")).first()[0] or 0) // WORD_SHARE)
    of = sum((unpack(bytes(r["payload"]))[0] for r in counts.filter("shard = -2").coalesce(1).collect()), np.zeros(4, np.int64))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, raw in zip(b.column("shard").to_pylist(), b.column("payload").to_pylist(), strict=True):
                v, w, count = unpack(raw)
                names, v, w = named(v, w)
                k = len(names)
                sums = [np.bincount(w, minlength=k), np.bincount(v, count, k), *(np.bincount(v[x], minlength=k) for x in (count == 1, count == 2, count >= 3))]
                sums = [small(x) for x in sums]
                yield packed_rows([(t, pack(np.array([s], np.int64), names[own], *[x[own] for x in sums])) for t, own in cut(names, m)])

    def add(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = [unpack(p) for p in payloads]
        payloads.clear()
        names, back = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
        sums = [small(np.bincount(back, np.concatenate([p[i] for p in parts]), len(names))) for i in range(2, 7)]
        follow, start = sums[0], np.flatnonzero(names == 0)
        n1 = np.array([*((follow == c).sum() for c in (1, 2, 3, 4)), (follow >= 3).sum(), (follow > 0).sum(), follow.sum()], np.int64)
        own = np.flatnonzero(names)
        yield packed_rows([(-2, pack(n1, np.array([x[start].sum() for x in sums[1:]], np.int64))), (-1, pack(names[own], *[x[own] for x in sums]))])
        stretch, at = shard_of(names[:1], m).astype(np.int64), 0
        for p in parts:
            mine = back[at : at + len(p[1])]
            at += len(p[1])
            yield packed_rows([(int(p[0][0]), pack(stretch, *[x[mine] for x in sums]))])

    table = stage(by_shard(counted.mapInArrow(send, PACKED), m, add, PACKED), "word-counts")
    n1, start = np.zeros(7, np.int64), np.zeros(4, np.int64)
    for r in table.filter("shard = -2").coalesce(1).collect():
        b, c = unpack(bytes(r["payload"]))
        n1, start = n1 + b, start + c
    d1, d2, entries = discounts(n1[:4]), discounts(of), max(int(n1[6]), 1)
    spare = float(d1 @ n1[[0, 1, 4]]) / entries if n1[6] else 1.0
    words = Words(table, d1, d2, entries, max(spare, 1e-6) / max(VOCABULARY, int(n1[5]) + 1), 0.0)
    words.log_g_start = float(lower_order(words.numbers(), np.zeros(1, np.int64), *start.reshape(4, 1))[1][0])
    return words, d2


def named(v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words in order, and the number of each first and second word among them."""
    names, back = np.unique(np.r_[v, w], return_inverse=True)
    return names, back[: len(v)], back[len(v) :]


def bigram_gains(counts: DataFrame, words: Words, d: np.ndarray, n: int, keys: Keys) -> DataFrame:
    """shard, payload (keys, gains): the model's side.  Rows -1 hold a shard's most frequent keys, rows -2 its part of the filter."""
    numbers = words.numbers()
    tops = max((1 << HOME_BITS - 1) // n, 1)

    def own_gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column("payload").to_pylist():
                names, *sums = unpack(raw)
                log_p1, log_g = lower_order(numbers, *[x.astype(np.int64) for x in sums])
                key = np.r_[keys.word(names), keys.end(names)]
                gain = rounded(np.r_[log_p1 - np.log(numbers[3]) + log_g, -log_g])
                often = np.r_[sums[1], np.zeros(len(names), sums[1].dtype)]
                order = np.argsort(key)
                yield packed_rows([(s, pack(key[order[at]], gain[order[at]], often[order[at]], np.zeros(0))) for s, at in cut(key[order], n)])

    def join(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = [unpack(p) for p in payloads]  # 3 arrays: bigrams; 4: gains of words; 6: answers of word shards
        payloads.clear()
        key, gain, often = ([p[i] for p in parts if len(p) == 4] for i in range(3))
        answers, pairs = sorted((p for p in parts if len(p) == 6), key=lambda p: int(p[0][0])), [p for p in parts if len(p) == 3]
        del parts
        for v, w, count in pairs:  # one row
            _, a, b = named(v, w)
            sums = [np.concatenate(x).astype(np.int64) for x in list(zip(*answers, strict=True))[1:]]
            log_p1, log_g = lower_order(numbers, *sums)
            left = np.maximum(count - d[np.minimum(count, 3).astype(np.int64) - 1], 0) / np.maximum(sums[1][a], 1)
            low = log_g[a] + log_p1[b]
            key.append(keys.pair(v, w)), gain.append(rounded(np.log(left + np.exp(low)) - low)), often.append(count)
        key, gain, often = np.concatenate(key), np.concatenate(gain), np.concatenate(often)
        order = np.argsort(key)
        key, gain, often = key[order], gain[order], often[order]
        top = np.argpartition(often, -tops)[-tops:] if len(often) > tops else np.arange(len(often))
        for s, at in cut(key, n):
            yield packed_rows([(s, b"M" + pack(key[at], gain[at]))])
        top = np.sort(top)
        yield packed_rows([(-1, pack(key[top], gain[top], small(often[top]))), (-2, pack(*_stretch(key)))])

    own = words.table.filter("shard = -1").mapInArrow(own_gains, PACKED)
    return stage(by_shard(counts.filter("shard >= 0").unionByName(words.table.filter("shard >= 0")).unionByName(own), n, join, PACKED), "gains")


def _part(row: np.ndarray, n: int) -> np.ndarray:
    """Part that sums up a row's answers: blocks of rows are dealt by hash, so a batch goes to a part or two."""
    return shard_of(tb.mix((row >> BLOCK_BITS).astype(U64)), n).astype(np.int64)


def _by_key(key: np.ndarray, doc: np.ndarray, keys: Keys, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, document) in order of keys, and how often each occurs."""
    if n_docs < 1 << keys.rest:  # the document fits below the key: one plain sort
        both = np.sort(key | doc.astype(U64))
        start, times = runs(both)
        low = U64((1 << keys.rest) - 1)
        return both[start] & ~low, both[start] & low, times
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])][: len(key)])
    return key[start], doc[start], np.diff(np.r_[start, len(key)])


def home_tables(words: Words, gains: DataFrame, keys: Keys) -> Broadcast:
    """What every task holds, of fixed size."""
    return gains.sparkSession.sparkContext.broadcast((*at_home(gains, keys), float(np.log(words.unseen)), words.log_g_start))


def score(docs: DataFrame, shared: Broadcast, gains: DataFrame, n: int, keys: Keys) -> DataFrame:
    """key (of the row), doc_id, lang, n_words, log_prob of every document."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home_tag, home_gain, seen, log_unseen, log_g_start = shared.value
        at = TaskContext.get().partitionId() << 36
        for rows in tb.joined(batches, "text", BATCH):
            word, first = keys.words(tb.Batch.of(rows.column("text")))
            n_words = np.diff(first)
            some = np.flatnonzero(n_words)
            base = n_words * log_unseen + (n_words > 0) * log_g_start
            ask, ask_doc = [], []
            each = np.repeat(np.arange(rows.num_rows, dtype=np.uint32), n_words)
            for key, doc in ((keys.word(word), each), (keys.pair(before(word, first), word), each), (keys.end(word[first[1:][some] - 1]), some.astype(np.uint32))):
                slot = _slot(key, keys)
                known = home_tag[slot] == _tag(key, keys)
                base = base + np.bincount(doc[known], home_gain[slot[known]], rows.num_rows)
                key, doc = key[~known], doc[~known]
                maybe = maybe_seen(seen, key)
                ask.append(key[maybe]), ask_doc.append(doc[maybe])
            row = np.arange(at, at + rows.num_rows)
            at += rows.num_rows
            key, doc, times = _by_key(np.concatenate(ask), np.concatenate(ask_doc), keys, rows.num_rows)
            doc = doc.astype(np.uint16 if rows.num_rows <= 65_536 else np.uint32)
            out = [(s, b"R" + pack(key[own], doc[own], small(times[own]), row[:1].astype(U64))) for s, own in cut(key, n)]
            # the documents themselves travel to the part that sums their answers
            part = _part(row, n)
            out += [(int(part[a]), b"D" + _documents(rows.slice(a, k), row[a : a + k], base[a : a + k], n_words[a : a + k])) for a, k in zip(*runs(part), strict=True)]
            yield packed_rows(out)
            del word, first, key, each, slot, known, base, maybe, doc, times, out, ask, ask_doc
            pa.default_memory_pool().release_unused()

    def join(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        model_key, model_gain = [np.zeros(0, U64)], [np.zeros(0, np.float32)]
        asked = []
        while payloads:
            p = payloads.pop()
            if p[:1] == b"M":
                k, g = unpack(p[1:])
                model_key.append(k), model_gain.append(g)
            elif p[:1] == b"R":
                asked.append(p)
            else:
                yield packed_rows([(-1 - int(_part(unpack(p[1:])[0][:1], n)[0]), p)])
        key, gain = np.concatenate(model_key), np.concatenate(model_gain)
        if not len(key):
            return
        rows, sums = [], []
        while asked:
            k, doc, times, base = unpack(asked.pop()[1:])
            at = np.minimum(np.searchsorted(key, k), len(key) - 1)
            value = np.where(key[at] == k, gain[at], 0.0) * times
            total = np.bincount(doc, weights=value)
            hit = np.flatnonzero(total)
            rows.append(hit.astype(U64) + base[0]), sums.append(total[hit])
        if rows:
            row, total = np.concatenate(rows), np.concatenate(sums)
            part = _part(row, n)
            order = np.lexsort((row, part))
            row, total, part = row[order], total[order], part[order]
            for a, k in zip(*runs(part), strict=True):
                yield packed_rows([(-1 - int(part[a]), b"S" + pack(row[a : a + k], rounded(total[a : a + k])))])

    def total(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        docs_, rows, sums = [], [np.zeros(0, U64)], [np.zeros(0, np.float32)]
        while payloads:
            p = payloads.pop()
            if p[:1] == b"D":
                docs_.append(_unpack_documents(p[1:]))
            else:
                r, s = unpack(p[1:])
                rows.append(r), sums.append(s)
        row, s = np.concatenate(rows), np.concatenate(sums).astype(float)
        order = np.argsort(row, kind="stable")
        row, s = row[order], np.r_[0, np.cumsum(s[order])]
        for own, names, n_words, base in docs_:
            a, b = np.searchsorted(row, own), np.searchsorted(row, own, side="right")
            yield pa.record_batch([*names, pa.array(n_words), pa.array(base + s[b] - s[a])], ["key", "doc_id", "lang", "n_words", "log_prob"])

    sent = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "lang", "text").mapInArrow(send, "shard int, payload binary").unionByName(gains.filter("shard >= 0"))
    joined = by_shard(sent, n, join, "shard int, payload binary").select((-1 - F.col("shard")).alias("shard"), "payload")
    return by_shard(joined, n, total, "key long, doc_id long, lang string, n_words long, log_prob double")


def _documents(rows: pa.RecordBatch, row: np.ndarray, base: np.ndarray, n_words: np.ndarray) -> bytes:
    batch = rows.select(["key", "doc_id", "lang"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return pack(row.astype(U64), base, n_words.astype(np.int64), np.frombuffer(sink.getvalue(), np.uint8))


def _unpack_documents(raw: bytes):
    row, base, n_words, ipc = unpack(raw)
    batch = pa.ipc.open_stream(pa.py_buffer(ipc.tobytes())).read_next_batch()
    return row, batch.columns, n_words, base


def levels(held: DataFrame) -> DataFrame:
    """level, lang, band, held, q: the quantile of each language and band, each language, each band, and all.

    Perplexities are counted by grid cell first, so a group of any size costs its cells.
    """
    cells = held.groupBy("lang", "band", F.round(F.col("log_ppl") / GRID).cast("int").alias("cell")).agg(F.count("*").alias("k"))
    return cells.cube("lang", "band").agg(F.grouping_id().alias("level"), F.sum("k").alias("held"), (F.percentile("cell", QUANTILE, F.col("k")) * GRID).alias("q"))


def thresholds(scored: DataFrame, ids: DataFrame) -> DataFrame:
    """lang, band, threshold: a quantile of the held-out trusted documents' perplexity with its fallbacks."""
    own = ids.filter(held_out())
    size = own.count()
    held = scored.filter("n_words > 0").join(F.broadcast(own) if size <= BROADCAST_IDS else own, "doc_id", "left_semi")
    found = stage(levels(held), "perplexity-levels")
    groups = scored.select("lang", "band").distinct()
    for level, on in ((0, ("lang", "band")), (1, ("lang",)), (2, ("band",)), (3, ())):
        part = found.filter((F.col("level") == level) & (F.col("held") >= (MIN_HELD if level < 3 else 1))).select(*[F.col(c).alias(f"{c}_{level}") for c in on], F.col("q").alias(f"q{level}"))
        match = F.lit(True)
        for c in on:
            match = match & F.col(c).eqNullSafe(F.col(f"{c}_{level}"))
        groups = groups.join(F.broadcast(part), match, "left")  # languages x bands
    # a band's own quantile, or the language's widened by how much more the band varies than all bands do
    band = F.coalesce("q0", F.greatest("q1", F.col("q1") + F.col("q2") - F.col("q3")), "q1", "q2", "q3")
    return groups.select(F.col("lang").alias("t_lang"), F.col("band").alias("t_band"), (band + float(np.log(SLACK))).alias("limit"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """key (of the row), doc_id, lang, n_words, perplexity, threshold and kept, one row per document."""
    size = text_bytes(docs)
    n, keys = shard_count(docs.sparkSession, size), keys_for(size)
    ids = stage(trusted_ids(labels), "trusted")
    counts = count_bigrams(docs, ids, n, keys)
    words, d = word_tables(counts)
    gains = bigram_gains(counts, words, d, n, keys)
    drop(counts, words.table)
    tables = home_tables(words, gains, keys)
    parts = []
    for part in range(PARTS):
        scored = score(docs.filter(F.pmod(F.xxhash64("text", F.lit(31)), F.lit(PARTS)) == part), tables, gains, n, keys)
        scored = scored.withColumn("log_ppl", F.when(F.col("n_words") > 0, -F.col("log_prob") / F.col("n_words")).otherwise(0.0))
        parts.append(stage(scored.withColumn("band", F.least(F.floor(F.log(F.greatest("n_words", F.lit(1))) / float(np.log(3))), F.lit(7)).cast("int")), "perplexities"))
    tables.destroy()
    scored = reduce(DataFrame.unionByName, parts)
    drop(gains)
    limits = thresholds(scored, ids)
    on = F.col("lang").eqNullSafe(F.col("t_lang")) & (F.col("band") == F.col("t_band"))
    kept = F.col("limit").isNull() | (F.col("n_words") == 0) | (F.col("log_ppl") <= F.col("limit"))
    limits = stage(limits, "perplexity-limits")
    many = limits.count() > 100_000
    out = scored.join(limits if many else F.broadcast(limits), on, "left")
    return out.select("key", "doc_id", "lang", "n_words", F.exp("log_ppl").alias("perplexity"), F.exp("limit").alias("threshold"), kept.alias("kept"))


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("key")
