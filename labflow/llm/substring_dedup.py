"""Substring deduplication with fixed-block anchors.

A repeated window of 35 words holds, in each text, exactly one whole block of that text's grid of non-overlapping 18-word
blocks.  So blocks are the index and every rolling 18-word window of every text is a probe:

1.  Probes and blocks meet by hash, packed; a block that some other place also has is an anchor.
2.  Anchors return to their texts and are extended one word at a time: each 35-word window around an anchor is hashed
    and counted with all others like it.  A run of windows that occur elsewhere is a maximal exact repeat.  Counting
    windows instead of comparing anchors in pairs keeps a passage with n copies at n entries.
3.  Texts with repeats get their runs back and drop the covered words; texts without anchors were done in step 2.

A batch that has a block or window at two places answers its own texts and sends the key once or twice, so a passage that a
third of all texts share costs an entry or two per batch in its shard.  Copies of a row beyond the second add nothing.

Windows are told apart by 64-bit hashes; the probe keys are cut to as many bits as the input's size asks for, since a
chance anchor costs only a few counted windows.  Places are known by the row's content, so repeated rows count as
separate places and get the same answer.

Defined cases: null text has no words; a text of fewer than 35 words keeps all; repeated rows remove each other's words;
an empty table gives an empty result.
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

WINDOW = 35
BLOCK = (WINDOW + 1) // 2
DONE = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("payload", pa.binary()), ("key", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("sha", pa.string())])


def _probes(docs: DataFrame, n: int, bits: int) -> DataFrame:
    """Anchors of every text, packed by its partition: row keys and block numbers."""
    low = U64(64 - bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tb.joined(batches, "text", tb.BATCH_BYTES):
            batch = tb.Batch.of(rows.column("text"))
            names = np.asarray(rows.column("key")).view(U64)
            starts, ends, first = tb.words(batch)
            keys = tb.rolling(tb.word_hashes(batch.data, starts, ends), BLOCK)
            place = np.flatnonzero(tb.within(first, BLOCK))
            keys = keys[place] >> low
            doc = np.searchsorted(first, place, side="right") - 1
            once = copies(names, 2)[doc]
            keys, place, doc = keys[once], place[once], doc[once]
            number, off = np.divmod(place - first[doc], BLOCK)
            grid = np.flatnonzero(off == 0)
            grid = grid[np.argsort(keys[grid])]
            held, held_doc, held_no = keys[grid], doc[grid], number[grid].astype(np.uint32)
            probes = np.sort(keys)
            start, length = runs(probes)
            here = length[np.searchsorted(probes[start], held)] > 1
            out = [(p, PASS + x) for p, x in answer_rows(names[held_doc[here]], n, held_no[here])]
            held, held_doc, held_no = held[~here], held_doc[~here], held_no[~here]
            probes = np.repeat(probes[start], np.minimum(length, 2))
            edges = {s: own for s, own in cut(held << low, n)}
            for shard, own in cut(probes << low, n):
                at = edges.get(shard, slice(0, 0))
                used, local = np.unique(held_doc[at], return_inverse=True)
                out.append((shard, ASK + pack(probes[own], held[at], local.astype(np.uint32), held_no[at], names[used])))
            yield packed_rows(out)

    def meet(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        probes, blocks, names, numbers = [], [], [], []
        ask, through = passed_on(payloads)
        while ask:
            p, held, local, number, name = unpack(ask.pop())
            probes.append(p), blocks.append(held), names.append(name[local]), numbers.append(number)
        out = []
        if probes:
            probe = np.sort(np.concatenate(probes))
            block, name, number = np.concatenate(blocks), np.concatenate(names), np.concatenate(numbers)
            del probes, blocks, names, numbers
            again = probe[1:][probe[1:] == probe[:-1]]
            at = np.minimum(np.searchsorted(again, block), max(len(again) - 1, 0))
            hit = again[at] == block if len(again) else np.zeros(len(block), bool)
            out = answer_rows(name[hit], n, number[hit])
        yield packed_rows(out)
        if through:
            yield packed_rows([(int(part_of(unpack(p)[0][:1], n)[0]), p) for p in through])

    sent = docs.select("key", "text").mapInArrow(send, "shard int, payload binary")
    return stage(by_shard(sent, n, meet, "shard int, payload binary"), "anchors")


def _extend(docs: DataFrame, anchors: DataFrame, n: int) -> DataFrame:
    """Kind 0: finished texts; kind 1: hashes of the windows around anchors, packed by shard; kind 2: texts that wait."""

    def task(payloads: list[bytes], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Answers | None = None
        for rows in tb.joined(batches, "text", tb.BATCH_BYTES):
            known = known or Answers(payloads, 1)
            names = np.asarray(rows.column("key")).view(U64)
            batch = tb.Batch.of(rows.column("text"))
            starts, ends, first = tb.words(batch)
            doc, (number,) = known.of(names)
            low = first[doc] + number.astype(np.int64) * BLOCK
            near = (low[:, None] - np.arange(WINDOW - BLOCK, -1, -1)).ravel()
            owner = np.repeat(doc, WINDOW - BLOCK + 1)
            ok = (near >= first[owner]) & (near + WINDOW <= first[owner + 1])
            place = np.unique(near[ok])  # blocks of one text are apart by more than the windows around them reach
            waits = np.zeros(len(batch), bool)
            if len(place):
                own = np.searchsorted(first, place, side="right") - 1
                waits[own] = True
                keys = tb.rolling(tb.word_hashes(batch.data, starts, ends), WINDOW)[place]
                order = np.argsort(keys)
                keys, own, at = keys[order], own[order], (place - first[own])[order].astype(np.uint32)
                start, length = runs(keys)
                several = np.repeat(length > 1, length)
                here = np.flatnonzero(several)
                packed = [(p, PASS + x) for p, x in answer_rows(names[own[here]], n, at[here])]
                told = dict(cut(keys[start[length > 1]], n))
                shared, keys, own, at = keys[start[length > 1]], keys[~several], own[~several], at[~several]
                asked = dict(cut(keys, n))
                for shard in sorted(told.keys() | asked.keys()):
                    part = asked.get(shard, slice(0, 0))
                    used, local = np.unique(own[part], return_inverse=True)
                    packed.append((shard, ASK + pack(keys[part], local.astype(np.uint16 if len(used) < 65_536 else np.uint32), at[part], names[used], shared[told.get(shard, slice(0, 0))])))
                yield _batch(kind=[1] * len(packed), shard=[p[0] for p in packed], payload=[p[1] for p in packed])
            later, now = np.flatnonzero(waits), np.flatnonzero(~waits)
            if len(later):
                part = rows.take(pa.array(later))
                yield _batch(kind=[2] * len(later), key=part.column("key"), doc_id=part.column("doc_id"), text=part.column("text"))
            if len(now):
                sha = [hashlib.sha256(b" ".join(batch.text(i).split())).hexdigest() for i in now]
                yield _batch(kind=[0] * len(now), doc_id=rows.column("doc_id").take(pa.array(now)), n_words=np.diff(first)[now], sha=sha)

    return stage(with_side(docs, anchors, n, task, "kind int, shard int, payload binary, key long, doc_id long, text string, n_words long, sha string"), "extended")


def _batch(**columns) -> pa.RecordBatch:
    rows = len(columns["kind"])
    return pa.record_batch([columns[f.name] if isinstance(columns.get(f.name), pa.Array) else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in DONE], schema=DONE)


def _count(windows: DataFrame, n: int) -> DataFrame:
    """Windows that occur at two places or more, back to their texts: row keys and start words."""

    def task(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        keys, names, places, shared = [], [], [], []
        ask, through = passed_on(payloads)
        if through:
            yield packed_rows([(int(part_of(unpack(p)[0][:1], n)[0]), p) for p in through])
        if not ask:
            return
        while ask:
            key, local, at, name, told = unpack(ask.pop())
            keys.append(key), names.append(name[local]), places.append(at), shared.append(told)
        key, name, place, told = np.concatenate(keys), np.concatenate(names), np.concatenate(places), np.unique(np.concatenate(shared))
        order = np.argsort(key)
        key = key[order]
        same = key[1:] == key[:-1]
        again = np.r_[False, same] | np.r_[same, False] if len(key) else np.zeros(0, bool)
        if len(told):
            again |= told[np.minimum(np.searchsorted(told, key), len(told) - 1)] == key
        pick = order[again]
        yield packed_rows(answer_rows(name[pick], n, place[pick]))

    return stage(by_shard(windows, n, task, "shard int, payload binary"), "repeats")


def _remove(waiting: DataFrame, repeats: DataFrame, n: int, width: int) -> DataFrame:
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])

    def task(payloads: list[bytes], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Answers | None = None
        for rows in tb.joined(batches, "text", tb.BATCH_BYTES):
            known = known or Answers(payloads, 1)
            texts = rows.column("text").to_pylist()
            doc, (place,) = known.of(np.asarray(rows.column("key")).view(U64))
            edge = np.searchsorted(doc, np.arange(len(texts) + 1))
            sizes, removed, shas, kept_texts = [], [], [], []
            for i, text in enumerate(texts):
                words = (text or "").encode().split()
                gone = tb.covered(place[edge[i] : edge[i + 1]].astype(np.int64), width, len(words))
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words)
                sizes.append(len(words)), removed.append(int(gone.sum())), shas.append(hashlib.sha256(kept).hexdigest()), kept_texts.append(kept.decode())
            yield pa.record_batch([rows.column("key"), rows.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas), pa.array(kept_texts, pa.string())], schema=schema)

    return with_side(waiting, repeats, n, task, "key long, doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def remove_repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``done``: doc_id, n_words, kept_sha256 of texts without repeats; ``cleaned``: the same, the row's key, n_removed and kept_text of the others."""
    spark = docs.sparkSession
    size = text_bytes(docs)
    n = shard_count(spark, size)
    keyed = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    anchors = _probes(keyed, n, key_bits(size))
    parts = _extend(keyed, anchors, n)
    drop(anchors)
    repeats = _count(parts.filter("kind = 1").select("shard", "payload"), n)
    done = parts.filter("kind = 0").select("doc_id", "n_words", F.col("sha").alias("kept_sha256"))
    return done, _remove(parts.filter("kind = 2").select("key", "doc_id", "text"), repeats, n, WINDOW)


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table

    done, cleaned = remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", "kept_sha256").unionByName(done.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256"))
