"""Benchmark decontamination by one Aho-Corasick automaton.

Items are normalised to lower-case words.  A window is ten consecutive item words; every window holds one whole block of the
item's grid of five words.  The automaton's patterns are these blocks, and the items of fewer than ten words as a whole, each with a
space on either side: about one node for each byte of the items, where the windows themselves would take sixty for each word.
A batch of documents is normalised the same way into one string, with a separator that no pattern holds between documents,
and scanned once.  Around each block found, the windows that hold it are looked up in the sorted hashes of all item windows.
An end position maps back through the word number to the place in the original text.

The automaton is built on each Python worker from the normalised items (about 60 MB for 1 MB of them), whose size is checked
against ``MAX_BENCHMARK_BYTES`` with an error beyond it; a test set is a fixed collection and does not grow with the corpus.

Defined cases: null texts and items have no words; items without words have no pattern; repeated documents are
judged each on their own; equal item texts are all reported; a null item id is reported as empty text; empty tables give empty or clean results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb

WINDOW, BLOCK = 10, 5
MAX_BENCHMARK_BYTES = 8 << 20
#: Bytes that end a word once A-Z are lower-cased: everything in ASCII but digits and letters.
BREAKS = np.ones(256, bool)
BREAKS[0x30:0x3A] = BREAKS[0x61:0x7B] = BREAKS[0x80:] = False


def normalise(batch: tb.Batch) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The batch as one line of words, and words' starts and ends in the original, ``first``, and word ends in the line.

    Words are joined by one space; each document has a space at either end and a line feed after it.
    """
    data = tb.lower_ascii(batch.data)
    starts, ends, first = tb.words(tb.Batch(data, batch.offsets), BREAKS)
    sizes = ends - starts
    doc = np.repeat(np.arange(len(batch)), np.diff(first))
    at = np.cumsum(sizes + 1) - sizes + 2 * doc  # where each word goes
    total = (int(at[-1] + sizes[-1]) if len(at) else 0) + 2 * len(batch) + 2
    line = np.full(total, 0x20, np.uint8)
    take = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    put = np.repeat(at - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    line[put] = data[take]
    if len(at):
        new = np.flatnonzero(doc[1:] != doc[:-1]) + 1
        line[at[new] - 2] = 0x0A
    return line.tobytes(), starts, ends, first, at + sizes


@dataclass
class Machine:
    """The automaton, whose values are (words, items of fewer than ten words, whether it is a block), and the windows by hash."""

    automaton: object
    windows: np.ndarray  # sorted hashes
    items: np.ndarray  # the item of each, by number
    names: list


@lru_cache(maxsize=1)
def automaton(items: tuple[tuple[object, str], ...]) -> Machine | None:
    """None if no item has words."""
    import ahocorasick

    found: dict[str, tuple[int, list, bool]] = {}
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
    for number, (item, line) in enumerate(items):
        # bytes stand as latin-1 characters: only the joining space parts words, not U+0085 or U+00A0
        words = line.split(" ") if line else []
        if len(words) < WINDOW:
            if words:
                held = found.setdefault(f" {line} ", (len(words), [], False))
                if item not in held[1]:
                    held[1].append(item)
            continue
        for at in range(0, len(words) - BLOCK + 1, BLOCK):
            p = " " + " ".join(words[at : at + BLOCK]) + " "
            found[p] = (BLOCK, found[p][1] if p in found else [], True)
        raw = np.frombuffer(line.encode("latin-1"), np.uint8)
        starts, ends, _ = tb.words(tb.Batch(raw, np.array([0, len(raw)])), BREAKS)
        key = np.unique(tb.rolling(tb.word_hashes(raw, starts, ends), WINDOW))
        keys.append(key), owners.append(np.full(len(key), number, np.int32))
    if not found:
        return None
    machine = ahocorasick.Automaton()
    for p, value in found.items():
        machine.add_word(p, value)
    machine.make_automaton()
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(key, kind="stable")
    return Machine(machine, key[order], owner[order], [i for i, _ in items])


@dataclass
class Matches:
    """What a batch holds: word places and numbers of words of all occurrences, the items of each, and the batch's words."""

    place: list[int]
    words: list[int]
    items: list[list]
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def search(machine: Machine | None, batch: tb.Batch) -> Matches:
    line, starts, ends, first, line_ends = normalise(batch)
    out = Matches([], [], [], starts, ends, first)
    found = [(end, v) for end, v in machine.automaton.iter(line.decode("latin-1"))] if machine and len(starts) else []
    if not found:
        return out
    last = np.searchsorted(line_ends, [e for e, _ in found])
    for w, (_, (n, short, _)) in zip(last.tolist(), found, strict=True):
        if short:
            out.place.append(w - n + 1), out.words.append(n), out.items.append(short)
    begin = last[[block for _, (_, _, block) in found]] - BLOCK + 1
    place = np.unique((begin[:, None] - np.arange(WINDOW - BLOCK + 1)).ravel())
    place = place[place >= 0]
    doc = np.searchsorted(first, place, side="right") - 1
    place = place[place + WINDOW <= first[doc + 1]]
    if len(place):
        key = tb.rolling(tb.word_hashes(tb.lower_ascii(batch.data), starts, ends), WINDOW)[place]
        a, b = np.searchsorted(machine.windows, key), np.searchsorted(machine.windows, key, side="right")
        for i in np.flatnonzero(b > a):
            out.place.append(int(place[i])), out.words.append(WINDOW), out.items.append([machine.names[k] for k in machine.items[a[i] : b[i]]])
    return out


def load_items(benchmark: DataFrame, key: str = "item_id") -> tuple[tuple[object, str], ...]:
    """The items' normalised words, after a check of their total size."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"the benchmark holds {size} bytes; one automaton takes {MAX_BENCHMARK_BYTES}: split it and join the results")
    rows = benchmark.select(key, "text").filter(F.col("text").isNotNull()).collect()
    out = []
    for item, text in rows:
        line = normalise(tb.Batch.of(pa.array([text])))[0]
        out.append((item, line.decode("latin-1").strip(" \n")))
    return tuple(sorted(out, key=lambda x: (str(x[0]), x[1])))


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted as strings) and spans (character ranges of hit words) per document."""
    items = docs.sparkSession.sparkContext.broadcast(load_items(benchmark))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(items.value)
        for rows in tb.joined(batches, "text", tb.BATCH_BYTES):
            batch = tb.Batch.of(rows.column("text"))
            m = search(machine, batch)
            starts, ends, first = m.starts, m.ends, m.first
            hit = np.zeros(len(starts) + 1, np.int32)
            names: list[set] = [set() for _ in range(len(batch))]
            for w, n, d, which in zip(m.place, m.words, (np.searchsorted(first, m.place, side="right") - 1).tolist(), m.items, strict=True):
                hit[w] += 1
                hit[w + n] -= 1
                names[d].update(which)
            covered = np.cumsum(hit[:-1]) > 0
            total = np.r_[0, np.cumsum(covered)]
            n_hit = total[first[1:]] - total[first[:-1]]
            ids = [sorted("" if i is None else str(i) for i in x) for x in names]
            spans: list[list] = [[] for _ in range(len(batch))]
            for d in np.flatnonzero(n_hit):
                own = np.flatnonzero(np.diff(np.r_[0, covered[first[d] : first[d + 1]].astype(np.int8), 0]))
                base = batch.offsets[d]
                chars = np.r_[0, np.cumsum((batch.data[base : batch.offsets[d + 1]] & 0xC0) != 0x80)]
                spans[d] = [{"start": int(chars[starts[first[d] + a] - base]), "end": int(chars[ends[first[d] + b - 1] - base])} for a, b in zip(own[::2], own[1::2], strict=True)]
            yield pa.record_batch(
                [rows.column("doc_id"), pa.array(np.diff(first).astype(np.int64)), pa.array(n_hit.astype(np.int64)), pa.array(ids, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", "n_words", "n_hit", "items", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>")


def clean_only(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that no pattern hits.  One pass, no shuffle."""
    items = docs.sparkSession.sparkContext.broadcast(load_items(benchmark))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(items.value)
        for rows in tb.joined(batches, "text", tb.BATCH_BYTES):
            m = search(machine, tb.Batch.of(rows.column("text")))
            clean = np.ones(rows.num_rows, bool)
            clean[np.searchsorted(m.first, np.array(m.place, np.int64), side="right") - 1] = False
            yield rows.filter(pa.array(clean))

    return docs.mapInArrow(task, docs.schema)


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    from .common import table

    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
