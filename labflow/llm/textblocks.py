"""Array views of batches of text: words, word hashes and rolling hashes.

Every function works on one *batch*: the UTF-8 bytes of several documents laid end to end, with the offsets
at which each document starts.  All work is vectorised, so a task's cost is a few passes over its bytes and
its memory is a small multiple of the batch, whatever the length of a single document.

Hashes are 64 bits wide, made of mixed 8-byte chunks, and depend on content only: the same words give the same
hash in every task and every run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

U64 = np.uint64
_C1, _C2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_GOLD = U64(0x9E3779B97F4A7C15)
_STEP = U64(0xD6E8FEB86659FD93)

#: A batch is closed once it holds this many bytes; one longer document is a batch of its own.
BATCH_BYTES = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * _C1
    x = x ^ (x >> U64(27))
    x = x * _C2
    return x ^ (x >> U64(31))


_BYTE_HASH = mix(np.arange(1, 257, dtype=U64) * _GOLD)

#: Space, tab, line feed, vertical tab, form feed and carriage return end a word.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class Batch:
    """Documents laid end to end; ``offsets[i]:offsets[i + 1]`` are the bytes of document i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    @staticmethod
    def of(texts: pa.Array | pa.ChunkedArray) -> "Batch":
        """Nulls count as empty texts."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
        texts = texts.cast(pa.large_binary())
        if texts.null_count:
            texts = texts.fill_null(b"")
        n = len(texts)
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        return Batch(raw, at - at[0])


def slices(table: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a record batch where the text of ``column`` passes ``limit`` bytes, so that arrays stay small."""
    sizes = table.column(column).cast(pa.large_binary())
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(sizes), 0), dtype=np.int64)
    ends, start = np.cumsum(lengths), 0
    while start < table.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield table.slice(start, stop - start)
        start = stop


def joined(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Regroup record batches so that each holds about ``limit`` bytes of text."""
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in slices(batch, column, limit):
            more = pa.compute.sum(pa.compute.binary_length(part.column(column))).as_py() or 0
            if kept and size + more > limit:
                yield _one(kept)
                kept, size = [], 0
            kept.append(part)
            size += more
    if kept:
        yield _one(kept)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches(max_chunksize=None)[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    return _LOWER[data]


def words(batch: Batch, breaks: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and ``first``: ``first[i]:first[i + 1]`` are the words of document i.

    A word is a maximal run of bytes outside ``breaks`` that does not leave its document.
    """
    inside = np.zeros(len(batch.data) + 2, bool)
    inside[1:-1] = np.frombuffer(batch.data.tobytes().translate((~breaks).tobytes()), bool)
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turn[::2], turn[1::2]
    cuts = batch.offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(batch.data))])
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(starts, batch.offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, 8 bytes at a step."""
    lengths = ends - starts
    out = (lengths.astype(U64) + U64(1)) * _GOLD
    if not len(starts):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    wide = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    keep = np.concatenate([(U64(1) << (np.arange(8, dtype=U64) * U64(8))) - U64(1), np.array([~U64(0)], U64)])
    left = np.arange(len(starts))
    at = 0
    while len(left):
        rest = lengths[left] - at
        chunk = wide[starts[left] + at] & keep[np.minimum(rest, 8)]
        out[left] = mix(out[left] ^ chunk) + _STEP
        at += 8
        left = left[rest > 8]
        if at >= 1024 and len(left):  # giant words: one pass each over what remains
            for i in left:
                out[i] = _long_hash(out[i], data[starts[i] + at : ends[i]])
            break
    return mix(out)


def _long_hash(seed: np.uint64, data: np.ndarray) -> np.uint64:
    padded = np.concatenate([data, np.zeros(-len(data) % 8, np.uint8)]).view("<u8").astype(U64)
    place = mix(np.arange(1, len(padded) + 1, dtype=U64) * _GOLD) | U64(1)
    total = np.array([seed], U64) + np.sum(mix(padded + place) * place, dtype=U64)
    return mix(total)[0]


def rolling(hashes: np.ndarray, width: int, salt: int = 1) -> np.ndarray:
    """Hash of each run of ``width`` consecutive values; the result is ``width - 1`` shorter (or empty).

    Doubling steps: a run of 2k values is two neighbouring runs of k, so the cost is logarithmic in the width.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    factor = mix(np.array([salt], U64) * _GOLD)[0] | U64(1)
    out, done = None, 0
    block, size, step = hashes, 1, factor
    rest = width
    while rest:
        if rest & 1:
            part = block[done : done + n]
            with np.errstate(over="ignore"):
                out = part.copy() if out is None else out * step + part
            done += size
        rest >>= 1
        if rest:
            with np.errstate(over="ignore"):
                block = block[:-size] * step + block[size:]
                step = step * step
            size *= 2
    return mix(out)


def byte_hashes(data: np.ndarray) -> np.ndarray:
    return _BYTE_HASH[data]


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in at least one window of ``width`` that begins at a place in ``starts``."""
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + width, n), -1)
    return np.cumsum(edges[:-1]) > 0


def within(first: np.ndarray, width: int) -> np.ndarray:
    """Mask over the runs of ``rolling``: True where a run of ``width`` stays in one document."""
    n = int(first[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    ok = np.ones(n, bool)
    ends = first[1:]
    for back in range(1, width):
        at = ends - back
        at = at[(at >= 0) & (at < n)]
        ok[at] = False
    return ok


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` consecutive values, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:n], out[width - size : width - size + n])
