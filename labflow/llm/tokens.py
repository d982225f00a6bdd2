"""Token ids of many texts by a public tokenizer, one call per new word instead of one per text.

The vocabularies of the ``word_bpe`` kind drop white space and never merge across it, so a text's ids are the ids
of its words in order.  Most words repeat: a piece is encoded once by the ``tokenizers`` library, kept in a bounded table,
found there by a 64-bit hash of its bytes, and gathered back into documents by array indexing.  ``tests/llm`` compares the result
with the library's own ids of whole texts.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

from . import textblocks as tb

#: Distinct pieces kept per Python worker; beyond it the table starts anew.
KEEP_PIECES = 400_000
#: Bits of the table of hashes; a piece whose slot is taken is looked up by its bytes.
SLOT_BITS = 20
#: Plain pieces in one text for the library.
JOINED = 512

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
#: Bytes that may touch a neighbour in ways that only the library judges: apostrophes, and every byte above ASCII
#: but for those of the letters U+00C0 to U+00FF.
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True


class WordTokenizer:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.lib = Tokenizer.from_file(path)
        suffix = json.loads(self.lib.to_str())["model"].get("end_of_word_suffix")
        #: by id, whether it ends a word; None for vocabularies that don't mark it
        self.ends = None
        if suffix:
            self.ends = np.zeros(max(self.lib.get_vocab(True).values()) + 1, bool)
            self.ends[[i for token, i in self.lib.get_vocab(False).items() if token.endswith(suffix)]] = True
        self._reset()

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.hashes, self.full, self.place = np.zeros(1 << SLOT_BITS, np.uint64), np.zeros(1 << SLOT_BITS, bool), np.zeros(1 << SLOT_BITS, np.int32)

    def _add(self, pieces: list[bytes], plain: np.ndarray) -> None:
        """Encode new pieces.  Plain ones, of which each is one word to the library, go joined by spaces."""
        one_by_one = np.flatnonzero(~plain)
        if self.ends is None:
            one_by_one = np.arange(len(pieces))
        else:
            own = np.flatnonzero(plain)
            for a in range(0, len(own), JOINED * 8):
                part = own[a : a + JOINED * 8]
                texts = [b" ".join([pieces[i] for i in part[k : k + JOINED].tolist()]).decode("utf-8") for k in range(0, len(part), JOINED)]
                ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)])
                stop = np.flatnonzero(self.ends[ids]) + 1
                if len(stop) == len(part):
                    self._keep([pieces[i] for i in part.tolist()], ids, np.diff(stop, prepend=0))
                else:
                    one_by_one = np.r_[one_by_one, part]
        for a in range(0, len(one_by_one), 4096):
            part = [pieces[i] for i in one_by_one[a : a + 4096].tolist()]
            found = [e.ids for e in self.lib.encode_batch_fast([p.decode("utf-8", "replace") for p in part], add_special_tokens=False)]
            self._keep(part, np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64))

    def _keep(self, pieces: list[bytes], ids: np.ndarray, length: np.ndarray) -> None:
        k, n = len(self.known), len(pieces)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while k + n > len(self.start):
            self.start, self.length = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.length))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[k : k + n], self.length[k : k + n] = self.used + np.cumsum(length) - length, length
        self.known.update(zip(pieces, range(k, k + n), strict=True))
        self.used += len(ids)

    def encode(self, batch: tb.Batch) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, and offsets: ``ids[offsets[i]:offsets[i + 1]]`` are those of document i."""
        starts, ends, first, plain = _pieces(batch)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(batch) + 1, np.int64)
        if len(self.known) > KEEP_PIECES:
            self._reset()
        data = tb.lower_ascii(batch.data)
        hashes = tb.word_hashes(data, starts, ends)
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        at = self.place[slot]
        other = np.flatnonzero((self.hashes[slot] != hashes) | ~self.full[slot])
        if len(other):
            found, example, back = np.unique(hashes[other], return_index=True, return_inverse=True)
            example = other[example]
            raw = data.tobytes()
            pieces = [raw[a:b] for a, b in zip(starts[example].tolist(), ends[example].tolist(), strict=True)]
            missing = np.array([i for i, p in enumerate(pieces) if p not in self.known], np.int64)
            self._add([pieces[i] for i in missing.tolist()], plain[example[missing]])
            new = np.array([self.known[p] for p in pieces], np.int32)
            at[other] = new[back]
            own = np.flatnonzero(~self.full[slot[example]])
            put = slot[example[own]]
            self.hashes[put], self.place[put], self.full[put] = found[own], new[own], True
            # of two new pieces in one slot the last one stays, in all three tables alike
        n = self.length[at]
        ends_at = np.cumsum(n)
        begin = self.start[at] - (ends_at - n)
        ids = self.ids[np.repeat(begin, n) + np.arange(ends_at[-1])]
        return ids, np.r_[0, ends_at][first]


def _pieces(batch: tb.Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words cut further where the library cuts for certain: between letters, single digits and runs of ASCII signs.

    A word with an apostrophe, ``<|`` (special ids) or a byte that isn't ASCII or a Latin-1 letter stays whole; the other
    pieces are plain: letters only, one digit, or signs only.  Gives starts, ends, first piece by document, and plain.
    """
    starts, ends, first = tb.words(batch)
    data = batch.data
    if not len(starts):
        return starts, ends, first, np.zeros(0, bool)
    odd = (data >= 0x80) | (data == 0x27) | (data < 0x20)
    lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
    follow = data[lead + 1]
    fine = lead[(follow >= 0x80) & (follow < 0xC0) & (follow != 0x97) & (follow != 0xB7)]
    odd[fine] = odd[fine + 1] = False
    odd[np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))] = True
    bad = np.add.reduceat(np.r_[odd, False].astype(np.int32), np.c_[starts, ends].ravel())[::2] > 0
    letter, digit = _LETTER[data], _DIGIT[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = (letter[1:] != letter[:-1]) | digit[1:] | digit[:-1]
    whole = np.zeros(len(data) + 1, np.int32)
    np.add.at(whole, starts[bad], 1)
    np.add.at(whole, ends[bad], -1)
    edge[np.cumsum(whole) > 0] = False
    edge[starts] = True
    inside = np.zeros(len(data) + 1, np.int32)
    inside[starts] += 1
    inside[ends] -= 1
    edge[np.cumsum(inside) <= 0] = False
    cuts = np.flatnonzero(edge)
    nxt = np.r_[cuts[1:], len(data)]
    word = np.searchsorted(starts, cuts, side="right") - 1
    return cuts, np.minimum(nxt, ends[word]), np.searchsorted(cuts, batch.offsets), ~bad[word]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int | None, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with ``end_id`` (if any) after each document, as little-endian integers of ``width`` bytes, and their offsets."""
    kind = np.dtype(f"<u{width}")
    if len(ids) and int(ids.max()) > np.iinfo(kind).max or end_id is not None and end_id > np.iinfo(kind).max:
        raise ValueError(f"this vocabulary has ids that do not fit {width} bytes")
    if end_id is None:
        return ids.astype(kind), offsets
    at = offsets + np.arange(len(offsets))
    out = np.full(int(at[-1]), end_id, kind)
    keep = np.ones(len(out), bool)
    keep[at[1:] - 1] = False
    out[keep] = ids
    return out, at


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker and file, kept between tasks."""
    return WordTokenizer(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
