"""Token ids of texts by a tokenizers file, encoding each distinct piece of text once.

Pieces end where the pre-tokenizer always splits, so the ids of a text are the ids of its pieces
one after the other. A piece that was met before is looked up by its 64-bit hash and length; the
new pieces of a block go to the tokenizer as one batch. What is remembered is bounded, and long
pieces are not remembered at all.

Both tokenizers here split runs of letters, of digits (or single digits) and of other visible characters from each other, and
keep an English contraction such as 's together with its apostrophe. So a text may be cut
- before white space that follows a visible ASCII character,
- before a space that a visible ASCII character follows,
- between visible ASCII characters of different kinds, unless the first is an apostrophe, or one
  of them is a bar, which the special strings contain.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from riskmart.llm.words import Words

REMEMBERED = 600_000  # pieces; the memory is emptied beyond
LONGEST = 64  # bytes of a piece worth remembering

_BLANK, _VISIBLE = 1, 2
_KIND = np.zeros(256, np.uint8)  # 0: not ASCII, or a control character
_KIND[[0x20, *range(0x09, 0x0E)]] = _BLANK
_KIND[0x21:0x7F] = _VISIBLE
_KIND[0x30:0x3A] = 3
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 4


def safe_pieces(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Pieces of all rows that can be encoded one by one; every byte is in exactly one of them."""
    kind = _KIND[data]
    before, after = kind[:-1], kind[1:]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (after == _BLANK) & (before >= _VISIBLE)
    special = (data == 0x7C) | (data == 0x27)
    cut[1:-1] |= (before >= _VISIBLE) & (after >= _VISIBLE) & (before != after) & ~special[:-1] & (data[1:] != 0x7C)
    cut[:-2] |= (data[:-1] == 0x20) & (after >= _VISIBLE)
    cut[offsets] = True
    cut[-1] = False
    starts = np.flatnonzero(cut)
    return Words(data, starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets))


class PieceEncoder:
    def __init__(self, path: str, keep_ids: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer, self.keep_ids = Tokenizer.from_file(path), keep_ids
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._forget()

    def _forget(self) -> None:
        self.places: dict[int, int] = {}
        self.lengths, self.used = np.zeros(1024, np.int64), 0
        self.starts, self.ids, self.filled = np.zeros(1024, np.int64), np.zeros(4096, np.uint32), 0

    def _add(self, encoded: list) -> int:
        """Stores encoded pieces; the place of the first."""
        first, last = self.used, self.used + len(encoded)
        if last > len(self.lengths):
            self.lengths, self.starts = (np.resize(a, max(last, 2 * first)) for a in (self.lengths, self.starts))
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        self.lengths[first:last] = counts
        self.used = last
        if self.keep_ids:
            total = int(counts.sum())
            if self.filled + total > len(self.ids):
                self.ids = np.resize(self.ids, max(self.filled + total, 2 * self.filled))
            self.starts[first:last] = self.filled + np.cumsum(counts) - counts
            self.ids[self.filled : self.filled + total] = np.fromiter((i for e in encoded for i in e.ids), np.uint32, total)
            self.filled += total
        return first

    def places_of(self, cut: Words) -> np.ndarray:
        """Place of each piece in ``lengths`` (and ``starts`` of ``ids``), good until the next call."""
        if self.used > REMEMBERED:
            self._forget()
        starts, ends = cut.starts, cut.ends
        keys = cut.hashes() ^ (ends - starts).astype(np.uint64)
        keys, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        get = self.places.get
        places = np.fromiter((get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        new = np.flatnonzero(places < 0)
        if len(new):
            at = first[new]
            text = cut.data.tobytes()
            pieces = [text[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            encoded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
            places[new] = self._add(encoded) + np.arange(len(new))
            short = ends[at] - starts[at] <= LONGEST
            self.places.update(zip(keys[new][short].tolist(), places[new][short].tolist()))
        return places[inverse]


@lru_cache(maxsize=2)
def encoder(path: str, keep_ids: bool) -> PieceEncoder:
    """One encoder for each Python worker."""
    return PieceEncoder(path, keep_ids)
