"""Whole texts to token ids, a few megabytes at a time: each distinct part is encoded once.

A part ends before a single space that a non-space follows; no match of a byte-level BPE split
pattern goes across such a place, so parts encode on their own. Where the byte after the space
could begin a wider space character the text is left uncut, which is always right.
"""

from __future__ import annotations

import numpy as np

from emporia.llm.common import _BYTE_CODES, _MULT, Powers, mix64

#: Distinct parts that a worker remembers (about 50 bytes each); beyond it the memory starts anew.
REMEMBERED = 1_500_000
#: Longer parts are encoded each time they occur.
LONGEST_KEPT = 64

_CUT_BEFORE = np.ones(256, bool)
_CUT_BEFORE[:33] = False  # spaces and control characters
_CUT_BEFORE[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False  # lead bytes of the wider space characters


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start .. start + length of every run, one run after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


class PartTable:
    """Ids of the parts seen so far, by hash. ``make``: a list of parts (bytes) to lists of ids."""

    def __init__(self, make):
        self.make = make
        self.powers = Powers()
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _parts(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, lengths and hashes of the parts of the rows that begin at ``at``."""
        cut = np.zeros(len(data) + 1, bool)
        cut[:-2] = (data[:-1] == 32) & _CUT_BEFORE[data[1:]] if len(data) > 1 else cut[:-2]
        cut[at] = True
        edges = np.flatnonzero(cut)
        starts, lengths = edges[:-1], np.diff(edges)
        self.powers.reach(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * self.powers.up[: len(data)], out=total[1:])
        codes = (total[edges[1:]] - total[starts]) * self.powers.down[starts]
        return starts, lengths, mix64(codes + lengths.astype(np.uint64) * np.uint64(_MULT))

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows in order (uint32), and where each row's ids start, end appended."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        starts, lengths, codes = self._parts(data, at)
        if len(self.keys) > REMEMBERED:
            self.forget()
        place = np.minimum(np.searchsorted(self.keys, codes), max(len(self.keys) - 1, 0))
        known = self.keys[place] == codes if len(self.keys) else np.zeros(len(codes), bool)
        first = self.start[place] if len(self.keys) else np.zeros(len(codes), np.int64)
        count = self.length[place] if len(self.keys) else np.zeros(len(codes), np.int64)
        flat = self.flat
        missing = np.flatnonzero(~known)
        if len(missing):
            new, one, back = np.unique(codes[missing], return_index=True, return_inverse=True)
            one = missing[one]
            raw = data.tobytes()
            made = self.make([raw[s : s + n] for s, n in zip(starts[one].tolist(), lengths[one].tolist(), strict=True)])
            size = np.fromiter(map(len, made), np.int64, len(made))
            begin = len(flat) + np.cumsum(size) - size
            flat = np.concatenate([flat, np.fromiter((i for ids in made for i in ids), np.uint32, int(size.sum()))])
            first[missing], count[missing] = begin[back], size[back]
            kept = lengths[one] <= LONGEST_KEPT
            if kept.all():
                self.flat = flat
            else:  # without the long parts
                self.flat = np.concatenate([self.flat, flat[spread(begin[kept], size[kept])]])
                begin = np.cumsum(size * kept) - size * kept + len(flat) - int(size.sum())
            keys = np.concatenate([self.keys, new[kept]])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.start = np.concatenate([self.start, begin[kept]])[order]
            self.length = np.concatenate([self.length, size[kept]])[order]
        ends = np.concatenate([[0], np.cumsum(count)])
        return flat[spread(first, count)], ends[np.searchsorted(starts, at)]
