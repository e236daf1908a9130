"""64-bit hashes of many byte spans at once, and a table that remembers spans by their bytes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

#: Spans of more bytes are hashed one by one by a cryptographic hash.
LONG = 256
_SEED, _ODD = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E3779B97F4A7C15)
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # masks of the first k bytes of a word


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on each other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for every span; equal bytes give equal hashes anywhere.

    Eight bytes at a time go through ``mix``, a chain that has no algebra which repeated or
    regular text could meet; spans of over ``LONG`` bytes take BLAKE2.
    """
    size = ends - starts
    out = mix(size.astype(np.uint64) ^ _SEED)
    eights, active = _eights(data), np.flatnonzero((size > 0) & (size <= LONG))
    done = 0
    while len(active):
        left = size[active] - done
        word = eights[starts[active] + done] & _KEEP[np.minimum(left, 8)]
        out[active] = mix((out[active] ^ word) * _ODD + np.uint64(done + 1))
        done += 8
        active = active[left > 8]
    for k in np.flatnonzero(size > LONG):
        out[k] = int.from_bytes(hashlib.blake2b(data[starts[k]:ends[k]], digest_size=8).digest(), "little")
    return out


class SpanTable:
    """Slots that remember spans of at most ``8 * words`` bytes; a span is known only if its bytes are equal."""

    def __init__(self, slots: int, words: int):
        self.slots, self.longest = slots, 8 * words
        self.words, self.size = np.zeros((slots, words), np.uint64), np.zeros(slots, np.uint8)

    def look(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(slot, known, first, same) of every span.

        ``first`` are unknown spans of unequal bytes, and ``same`` gives for each unknown span,
        in order, its equal's place among them.
        """
        size = ends - starts
        packed, eights = np.zeros((len(starts), self.words.shape[1]), np.uint64), _eights(data)
        active = np.flatnonzero(size <= self.longest)
        short = np.zeros(len(starts), bool)
        short[active] = True
        key = mix(size.astype(np.uint64) ^ _SEED)
        for k in range(packed.shape[1]):
            active = active[size[active] > 8 * k]
            packed[active, k] = eights[starts[active] + 8 * k] & _KEEP[np.minimum(size[active] - 8 * k, 8)]
            key[active] = mix((key[active] ^ packed[active, k]) * _ODD + np.uint64(8 * k + 1))
        slot = (key & np.uint64(self.slots - 1)).astype(np.int64)
        known = short & (self.size[slot] == size) & (self.words[slot] == packed).all(axis=1)
        new = np.flatnonzero(~known)
        few = new[short[new]]
        _, at, back = np.unique(key[few], return_index=True, return_inverse=True)
        same = np.zeros(len(new), np.int64)
        equal = (packed[few] == packed[few[at]][back]).all(axis=1) & (size[few] == size[few[at]][back])
        same[short[new]] = back
        alone = np.ones(len(new), bool)  # long spans, and those whose hash alone is another's
        alone[short[new]] = ~equal
        same[alone] = len(at) + np.arange(alone.sum())
        self._packed = packed
        return slot, known, np.concatenate([few[at], new[alone]]), same

    def keep(self, slot: np.ndarray, size: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Remembers short spans of the last ``look``; gives which of ``spans`` now own their slots."""
        fits = np.flatnonzero(size[spans] <= self.longest)
        _, one = np.unique(slot[spans[fits]], return_index=True)
        one = fits[one]
        own = spans[one]
        self.words[slot[own]], self.size[slot[own]] = self._packed[own], size[own]
        return one

    def clear(self) -> None:
        self.size[:] = 0


def blocks(texts: pa.Array, most: int = 1 << 20):
    """(first row, bytes, offsets) of runs of rows of about ``most`` bytes; a longer text is a run of its own.

    A null text has no bytes.
    """
    texts = texts.cast(pa.large_binary())
    lengths = np.zeros(len(texts), np.int64)
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    lengths = np.diff(offsets)
    row = 0
    while row < len(lengths):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the runs of bytes other than space and 0x09-0x0D, cut at the rows' ends."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    inside = np.concatenate([[False], ~space, [False]])
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1
