"""Token ids of whole texts with a public tokenizer, each distinct piece of text encoded once.

The tokenizers used here never join text across certain places: before the last space of a run
of white space, after a single line break, and between a Latin letter and punctuation. Texts are cut there,
pieces are looked up in a table kept by the Python worker, which compares their bytes, and the
tokenizer itself encodes those not seen before.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from casona.llm.bytehash import SpanTable, blocks

#: Pieces up to so many bytes are remembered, by these bytes.
SHORT = 32
#: Pieces remembered, at most, and ids a slot before the table is emptied.
SLOTS, IDS_A_SLOT = 1 << 20, 8

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
_MARK = _VISIBLE & ~_LETTER
_MARK[48:58] = False
_MARK[[ord(c) for c in "'<|>"]] = False  # contractions and special tokens stay whole
# bytes that no white space can begin with
_SOLID = np.ones(256, bool)
_SOLID[:33] = False
_SOLID[[0xC2, 0xE1, 0xE2, 0xE3]] = False


#: Put behind each of so many words that are encoded together; words that hold it are encoded alone.
MARK, TOGETHER = " |", 64


def _is_word(text: str) -> bool:
    """Whether tokenizers read a text after anything as they read it alone: it begins with a space and no further white space."""
    return len(text) > 1 and text[0] == " " and (32 < ord(text[1]) < 128 or 0xC0 <= ord(text[1]) < 0x1000) and "|" not in text


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where pieces begin, each text's own start included."""
    if not len(data):
        return np.empty(0, np.int64)
    begin = np.zeros(len(data) + 1, bool)
    letter, solid = _LETTER[data], _SOLID[data]
    begin[1:-1] = letter[:-1] & _MARK[data[1:]]
    begin[:-2] |= (data[:-1] == 32) & solid[1:]
    begin[2:-1] |= (data[1:-1] == 10) & _VISIBLE[data[:-2]] & solid[2:]
    begin[offsets] = True
    return np.flatnonzero(begin[:-1])


class Pieces:
    """A tokenizer with its table of remembered pieces; ``plain`` reads the strings of special tokens as text."""

    def __init__(self, path: str, plain: bool = False, slots: int = SLOTS):
        self.slots = slots
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.mark = self._ids([MARK])[0]
        self._clear()

    def _clear(self) -> None:
        self.table = SpanTable(self.slots, SHORT // 8)
        self.at = np.zeros(self.slots, np.int32)
        self.count = np.zeros(self.slots, np.uint16)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return cuts(data, offsets)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many of each). Words are encoded many at a time with a mark between them that is one id."""
        count = np.zeros(len(texts), np.int64)
        words = [k for k, t in enumerate(texts) if _is_word(t)]
        if len(self.mark) == 1 and words:
            lines = [MARK.join([texts[k] for k in words[n:n + TOGETHER]] + [""]) for n in range(0, len(words), TOGETHER)]
            flat = np.fromiter(chain.from_iterable(self._ids(lines)), np.uint32)
            ends = np.flatnonzero(flat == self.mark[0])
            if len(ends) == len(words):
                rest = sorted(set(range(len(texts))) - set(words))
                others = self._ids([texts[k] for k in rest])
                count[words], count[rest] = np.diff(ends, prepend=-1) - 1, [len(x) for x in others]
                before = np.cumsum(count) - count
                out = np.empty(int(count.sum()), np.uint32)
                own = np.delete(flat, ends)
                size = count[words]
                out[np.repeat(before[words] - (np.cumsum(size) - size), size) + np.arange(len(own))] = own
                for k, x in zip(rest, others):
                    out[before[k]:before[k] + len(x)] = x
                return out, count
        encoded = self._ids(texts)
        count[:] = [len(x) for x in encoded]
        return np.fromiter(chain.from_iterable(encoded), np.uint32, int(count.sum())), count

    def _append(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, count = self._encode(texts)
        at = self.used + np.cumsum(count) - count
        self.used += len(flat)
        if self.used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(flat)), np.uint32)])
        self.ids[self.used - len(flat):self.used] = flat
        return at, count

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, ids before each text and at the end)."""
        if self.used > IDS_A_SLOT * self.slots:
            self._clear()
        starts = self._cuts(data, offsets)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        slot, known, first, same = self.table.look(data, starts, ends)
        at, count = self.at[slot].astype(np.int64), self.count[slot].astype(np.int64)
        if len(first):
            raw = data.tobytes()
            got_at, got_count = self._append([raw[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist())])
            at[~known], count[~known] = got_at[same], got_count[same]
            own = self.table.keep(slot, ends - starts, first)
            self.at[slot[first[own]]], self.count[slot[first[own]]] = got_at[own], got_count[own]
        before = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(at - before[:-1], count) + np.arange(before[-1])]
        return ids, before[np.searchsorted(starts, offsets)]


class SentencePieces(Pieces):
    """A sentencepiece model over texts that begin with the space it would add; no piece goes on from a letter to a space."""

    def __init__(self, path: str, slots: int = SLOTS):
        import sentencepiece

        self.slots = slots
        self.model, self.mark = sentencepiece.SentencePieceProcessor(model_file=path), []
        self._clear()

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not len(data):
            return np.empty(0, np.int64)
        begin = np.zeros(len(data) + 1, bool)
        begin[1:-1] = (data[1:] == 32) & (data[:-1] != 32)
        begin[offsets] = True
        return np.flatnonzero(begin[:-1])

    def _ids(self, texts: list[str]) -> list[list[int]]:
        alone = [self.model.piece_to_id("\u2581")]  # nothing is added to an empty text
        return [ids if t != " " else alone for t, ids in zip(texts, self.model.encode([t[1:] for t in texts], num_threads=1))]


@lru_cache(maxsize=4)
def pieces(path: str, plain: bool = False, slots: int = SLOTS) -> Pieces:
    return SentencePieces(path, slots) if path.endswith(".model") else Pieces(path, plain, slots)


def encoded(texts: pa.Array, path: str, end_id: int, slots: int = SLOTS):
    """(first row, ids, places) of runs of texts, ``end_id`` after each text; a null text has only that.

    Row ``first + k`` of the texts owns ids[places[k]:places[k + 1]].
    """
    model = pieces(path, False, slots)
    for first, data, offsets in blocks(texts):
        ids, at = model.encode(data, offsets)
        places = at + np.arange(len(at))
        out = np.full(places[-1], end_id, np.uint32)
        keep = np.ones(len(out), bool)
        keep[places[1:] - 1] = False
        out[keep] = ids
        yield first, out, places
