"""Ids of a public tokenizer for whole texts, with each distinct stretch encoded once a worker.

Both pre-tokenizers split before a space or line feed that a plain character follows, after
such a line feed, and between a letter and a stop; nothing beyond such a place changes the
ids before or after it. Texts are cut there, stretches are told apart by their hash, and the
library encodes each new one: a stretch that is one word or stop goes straight to the
library's BPE model, any other through its whole chain. The memory of stretches is emptied
when full, so it never grows with the input.
"""

from __future__ import annotations

import re

import numpy as np
from tokenizers import Tokenizer

from silverlode.llm.buffers import LOWER, groups, prefix, ragged, slices

# Fixed: ASCII graphic characters and the lead byte of U+00C0..U+00FF, none of them white space.
ENCODE_BYTES = 1 << 21  # distinct stretches are encoded once a group
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_PLAIN[0xC3] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x0A]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ",.!?;:"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
_ONE_PIECE = re.compile("[ \\n]?(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[,.!?;:])")
# Byte-level vocabularies write a byte as its own printable Latin-1 character, any other from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in set(_PRINTED))}
_open: dict[str, Encoder] = {}


class Encoder:
    """Encode byte buffers; ``room`` bounds the stretches kept."""

    def __init__(self, path: str, room: int = 2_000_000) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.fold = self.tokenizer.normalizer is not None  # lower case, white space dropped
        self.room = room
        self._forget()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        found: list[list[int] | None] = []
        rest: list[str] = []
        for text in texts:
            if _ONE_PIECE.fullmatch(text) and (self.fold or text[0] != "\n" or len(text) == 1):
                piece = text.strip(" \n").lower() if self.fold else text
                piece = piece.encode().decode("latin-1").translate(_BYTE_CHARS)
                found.append([t.id for t in self.model.tokenize(piece)])
            else:
                found.append(None)
                rest.append(text)
        more = iter(self.tokenizer.encode_batch(rest, add_special_tokens=False))
        return [next(more).ids if ids is None else ids for ids in found]

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint16), 0

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        if len(self.keys) + len(keys) > self.room:
            self._forget()
        for at in range(0, len(texts), 4096):
            found = self._ids(texts[at : at + 4096])
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            total = int(lengths.sum())
            if self.used + total > len(self.pool):
                self.pool = np.concatenate((self.pool, np.zeros(max(len(self.pool), total), np.uint16)))
            self.pool[self.used : self.used + total] = [i for ids in found for i in ids]
            starts = self.used + np.cumsum(lengths) - lengths
            self.used += total
            new = keys[at : at + 4096]
            place = np.searchsorted(self.keys, new)
            self.keys = np.insert(self.keys, place, new)
            self.starts = np.insert(self.starts, place, starts)
            self.lengths = np.insert(self.lengths, place, lengths)

    def _group(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            gap = _SPACE[data[:-1]] & _PLAIN[data[1:]]
            cut[:-2] = gap
            cut[1:-1] |= gap & (data[:-1] == 0x0A)
            cut[1:-1] |= _STOP[data[1:]] & _LETTER[data[:-1]]
            accented = (data[:-2] == 0xC3) & _STOP[data[2:]] & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7)
            cut[2:-1] |= accented
        cut[offsets] = True
        marks = np.flatnonzero(cut)
        start, end = marks[:-1], marks[1:]
        if self.fold:
            bare = start + (_SPACE[data[start]] & (end > start + 1))
            hashed = slices(prefix(LOWER[data]), bare, end)
        else:
            hashed = slices(prefix(data), start, end)
        keys, first, which = np.unique(hashed, return_index=True, return_inverse=True)
        for _ in range(2):  # a second time if learning emptied the memory
            place = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
            known = self.keys[place] == keys if len(self.keys) else np.zeros(len(keys), bool)
            if known.all():
                break
            new = np.flatnonzero(~known)
            if len(self.keys) + len(new) > self.room:
                self._forget()
                new = np.arange(len(keys))
            whole = data.tobytes()
            at = first[new]
            self._learn(keys[new], [whole[s:e].decode("utf-8", "replace") for s, e in zip(start[at], end[at])])
        place = np.searchsorted(self.keys, keys)
        starts, lengths = self.starts[place][which], self.lengths[place][which]
        sums = np.concatenate(([0], np.cumsum(lengths)))
        return self.pool[ragged(starts, lengths)], sums[np.searchsorted(start, offsets)]

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Yield (first row, ids, offsets of the ids) for runs of rows."""
        for i, j in groups(offsets, ENCODE_BYTES):
            own = data[offsets[i] : offsets[j]]
            if len(own):
                ids, places = self._group(own, offsets[i : j + 1] - offsets[i])
            else:
                ids, places = np.zeros(0, np.uint16), np.zeros(j - i + 1, np.int64)
            yield i, ids, places


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _open:
        _open[path] = Encoder(path)
    return _open[path]
