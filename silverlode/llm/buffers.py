"""Vectorised work on the bytes of many texts: boundaries, rolling hashes, ragged gathers.

A batch of texts is one byte buffer and its offsets, as Arrow holds it. Hashes are
polynomials over Z/2^64 with an odd base, so that the hash of any slice is a difference of
two prefix sums; ``mix`` then spreads every bit over the word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 19  # working arrays take some hundred bytes for each of them, in every worker of an executor
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a text or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind, binary = np.int64, pa.large_binary()
    else:
        kind, binary = np.int32, pa.binary()
    column = column.view(binary) if column.type != binary else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(offsets: np.ndarray, target: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole rows of about ``target`` bytes, so that working arrays stay small."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + target, "right")) - 1)
        yield start, min(end, rows)
        start = min(end, rows)


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0], k = 1, 1
        while k < size:
            have[k : 2 * k] = have[:k] * np.uint64(pow(base, k, 1 << 64))
            k *= 2
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``slices`` takes the hash of any slice; bytes go through a fixed table."""
    terms = _TABLE[values] if values.dtype == np.uint8 else values
    sums = np.zeros(len(terms) + 1, np.uint64)
    np.cumsum(terms * powers(len(terms), _INVERSE), out=sums[1:])
    return sums


def slices(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of the slices [start, end): equal content, equal hash."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[start] + (end - start).astype(np.uint64))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every run, one run after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


# Bytes that belong to words: ASCII letters and digits, and all of UTF-8 beyond ASCII.
WORD_BYTES = np.zeros(256, bool)
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    WORD_BYTES[ord(_first) : ord(_last) + 1] = True
WORD_BYTES[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte, end byte and row of each word, in order of the text.

    A word is a run of letters, digits and non-ASCII characters; ASCII case does not count.
    """
    inside = WORD_BYTES[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = (inside[0], inside[-1]) if len(data) else (False, False)
    if len(data):
        edge[1:-1] = inside[1:] != inside[:-1]
    joints = offsets[1:-1]
    joints = joints[(joints > 0) & (joints < len(data))]
    cut = joints[inside[joints] & inside[joints - 1]]  # a word never spans two rows
    marks = np.sort(np.concatenate((np.flatnonzero(edge), np.unique(cut), np.unique(cut))))
    start, end = marks[0::2], marks[1::2]
    hashed = slices(prefix(LOWER[data]), start, end)
    return hashed, start, end, np.searchsorted(offsets, start, "right") - 1


def shingles(hashed: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word and row of each run of ``size`` words; a shorter row is one shingle of all its words."""
    counts = np.bincount(rows, minlength=n_rows)
    first = np.cumsum(counts) - counts
    number = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    start = ragged(first, number)
    owner = np.repeat(np.arange(n_rows), number)
    end = start + np.minimum(size, counts[owner])
    return slices(prefix(hashed), start, end), start, owner


def occurrence(owner: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """How often the same value came before in the same row."""
    order = np.lexsort((hashed, owner))
    o, h = owner[order], hashed[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    at = np.arange(len(o))
    label = np.empty(len(o), np.int64)
    label[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return label
