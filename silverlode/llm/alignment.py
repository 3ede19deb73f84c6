"""Alignment of two tokenizers by lockstep merging.

A is a byte-level BPE, read with a space before the text; B is a sentence-piece BPE, which adds that space itself. Both
then cover the same bytes, and byte offsets where a token of each ends cut them into groups. Every document
of a batch is a lane (a long one is several, split at places where both tokenizers always cut, kept only where both did):
one state vector holds the next A and B token of all lanes, each step compares their ends, advances the one that ends first,
or both with a cut, and lanes that reach their end are compacted away. A step emits the tokens it passed and the cuts it made.

Links are all pairs of an A and a B token in one group. How many documents link a pair of ids is counted over the corpus: batches
of at most 2 MB (one longer document is a batch by itself) send each different pair once with its number of documents,
Spark sums them by pair, and every batch gets back the counts of its own pairs, so that a frequent pair is one row for each batch.

``groups`` returns the alignment itself (ids, group sizes, cuts), ``agreement`` the figures for each document.

Cases: a text that is null or empty, or whose A or B bytes differ from space + text (U+2581 in it, say), has no tokens: zeros,
empty lists and ''. Repeated rows are documents of their own, null keys stay; a group of p A and q B tokens makes p * q links, counted by
product; very long texts are whole; an empty table gives an empty result. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from silverlode.llm.buffers import groups as runs_of_rows
from silverlode.llm.buffers import prefix, ragged, slices, text_buffer
from silverlode.llm.frames import stored
from silverlode.llm.tokens import _BYTE_CHARS, _PLAIN, _PRINTED, encoder

LANE_BYTES = 1024
PAIR_BITS = 16
_SPACE = 0x20
_open: dict[str, Pieces] = {}
_spelt: dict[str, Spelling] = {}


class Spelling:
    """The bytes of every id of a vocabulary, as one pool."""

    def __init__(self, entries: list[bytes]) -> None:
        self.lengths = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.pool = np.frombuffer(b"".join(entries), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.pool[ragged(self.starts[ids], self.lengths[ids])]


def byte_level_spelling(path: str) -> Spelling:
    """A's entries, each character of which stands for a byte."""
    if path not in _spelt:
        byte = {chr(b): b for b in _PRINTED} | {chr(c): b for b, c in _BYTE_CHARS.items()}
        tokenizer = encoder(path).tokenizer
        entries = [tokenizer.id_to_token(k) or "" for k in range(tokenizer.get_vocab_size())]
        _spelt[path] = Spelling([bytes(byte[c] for c in e) if all(c in byte for c in e) else b"" for e in entries])
    return _spelt[path]


def _holds(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values an ordered array has; nothing is built from the array, which may be large."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


class Pieces:
    """B's ids of byte buffers that start with a space; no piece has a space after another character, so words stand alone.

    A stretch from a space (or a run of them) to the next is encoded once; ``room`` bounds the stretches kept.
    """

    def __init__(self, path: str, room: int = 1_000_000) -> None:
        self.processor = SentencePieceProcessor(model_file=path)
        pieces = [self.processor.id_to_piece(k) for k in range(self.processor.get_piece_size())]
        plain = [p.replace("▁", " ") for p in pieces]
        if any(" " in p.lstrip(" ") for p in plain):
            raise ValueError("a piece of this model reaches over a space")
        spelt = [bytes([int(p[3:-1], 16)]) if self.processor.is_byte(k) else p.encode() for k, p in enumerate(plain)]
        special = [self.processor.is_control(k) or self.processor.is_unknown(k) for k in range(len(pieces))]
        self.spelling = Spelling([b"" if s else b for s, b in zip(special, spelt)])
        self.room = room
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint16)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        lone = [self.processor.piece_to_id("▁")]  # a space at the end of a text; the library adds none to an empty one
        found = [ids or lone for ids in self.processor.encode(texts, num_threads=1)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        starts = len(self.pool) + np.cumsum(lengths) - lengths
        flat = np.fromiter((i for ids in found for i in ids), np.uint16, int(lengths.sum()))
        self.pool = np.concatenate((self.pool, flat))
        place = np.searchsorted(self.keys, keys)
        self.keys, self.starts, self.lengths = (np.insert(a, place, b) for a, b in ((self.keys, keys), (self.starts, starts), (self.lengths, lengths)))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and the offset of each row's ids; every row starts with a space."""
        space = data == _SPACE
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(data))
        keys, first, which = np.unique(slices(prefix(data), start, end), return_index=True, return_inverse=True)
        known = _holds(self.keys, keys)
        if len(self.keys) + (~known).sum() > self.room:
            self._forget()
            known[:] = False
        new = np.flatnonzero(~known)
        if len(new):
            whole = data.tobytes()
            # The library adds the stretch's first space itself.
            self._learn(keys[new], [whole[start[k] + 1 : end[k]].decode("utf-8", "replace") for k in first[new]])
        place = np.searchsorted(self.keys, keys)[which]
        lengths = self.lengths[place]
        sums = np.concatenate(([0], np.cumsum(lengths)))
        return self.pool[ragged(self.starts[place], lengths)], sums[np.searchsorted(start, offsets)]


def pieces(path: str) -> Pieces:
    """The worker's reader of a sentence-piece model."""
    if path not in _open:
        _open[path] = Pieces(path)
    return _open[path]


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that are not empty with a space before each; offsets of all rows, empty ones staying empty."""
    lengths = np.diff(offsets)
    longer = lengths + (lengths > 0)
    places = np.concatenate(([0], np.cumsum(longer)))
    out = np.full(places[-1], _SPACE, np.uint8)
    full = lengths > 0
    out[ragged(places[:-1][full] + 1, lengths[full])] = data
    return out, places


def _same(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, places: np.ndarray, spelling: Spelling) -> np.ndarray:
    """Which rows the tokens spell exactly."""
    sums = np.concatenate(([0], np.cumsum(spelling.lengths[ids])))
    fits = sums[places[1:]] - sums[places[:-1]] == np.diff(offsets)
    spelt = spelling.bytes_of(ids)
    for row in np.flatnonzero(~fits):  # rare: cut or fill, so that the others can be compared in one go
        ids, places = _without(ids, places, row)
    if not fits.all():
        spelt = spelling.bytes_of(ids)
    keep = np.repeat(fits, np.diff(offsets))
    differs = np.zeros(len(data) + 1, np.int64)
    wrong = np.zeros(len(data), bool)
    wrong[keep] = spelt != data[keep]
    np.cumsum(wrong, out=differs[1:])
    return fits & (differs[offsets[1:]] == differs[offsets[:-1]])


def _without(ids: np.ndarray, places: np.ndarray, row: int) -> tuple[np.ndarray, np.ndarray]:
    s, e = places[row], places[row + 1]
    shorter = places.copy()
    shorter[row + 1 :] -= e - s
    return np.delete(ids, np.s_[s:e]), shorter


def _rows_kept(ids: np.ndarray, places: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the good rows; the others become empty."""
    lengths = np.diff(places)
    kept = ids[np.repeat(good, lengths)]
    return kept, np.concatenate(([0], np.cumsum(lengths * good)))


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_lane: np.ndarray, b_lane: np.ndarray) -> tuple[np.ndarray, ...]:
    """Groups of all lanes: first A token, A tokens, first B token, B tokens, in order of the text.

    ``a_end`` and ``b_end`` are the tokens' end offsets, ``a_lane`` and ``b_lane`` each lane's first token and, last, the number of
    tokens; both sides of a lane end at the same offset.
    """
    live = np.flatnonzero(np.diff(a_lane) > 0)
    a, b, a_stop = a_lane[live].copy(), b_lane[live].copy(), a_lane[live + 1]
    a_open, b_open = a.copy(), b.copy()
    found: list[tuple[np.ndarray, ...]] = []
    while len(a):
        x, y = a_end[a], b_end[b]
        a += x <= y
        b += y <= x
        cut = x == y
        if cut.any():
            found.append((a_open[cut], a[cut] - a_open[cut], b_open[cut], b[cut] - b_open[cut]))
            a_open[cut], b_open[cut] = a[cut], b[cut]
            done = a >= a_stop
            if done.any():
                left = ~done
                a, b, a_stop, a_open, b_open = a[left], b[left], a_stop[left], a_open[left], b_open[left]
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    columns = [np.concatenate(c) for c in zip(*found)]
    order = np.argsort(columns[0])
    return tuple(c[order] for c in columns)


class Alignment:
    """Ids, groups and links of a run of rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, a_path: str, b_path: str) -> None:
        data, offsets = spaced(data, offsets)
        rows = len(offsets) - 1
        reader, other = encoder(a_path), pieces(b_path)
        found = [(ids, places) for _, ids, places in reader.encode(data, offsets)]
        a_ids = np.concatenate([ids for ids, _ in found]) if found else np.zeros(0, np.uint16)
        a_at = np.zeros(1, np.int64)
        for _, places in found:
            a_at = np.concatenate((a_at, places[1:] + a_at[-1]))
        b_ids, b_at = other.encode(data, offsets) if len(data) else (np.zeros(0, np.uint16), np.zeros(rows + 1, np.int64))
        a_spelt = byte_level_spelling(a_path)
        good = (np.diff(offsets) > 0) & _same(data, offsets, a_ids, a_at, a_spelt) & _same(data, offsets, b_ids, b_at, other.spelling)
        self.a_ids, self.a_at = _rows_kept(a_ids, a_at, good)
        self.b_ids, self.b_at = _rows_kept(b_ids, b_at, good)
        size = np.diff(offsets) * good
        self.starts = np.concatenate(([0], np.cumsum(size)))  # of the good rows' bytes
        a_end, b_end = np.cumsum(a_spelt.lengths[self.a_ids]), np.cumsum(other.spelling.lengths[self.b_ids])
        lanes = self._lanes(data[np.repeat(good, np.diff(offsets))], a_end, b_end)
        a_lane, b_lane = np.searchsorted(a_end, lanes, "right"), np.searchsorted(b_end, lanes, "right")
        self.a_first, self.p, self.b_first, self.q = lockstep(a_end, b_end, a_lane, b_lane)
        self.cut = a_end[self.a_first + self.p - 1] if len(self.p) else np.zeros(0, np.int64)
        self.row = np.searchsorted(self.starts, self.cut, "left") - 1  # the row whose bytes the group covers
        self.rows = rows

    def _lanes(self, data: np.ndarray, a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
        """Where lanes start, and the end: rows, and in long rows about every ``LANE_BYTES`` a space where both have a cut."""
        edges = np.unique(self.starts)
        if len(data) < 3:
            return edges
        open_ = np.flatnonzero((data[1:-1] == _SPACE) & (data[:-2] != _SPACE) & _PLAIN[data[2:]]) + 1
        open_ = open_[_holds(a_end, open_) & _holds(b_end, open_)]
        step = open_ // LANE_BYTES
        return np.union1d(edges, open_[np.flatnonzero(np.diff(step, prepend=-1))])

    def per_row(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, values, minlength=self.rows).astype(np.int64) if len(values) else np.zeros(self.rows, np.int64)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, pair and how often the row links it, by row and pair; pair is A's id and B's id in one number."""
        rows, pairs, times = [], [], []
        size = np.cumsum(self.p * self.q)
        at = 0
        while at < len(size):  # blocks of groups, so that working arrays stay small; a larger group is a block of its own
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + (1 << 21), "right")))
            p, q = self.p[at:to], self.q[at:to]
            a = np.repeat(ragged(self.a_first[at:to], p), np.repeat(q, p))
            b = ragged(np.repeat(self.b_first[at:to], p), np.repeat(q, p))
            pair = (self.a_ids[a].astype(np.int64) << PAIR_BITS) | self.b_ids[b]
            whole, n = np.unique((np.repeat(self.row[at:to], p * q) << 2 * PAIR_BITS) | pair, return_counts=True)
            rows.append(whole >> 2 * PAIR_BITS)
            pairs.append(whole & ((1 << 2 * PAIR_BITS) - 1))
            times.append(n)
            at = to
        if not rows:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        row, pair, n = (np.concatenate(c) for c in (rows, pairs, times))
        if len(rows) > 1:
            whole, which = np.unique((row << 2 * PAIR_BITS) | pair, return_inverse=True)
            row, pair, n = whole >> 2 * PAIR_BITS, whole & ((1 << 2 * PAIR_BITS) - 1), np.bincount(which, n).astype(np.int64)
        return row, pair, n

    def spelt_groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every row."""
        both = self.p + self.q
        before = np.cumsum(both) - both
        ids = np.zeros(int(both.sum()), np.int64)
        mark = np.full(len(ids), ord(","), np.uint8)
        ids[ragged(before, self.p)] = self.a_ids[ragged(self.a_first, self.p)]
        ids[ragged(before + self.p, self.q)] = self.b_ids[ragged(self.b_first, self.q)]
        mark[before + self.p - 1] = ord("|")
        mark[before + both - 1] = ord(";")
        shown = np.zeros((len(ids), 6), np.uint8)
        rest = ids
        for column in range(4, -1, -1):
            shown[:, column] = np.where((rest > 0) | (column == 4), rest % 10 + ord("0"), 0)
            rest = rest // 10
        shown[:, 5] = mark
        length = np.concatenate(([0], np.cumsum((shown > 0).sum(1))))
        flat = shown.ravel()
        flat = flat[flat > 0].tobytes()
        tokens = np.concatenate(([0], np.cumsum(self.per_row(both))))
        return [flat[s : e - 1] if e > s else b"" for s, e in zip(length[tokens[:-1]], length[tokens[1:]])]


def _aligned(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[tuple[pa.Array, Alignment]]:
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        for s, e in runs_of_rows(offsets):
            yield batch.column("key").slice(s, e - s), Alignment(data[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s], a_path, b_path)


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(np.int32)))


def groups(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, a_ids, b_ids, a_sizes, b_sizes, cuts): ids, tokens of each group and its end byte in space + text."""
    kind = docs.schema[key].dataType.simpleString()
    names = ["key", "a_ids", "b_ids", "a_sizes", "b_sizes", "cuts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, found in _aligned(batches, a_path, b_path):
            at = np.concatenate(([0], np.cumsum(np.bincount(found.row, minlength=found.rows))))
            sides = [_lists(found.a_ids, found.a_at), _lists(found.b_ids, found.b_at), _lists(found.p, at), _lists(found.q, at)]
            yield pa.RecordBatch.from_arrays([own, *sides, _lists(found.cut - found.starts[found.row], at)], names)

    schema = f"key {kind}, " + ", ".join(f"{c} array<int>" for c in names[1:])
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


def agreement(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_text_sha256): how far the tokenizers agree on each document.

    A pair's count is the number of documents that link it; ``n_best`` counts the links whose pair has the highest count of its A id,
    ``count_sum`` adds the counts over the links.
    """
    kind = docs.schema[key].dataType.simpleString()
    figures = ["n_a", "n_b", "n_groups", "n_links"]
    names = ["key", *figures, "sha256", "pairs", "docs", "link_at", "link_pair", "link_times"]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, found in _aligned(batches, a_path, b_path):
            row, pair, times = found.links()
            different, which, docs_ = np.unique(pair, return_inverse=True, return_counts=True)
            numbers = [np.diff(found.a_at), np.diff(found.b_at), found.per_row(np.ones(len(found.row))), found.per_row(found.p * found.q)]
            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in found.spelt_groups()]
            at = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=found.rows)))) if found.rows else np.zeros(1, np.int64)
            lists = [[n.tolist()] for n in numbers]
            kept = [[x.tobytes()] for x in (at.astype("<i8"), which.astype("<u4"), times.astype("<u4"))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([own.to_pylist()], pa.list_(own.type)),
                    *[pa.array(x, pa.list_(pa.int64())) for x in lists],
                    pa.array([digests], pa.list_(pa.string())),
                    pa.array([different], pa.list_(pa.int64())),
                    pa.array([docs_.astype(np.int64)], pa.list_(pa.int64())),
                    *[pa.array(x, pa.binary()) for x in kept],
                ],
                names,
            )

    schema = f"key array<{kind}>, " + ", ".join(f"{c} array<bigint>" for c in figures)
    schema += ", sha256 array<string>, pairs array<bigint>, docs array<bigint>, link_at binary, link_pair binary, link_times binary"
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    batches = stored(slim.mapInArrow(first, schema).withColumn("batch", F.monotonically_increasing_id()), "aligned")

    zipped = F.arrays_zip("pairs", "docs")
    seen = batches.select("batch", F.posexplode(zipped).alias("at", "z")).select("batch", "at", F.col("z.pairs").alias("pair"), F.col("z.docs").alias("docs"))
    counts = stored(seen.groupBy("pair").agg(F.sum("docs").alias("count")), "pair-counts")
    a_id = F.shiftright("pair", PAIR_BITS)
    highest = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("most"))
    judged = counts.join(highest, a_id == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = seen.drop("docs").join(judged, "pair").groupBy("batch")
    back = back.agg(F.array_sort(F.collect_list(F.struct("at", "count", "best"))).alias("known"))
    back = back.select("batch", F.col("known.count").alias("counts"), F.col("known.best").alias("best"))

    def second(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            for k in range(batch.num_rows):
                cell = {c: batch.column(c)[k] for c in batch.schema.names}
                at, pair, times = (np.frombuffer(cell[c].as_buffer(), t) for c, t in (("link_at", "<i8"), ("link_pair", "<u4"), ("link_times", "<u4")))
                listed = cell["counts"].values
                count = np.asarray(listed, np.int64) if listed is not None else np.zeros(0, np.int64)
                best = np.asarray(cell["best"].values.cast(pa.int64())) if listed is not None else np.zeros(0, np.int64)
                sums = [np.concatenate(([0], np.cumsum(times.astype(np.int64) * of[pair]))) for of in (best, count)]
                more = [pa.array(s[at[1:]] - s[at[:-1]]) for s in sums]
                yield pa.RecordBatch.from_arrays([cell["key"].values, *[cell[c].values for c in figures], *more, cell["sha256"].values], result)

    result = ["key", *figures, "n_best", "count_sum", "groups_sha256"]
    schema = f"key {kind}, " + ", ".join(f"{c} bigint" for c in result[1:-1]) + ", groups_sha256 string"
    whole = batches.drop("pairs", "docs").join(back, "batch", "left")
    return whole.mapInArrow(second, schema).withColumnRenamed("key", key)
