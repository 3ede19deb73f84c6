"""Best-fit packing of token sequences with Martello-Toth dominance reduction.

Lengths are whole numbers up to the capacity, so the bin-packing instance is a histogram of at
most ``capacity`` counts whatever the number of documents. The driver solves that histogram:
first the reduction procedure of Martello and Toth fixes sets of one, two or three lengths that
dominate every other set holding their largest member, all equal sets at once; best-fit
decreasing then packs what is left, again by counts. The plan is a list of segments (length,
ranks, sequences, place), whose number is bounded by the capacity; Spark ranks the pieces of each
length (in salted groups, so a common length is no single task) and looks each one up.

Cases: null text is empty, so it is the end id alone; repeated rows and null keys are pieces of
their own; an empty input gives an empty result; other columns are not carried by ``pieces``
and all are carried by ``pack``.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.buffers import text_buffer
from silverlode.llm.frames import free_name, stored
from silverlode.llm.tokens import encoder

SALTS = 64
_RANKS = 1 << 48
Pattern = tuple[tuple[int, int], ...]


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids): token pieces of at most ``capacity``, ids as little-endian uint32."""
    names = ["doc_id", "piece", "start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        end = np.array([end_id], "<u4")
        for batch in batches:
            keys = batch.column(0)
            data, offsets = text_buffer(batch.column(1))
            for first, ids, places in tool.encode(data, offsets):
                own, piece, start, value = [], [], [], []
                for k, (a, b) in enumerate(zip(places[:-1], places[1:])):
                    whole = np.concatenate((ids[a:b].astype("<u4"), end))
                    for at in range(0, len(whole), capacity):
                        own.append(first + k)
                        piece.append(at // capacity)
                        start.append(at)
                        value.append(whole[at : at + capacity].tobytes())
                length = [len(v) // 4 for v in value]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(own)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(value, pa.binary()),
                    ],
                    names,
                )

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids binary"
    )


class _Left:
    """Counts by length, descending."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.n = dict(counts)
        self.sizes = sorted(k for k, v in counts.items() if v)  # ascending

    def take(self, chosen: Pattern, times: int) -> None:
        for size, each in chosen:
            self.n[size] -= each * times
            if not self.n[size]:
                self.sizes.pop(bisect_left(self.sizes, size))

    def without(self, size: int) -> list[int]:
        """Lengths still there beside one item of ``size``."""
        if self.n[size] > 1:
            return self.sizes
        return [s for s in self.sizes if s != size]

    def count(self, size: int, held: int) -> int:
        return self.n[size] - (size == held)


def _most_that_fit(left: _Left, others: list[int], held: int, room: int) -> int:
    """How many of the smallest others fit into ``room``, at most 3."""
    fit = 0
    for size in others:
        for _ in range(min(3, left.count(size, held))):
            room -= size
            if room < 0 or fit == 3:
                return fit
            fit += 1
    return fit


def _dominating(left: _Left, size: int, capacity: int) -> tuple[int, ...] | None:
    """The set with one item of ``size`` that dominates every other such set, if the rules find one."""
    room = capacity - size
    others = left.without(size)
    if not others or others[0] > room:
        return (size,)
    best = others[bisect_left(others, room + 1) - 1]
    most = _most_that_fit(left, others, size, room)
    if most == 1 or best == room:
        return (size, best)
    if most > 2:
        return None
    small = np.array(others)
    small = small[small < room]
    partner = np.searchsorted(small, room - small, "right") - 1
    ok = partner >= 0
    same = ok & (partner == np.arange(len(small)))
    lonely = same & np.array([left.count(int(s), size) < 2 for s in small])
    partner = np.where(lonely, partner - 1, partner)
    ok = partner >= 0
    if not ok.any():
        return (size, best)
    total = np.where(ok, small + small[np.maximum(partner, 0)], -1)
    k = int(total.argmax())
    a, b = max(int(small[k]), int(small[partner[k]])), min(int(small[k]), int(small[partner[k]]))
    if best >= a + b:
        return (size, best)
    if best != a:
        return None
    between = [s for s in others if b < s < a]
    number = sum(min(2, left.count(s, size)) for s in between[:2])
    if number <= 1:
        return (size, a, b)
    first = between[0]
    second = first if left.count(first, size) > 1 else between[1]
    return (size, a, b) if first + second > room else None


def reduced(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """Sequences fixed by dominance, and the counts they leave."""
    left, fixed = _Left(counts), []
    for size in sorted(counts, reverse=True):
        while left.n.get(size):
            chosen = _dominating(left, size, capacity)
            if chosen is None:
                break
            pattern = tuple((s, chosen.count(s)) for s in dict.fromkeys(chosen))
            times = min(left.n[s] // each for s, each in pattern)
            fixed.append((pattern, times))
            left.take(pattern, times)
    return fixed, {s: left.n[s] for s in left.sizes}


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing by counts: sequences with the same content are one entry."""
    rooms: list[int] = []
    open_bins: dict[int, list[tuple[Pattern, int]]] = {}
    closed: list[tuple[Pattern, int]] = []

    def put(pattern: Pattern, times: int, room: int) -> None:
        if not room:
            closed.append((pattern, times))
            return
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append((pattern, times))

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                pattern, times = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
            else:
                room, pattern, times = capacity, (), n
            each = room // size
            full = min(times, n // each)
            if full:
                put((*pattern, (size, each)), full, room - each * size)
                n -= full * each
                times -= full
            if n and times:  # the last items fill one more sequence in part
                put((*pattern, (size, n)), 1, room - n * size)
                n, times = 0, times - 1
            if times and pattern:
                put(pattern, times, room)
    return closed + [entry for room in rooms for entry in open_bins[room]]


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Segments, one a row: length, first rank, items, first sequence, items a sequence, offset there."""
    fixed, rest = reduced(counts, capacity)
    ranks = dict.fromkeys(counts, 0)
    segments, sequence = [], 0
    for pattern, times in fixed + best_fit(rest, capacity):
        offset = 0
        for size, each in pattern:
            segments.append((size, ranks[size], times * each, sequence, each, offset))
            ranks[size] += times * each
            offset += size * each
        sequence += times
    return np.array(sorted(segments), np.int64).reshape(-1, 6)


def pack(frame: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """``frame`` with sequence_id and offset (underscores added where a column has the name); lengths must lie between 1 and ``capacity``."""
    spark = frame.sparkSession
    kept = stored(frame, "pieces")
    counts = {r["n"]: r["c"] for r in kept.groupBy(F.col(length).alias("n")).agg(F.count("*").alias("c")).collect()}
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError("every length must lie between 1 and the capacity")
    shared = spark.sparkContext.broadcast(plan(counts, capacity))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        segments = shared.value
        at = np.searchsorted(segments[:, 0] * _RANKS + segments[:, 1], size.to_numpy().astype(np.int64) * _RANKS + rank.to_numpy(), "right") - 1
        _, first, _, sequence, each, offset = segments[at].T
        beyond = rank.to_numpy() - first
        return pd.DataFrame({"sequence_id": sequence + beyond // each, "offset": offset + beyond % each * size.to_numpy()})

    row = [F.col(f"`{c}`") for c in frame.columns]
    salt = F.pmod(F.xxhash64(*row), F.lit(SALTS)).cast("int")
    salted = kept.select(F.struct(*row).alias("_row"), F.col(length).alias("_length"), salt.alias("_salt"))
    group = Window.partitionBy("_length", "_salt")
    ranked = salted.withColumn("_rank", F.row_number().over(group.orderBy(F.xxhash64("_row"), F.hash("_row"))))
    sizes = salted.groupBy("_length", "_salt").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_length", "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    joined = ranked.join(bases, ["_length", "_salt"])
    found = joined.select("_row", place(F.col("_length"), F.col("_base") + F.col("_rank") - 1).alias("_place"))
    return found.select("_row.*", *[F.col(f"_place.{c}").alias(free_name(c, frame.columns)) for c in ("sequence_id", "offset")])


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096) -> DataFrame:
    """Pieces of whole documents with their digest, sequence and offset; ``pieces`` has the ids themselves."""
    cut = pieces(docs, tokenizer, end_id, capacity)
    return pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)
