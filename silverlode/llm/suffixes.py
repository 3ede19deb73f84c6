"""Exact removal of repeated byte strings by a depth-limited radix sort of suffixes.

Two windows of ``length`` bytes are equal exactly if they agree digit by digit, so suffixes
need ordering only through that depth. The passes take the most significant digits first, as
groups of equal fingerprints that Spark forms by its shuffle:

1. A sampled suffix stands for the run of up to ``length // 2 + 1`` windows whose least
   fingerprint of ``length // 2`` bytes it is (equal windows choose equal samples). Its first
   digit is those bytes, which all its windows share: a group of one holds no repeat.
2. Groups are parted by the rest of the bytes their windows cover. A group of two or more has
   all its windows repeated; what differs is cut into runs of 16 windows and, with the bytes
   common to a run as first digit and all its bytes as second, passes again; then into single
   windows, where equal groups are exactly the repeated windows.

Fingerprints are 64 bits of a polynomial hash, two of them to a group. Only fingerprints, places
and the texts of documents with repeats are shuffled; groups are counted by partial aggregation
and never held as lists, so a passage in a third of all documents costs as any other.

Cases: null text is empty; texts shorter than ``length`` keep everything; rows with equal texts
are repeats of one another even under one doc_id; null doc_ids are rows like others; an empty
input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.buffers import groups, mix, prefix, ragged, slices, text_buffer
from silverlode.llm.frames import stored

SCAN_BYTES = 1 << 19
RUN = 16
_PLACE = np.uint64(32)  # a text has at most 2^31 bytes
_NODES = "digit bigint, rest bigint, key bigint, anchor int, first int, last int"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` values."""
    n = len(values) - width + 1
    padded = -(-len(values) // width) * width
    v = np.full(padded, np.iinfo(np.uint64).max, np.uint64)
    v[: len(values)] = values
    blocks = v.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def samples(data: np.ndarray, offsets: np.ndarray, length: int):
    """Prefix sums for hashing, then row, place, first and last window of each sampled suffix."""
    half = length // 2
    sums = prefix(data)
    n = len(data) - length + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return sums, empty, empty, empty, empty
    at = np.arange(len(data) - half + 1)
    hashed = slices(sums, at, at + half)
    ranked = (hashed >> _PLACE << _PLACE) | at.astype(np.uint64)
    chosen = (sliding_min(ranked, length - half + 1) & np.uint64((1 << 32) - 1)).astype(np.int64)
    start = np.arange(n)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    inside = start + length <= offsets[row + 1]
    start, row, chosen = start[inside], row[inside], chosen[inside]
    if not len(start):
        return sums, empty, empty, empty, empty
    new = np.ones(len(start), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return sums, row[first], chosen[first], start[first], start[last]


def _batch(digit, rest, key, anchor, first, last) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(digit.view(np.int64)),
            pa.array(rest.view(np.int64)),
            pa.array(key, pa.int64()),
            pa.array(anchor.astype(np.int32)),
            pa.array(first.astype(np.int32)),
            pa.array(last.astype(np.int32)),
        ],
        ["digit", "rest", "key", "anchor", "first", "last"],
    )


def _rest(sums, anchor, first, last, length) -> np.ndarray:
    """Fingerprint of all bytes that the windows cover, and where they lie about the sample."""
    return mix(slices(sums, first, last + length) + (anchor - first).astype(np.uint64))


def sampled(texts: DataFrame, length: int) -> DataFrame:
    """First nodes: the sampled suffixes of (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array(batch.column(0))
            data, offsets = text_buffer(batch.column(1))
            for i, j in groups(offsets, SCAN_BYTES):
                own = offsets[i : j + 1] - offsets[i]
                sums, row, anchor, first, last = samples(data[offsets[i] : offsets[j]], own, length)
                digit = slices(sums, anchor, anchor + length // 2)
                base = own[row]
                yield _batch(digit, _rest(sums, anchor, first, last, length), keys[i:j][row], anchor - base, first - base, last - base)

    return texts.select("key", "text").mapInArrow(run, _NODES)


def _children(sources: DataFrame, length: int, width: int) -> DataFrame:
    """Nodes cut into runs of ``width`` windows by their distance from the sample; needs the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            keys = np.array(batch.column("key"))
            nodes = batch.column("nodes").to_pylist()
            for k, own in enumerate(nodes):
                sums = prefix(data[offsets[k] : offsets[k + 1]])
                anchor, first, last = (np.array([n[c] for n in own], np.int64) for c in ("anchor", "first", "last"))
                near, far = (anchor - last) // width, (anchor - first) // width
                number = far - near + 1
                block = ragged(near, number)
                anchor, first, last = (np.repeat(v, number) for v in (anchor, first, last))
                low, high = anchor - block * width - width + 1, anchor - block * width
                # Bytes that every window of the whole run shares, wherever this node ends.
                common = slices(sums, high, low + length)
                digit = mix(common + block.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                first, last = np.maximum(first, low), np.minimum(last, high)
                yield _batch(digit, _rest(sums, anchor, first, last, length), np.full(len(block), keys[k]), anchor, first, last)

    return sources.mapInArrow(run, _NODES)


def _sorted(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One pass: (key, first, last) whose windows are all repeated, and the nodes to cut further.

    The second holds one node for every different content of a digit that has several.
    """
    place = F.struct("key", "anchor", "first", "last")
    digits = nodes.groupBy("digit").agg(F.min(F.xxhash64("key", "anchor")).alias("lo"), F.max(F.xxhash64("key", "anchor")).alias("hi"))
    # Written first, so that Spark can split the partition of a common digit when it joins.
    several = stored(digits.where("lo <> hi").select("digit"), "digits")
    repeated = stored(nodes.join(several, "digit", "left_semi"), "repeated")
    contents = repeated.groupBy("digit", "rest").agg(F.min(place).alias("one"), F.max(place).alias("other"))
    contents = stored(contents, "contents")
    equal = contents.where("one <> other").select("digit", "rest")
    found = repeated.join(equal, ["digit", "rest"], "left_semi").select("key", "first", "last")
    mixed = stored(contents.groupBy("digit").agg(F.count("*").alias("n")).where("n > 1").select("digit"), "mixed")
    return found, contents.join(mixed, "digit", "left_semi").select("one.*")


def spans(first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by the windows first..last."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate(last[order] + length)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    at = np.flatnonzero(new)
    return start[at], end[np.append(at[1:], len(start)) - 1]


def _cut(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            runs, kept = [], []
            for k, windows in enumerate(batch.column("windows").to_pylist()):
                own = data[offsets[k] : offsets[k + 1]]
                first, last = (np.array([w[c] for w in windows], np.int64) for c in ("first", "last"))
                start, end = spans(first, last, length)
                keep = np.ones(len(own), bool)
                keep[ragged(start, end - start)] = False
                runs.append([{"start": int(a), "end": int(b)} for a, b in zip(start, end)])
                kept.append(own[keep].tobytes())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(runs, kind), pa.array(kept, pa.binary())], ["key", "spans", "kept"])

    return texts.mapInArrow(run, "key bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, key, check, n_bytes): ``key`` and ``check`` together are 128 bits that stand for the text."""
    value = F.coalesce(F.col(text), F.lit(""))
    size = F.octet_length(value).cast("bigint")
    return docs.select(F.col(doc_id).alias("doc_id"), value.alias("text")).select(
        "doc_id",
        "text",
        F.xxhash64("text").alias("key"),
        (F.shiftleft(F.crc32(F.col("text").cast("binary")), 32) + size).alias("check"),
        size.alias("n_bytes"),
    )


def remove_repeats(
    docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text", extra: dict[str, Column] | None = None
) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for every row: the removed runs of bytes, and the bytes left.

    ``kept`` is null where nothing was removed, so that untouched texts are not moved; ``extra``
    adds columns computed from the row's ``text``.
    """
    rows = keyed(docs, doc_id, text)
    long = rows.where(F.col("n_bytes") >= length)
    nodes = stored(sampled(long, length), "samples")
    found, rest = _sorted(nodes)
    classes = rows.groupBy("key", "check").agg(F.count("*").alias("copies"), F.min("doc_id").alias("chosen"))
    classes = stored(classes, "classes")
    # The text of one row for each different text that has a repeat.
    wanted = found.select("key").union(rest.select("key")).distinct()
    chosen = classes.join(wanted, "key").select("key", "check", "chosen")
    same = [rows["key"] == chosen["key"], rows["check"] == chosen["check"], rows["doc_id"].eqNullSafe(chosen["chosen"])]
    texts = stored(rows.join(chosen, same, "left_semi").select("key", "text"), "texts")
    repeats = [found]
    for width in (RUN, 1):
        own = rest.groupBy("key").agg(F.collect_list(F.struct("anchor", "first", "last")).alias("nodes"))
        children = stored(_children(texts.join(own, "key"), length, width), f"runs-{width}")
        found, rest = _sorted(children)
        repeats.append(found)
    windows = repeats[0]
    for more in repeats[1:]:
        windows = windows.union(more)
    windows = windows.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("windows"))
    cut = _cut(texts.join(windows, "key"), length).dropDuplicates(["key"])
    extra = extra or {}
    joined = rows.withColumns(extra).drop("text").join(classes.drop("chosen"), ["key", "check"]).join(cut, "key", "left")
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("end")))
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(copied, everything).otherwise(F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>"))).alias("spans"),
        F.when(copied, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        *extra,
    )
