"""Links between texts that share a bucket: a star round, then tiles of bounded size.

A first round compares each bucket's members with its best connected member. What is still apart in
a bucket is compared in tiles of bounded size, first in one bucket for each key and then in all buckets that still
hold two components, by 256-fold MinHash bytes: every pair in two components whose estimate is within three standard errors of the threshold or above is a candidate. Texts of
at most 1024 k-mers bring them along, so a tile compares such candidates itself and returns only pairs
that join what it has not joined yet; candidates with a longer text are all returned. Every returned pair is verified from its
texts. The tiles of one slice of a bucket come first, and tiles of two slices know what each has joined in itself. So no pair list grows
with a group's square once its members hang together, and no candidate is dropped for the size of its bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.buffers import groups, mix, occurrence, shingles, text_buffer, words
from silverlode.llm.frames import stored
from silverlode.llm.links import components, runs, starts

WORDS, SIMILARITY = 5, 0.8
BYTES = 256
SHORT = 1024
ERRORS = 3.0
TILE = 256
_MORE = np.random.default_rng(78).integers(1, 1 << 63, (2, BYTES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
Similarity = Callable[[np.ndarray, np.ndarray, float], float]


def kmers(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Labelled k-mers of every row in order of the text, and where each row's begin."""
    hashed, _, _, row = words(data, offsets)
    grams, _, owner = shingles(hashed, row, len(offsets) - 1, size)
    label = occurrence(owner, grams).astype(np.uint64)
    return mix(grams + label * _GOLDEN), np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(offsets) - 1))))


def verified(pairs: DataFrame, texts: DataFrame, similarity: Similarity, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = (text_buffer(batch.column(c)) for c in ("text_a", "text_b"))
            keep = []
            for i, j in groups(own[1] + other[1]):
                (left, cuts), (right, ends) = (kmers(d[o[i] : o[j]], o[i : j + 1] - o[i]) for d, o in (own, other))
                keep += [
                    i + k
                    for k in range(j - i)
                    if similarity(left[cuts[k] : cuts[k + 1]], right[ends[k] : ends[k + 1]], least) >= least
                ]
            chosen = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(chosen), batch.column("b").take(chosen)], ["a", "b"])

    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def _signed(texts: DataFrame) -> DataFrame:
    """(key, signature, grams): one byte of each of 256 minima, and the k-mers (32 bits of each, in order) of a text with at most ``SHORT`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j in groups(offsets):
                grams, begins = kmers(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                found = np.zeros((j - i, BYTES), np.uint8)
                some = np.flatnonzero(np.diff(begins))
                if len(some):
                    for k, (seed, factor) in enumerate(_MORE.T):
                        found[some, k] = np.minimum.reduceat((grams ^ seed) * factor, begins[some]) & np.uint64(255)
                low = grams.astype(np.uint32)
                short = [low[a:b].tobytes() if b - a <= SHORT else None for a, b in zip(begins[:-1], begins[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([f.tobytes() for f in found], pa.binary()), pa.array(short, pa.binary())],
                    ["key", "signature", "grams"],
                )

    return texts.select("key", "text").mapInArrow(run, "key bigint, signature binary, grams binary")


def _tiles(rows: DataFrame, similarity: Similarity, least: float) -> DataFrame:
    """Pairs (a, b) of one tile in two components that are to be verified, and (bucket, a, label): its rows' components as the tile joined them.

    A tile of two slices compares the one with the other only.
    """
    cut = int(np.floor(BYTES * (least - ERRORS * np.sqrt(least * (1 - least) / BYTES))))
    keys = ["bucket", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, keys):
            edge = starts(table, keys)
            node, group, slice_, i, j = (np.array(table.column(c)) for c in ("key", "component", "slice", "i", "j"))
            group = group.copy()
            signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, BYTES)
            texts = table.column("grams").to_pylist()
            left, right, places = [], [], []
            for s, e in zip(edge[:-1], edge[1:]):
                joined = group[s:e]  # components as far as this tile has joined them

                own = np.arange(s, e)[slice_[s:e] == i[s]]
                within = i[s] == j[s]
                other = own if within else np.arange(s, e)[slice_[s:e] == j[s]]
                for x in own:
                    rest = other[(joined[other - s] != joined[x - s]) & ((node[other] > node[x]) | ~within)]
                    if not len(rest):
                        continue
                    for y in rest[(signs[rest] == signs[x]).sum(1) >= cut]:
                        if joined[y - s] == joined[x - s]:
                            continue
                        if texts[x] is not None and texts[y] is not None:
                            a, b = (np.frombuffer(texts[k], np.uint32) for k in (x, y))
                            if similarity(a, b, least) < least:
                                continue
                            joined[joined == joined[y - s]] = joined[x - s]
                        left.append(node[x])
                        right.append(node[y])
                if within:
                    places.append(own)
            a, b = np.array(left, np.int64), np.array(right, np.int64)
            at = np.concatenate(places) if places else np.zeros(0, np.int64)
            none = np.zeros(len(a), np.int64)
            columns = [
                np.concatenate((np.minimum(a, b), node[at])),
                np.concatenate((np.maximum(a, b), group[at])),
                np.concatenate((none, np.array(table.column("bucket"))[at])),
                np.concatenate((none.astype(bool), np.ones(len(at), bool))),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "bucket", "labelled"])

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a bigint, b bigint, bucket bigint, labelled boolean")


def _live(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that still hold two components, with their component."""
    placed = members.join(found.withColumnRenamed("node", "key"), "key", "left")
    return _open(placed.select("bucket", "key", F.coalesce("component", "key").alias("component")))


def _open(placed: DataFrame) -> DataFrame:
    open_ = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"))
    return placed.join(open_.where("x <> y").select("bucket", "n"), "bucket")


def near_links(
    members: DataFrame, texts: Callable[[DataFrame], DataFrame], similarity: Similarity, least: float
) -> DataFrame:
    """Links (a, b) that hold together the components of keys sharing a bucket and alike by ``similarity``.

    ``members`` is (bucket, key); ``texts`` returns (key, text) for a frame of keys.
    """
    members = stored(members.dropDuplicates(["bucket", "key"]), "sketches")
    several = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(members.join(several, "bucket"), "buckets", (members,))
    degree = members.groupBy("key").agg(F.sum(F.col("n") - 1).alias("degree"))
    candidates = stored(texts(degree.select("key")), "candidates")
    best = members.join(degree, "key").groupBy("bucket").agg(F.max(F.struct("degree", "key")).alias("best"))
    star = members.join(best.select("bucket", F.col("best.key").alias("lead")), "bucket").where("key <> lead")
    pairs = star.select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b")).distinct()
    links = stored(verified(pairs, candidates, similarity, least), "links")
    buckets, members = members, members.select("bucket", "key")
    joined = components(links)
    live = stored(_live(members, joined), "live", (joined,))
    # One bucket a key first: its neighbours are mostly the same in all of its buckets.
    own = live.groupBy("key").agg(F.max(F.struct("n", "bucket", "component")).alias("own")).select("own.bucket", "key", "own.component")
    own = stored(_open(own), "own", (live,))
    first = _compared(own, candidates, similarity, least)
    links = stored(links.union(first), "links", (links, first, own))
    joined = components(links)
    live = stored(_live(members, joined), "live", (joined, buckets))
    last = _compared(live, candidates, similarity, least)
    return stored(links.union(last), "links", (links, last, live, candidates))


def _compared(live: DataFrame, candidates: DataFrame, similarity: Similarity, least: float) -> DataFrame:
    """Verified links between components that share a bucket of ``live`` (bucket, key, component, n)."""
    signed = _signed(candidates.join(live.select("key").distinct(), "key", "left_semi"))
    slices = F.ceil(F.col("n") / TILE).cast("int")
    sliced = live.join(signed, "key").withColumn("slices", slices).withColumn("slice", F.pmod(F.xxhash64("key"), "slices").cast("int"))
    sliced = stored(sliced, "sliced")
    columns = ("bucket", "i", "j", "slice", "key", "component", "signature", "grams")
    alone = sliced.withColumns({"i": F.col("slice"), "j": F.col("slice")}).select(*columns)
    found = stored(_tiles(alone, similarity, least), "pairs")
    # Slices of one bucket meet with what each has joined in itself, so that a large group is not joined again in every tile.
    labels = found.where("labelled").select("bucket", F.col("a").alias("key"), F.col("b").alias("component"))
    tiled = sliced.where("slices > 1").drop("component").join(labels, ["bucket", "key"])
    tiled = tiled.select("*", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("with")).where("slice <> with")
    tiled = tiled.withColumns({"i": F.least("slice", "with"), "j": F.greatest("slice", "with")})
    across = stored(_tiles(tiled.select(*columns), similarity, least), "pairs")
    more = found.union(across).where("NOT labelled").select("a", "b").distinct()
    return stored(verified(more, candidates, similarity, least), "links", (found, across, sliced))
