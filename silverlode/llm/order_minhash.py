"""Near-duplicate documents by order MinHash, verified by banded alignment.

A k-mer is five words in a row (case and punctuation aside), labelled with how often it came
before in its document, so that every labelled k-mer is there once. Each of 18 sketches takes the
three labelled k-mers that are least under its own hash and keeps them in the order of the text;
documents that share a sketch are candidates. Labelled k-mers being unique, the best
alignment of two documents is a longest increasing run of their common k-mers; only pairs of
places within the band that a similarity of 0.8 allows can belong to it. Similar means: aligned /
(k-mers of both - aligned) >= 0.8.

Texts that are equal stand for one class from the start; ``pairs`` says how candidates are compared.

Cases: null text counts as empty; texts without a word are alike only if equal; a text of one to
four words is one k-mer; repeated rows and null doc_ids belong to the class of their text; an
empty input gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.buffers import groups, mix, text_buffer
from silverlode.llm.frames import release, same_store, stored
from silverlode.llm.links import components
from silverlode.llm.pairs import SIMILARITY, kmers, near_links
from silverlode.llm.suffixes import keyed

SKETCHES, MINIMA = 18, 3
_SEEDS = np.random.default_rng(77).integers(1, 1 << 63, (2, SKETCHES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TOP = np.uint64((1 << 64) - 1)


def sketches(grams: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each sketch; rows without a k-mer have none."""
    counts = np.diff(begins)
    owner = np.repeat(np.arange(len(counts)), counts)
    some = np.flatnonzero(counts)
    share = np.minimum(1.0, 16 / np.maximum(counts, 1))
    limit = np.where(share >= 1, _TOP, (share * 2.0**63).astype(np.uint64) << np.uint64(1))
    limits = limit[owner]
    rows, buckets = [], []
    for seed, factor in _SEEDS.T:
        h = (grams ^ seed) * factor
        at = np.flatnonzero(h <= limits)
        few = np.flatnonzero(np.bincount(owner[at], minlength=len(counts)) < np.minimum(counts, MINIMA))
        if len(few):
            at = np.union1d(at, np.concatenate([np.arange(begins[k], begins[k + 1]) for k in few]))
        order = np.lexsort((h[at], owner[at]))
        at = at[order]
        first = np.searchsorted(owner[at], some)
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        at = np.sort(at[rank < MINIMA])
        first = np.searchsorted(owner[at], some)
        place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        turn = np.array([3, 5, 7, 11, 13, 17, 19, 23][:MINIMA], np.uint64)[place]
        rows.append(some)
        buckets.append(mix(np.add.reduceat(mix(grams[at] * turn), first) + factor) if len(at) else np.zeros(0, np.uint64))
    return np.concatenate(rows), np.concatenate(buckets)


def _members(texts: DataFrame) -> DataFrame:
    """(bucket, key) of every text's sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array(batch.column(0))
            data, offsets = text_buffer(batch.column(1))
            for i, j in groups(offsets):
                grams, begins = kmers(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                row, bucket = sketches(grams, begins)
                yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(keys[i:j][row], pa.int64())], ["bucket", "key"])

    return texts.select("key", "text").mapInArrow(run, "bucket bigint, key bigint")


def increasing(values: np.ndarray) -> int:
    """Length of the longest increasing run (not necessarily side by side) of distinct values."""
    if len(values) < 2 or (np.diff(values) > 0).all():
        return len(values)
    from bisect import bisect_left

    tails: list[int] = []
    for v in values.tolist():
        k = bisect_left(tails, v)
        if k == len(tails):
            tails.append(v)
        else:
            tails[k] = v
    return len(tails)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned labelled k-mers over all of both; 0 where the band shows that ``least`` is out of reach."""
    total = len(a) + len(b)
    need = int(np.ceil(least * total / (1 + least) - 1e-9))
    if not total or min(len(a), len(b)) < need:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= max(len(a), len(b)) - need  # one that lies farther off leaves too few to align
    i, j = i[near], j[near]
    if len(i) < need:
        return 0.0
    aligned = increasing(j[np.argsort(i)])
    return aligned / (total - aligned)


def near_classes(docs: DataFrame, least: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows of ``suffixes.keyed`` and (key, class): the least key of all texts alike, for texts with links."""
    rows = keyed(docs, doc_id, text)
    texts = rows.select("key", "text", "doc_id")
    # The text of one row of each class: copies would only be compared again.
    chosen = stored(rows.groupBy("key").agg(F.min("doc_id").alias("doc_id")), "chosen")

    def one_each(keys: DataFrame) -> DataFrame:
        wanted = chosen.join(keys, "key")
        same = [texts["key"] == wanted["key"], texts["doc_id"].eqNullSafe(wanted["doc_id"])]
        return texts.join(wanted, same, "left_semi").select("key", "text")

    links = near_links(_members(texts), one_each, similarity, least)
    found = components(links)
    release(links, chosen)
    return rows, same_store(found.select(F.col("node").alias("key"), F.col("component").alias("class")), found)


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, kept): one row a document; class_id is the least doc_id of its class, whose first row stays."""
    rows, classes = near_classes(docs, least, doc_id, text)
    slim = rows.select("doc_id", "key").join(classes, "key", "left")
    slim = stored(slim.select("doc_id", F.coalesce("class", "key").alias("class")), "classes", (classes,))
    least_id = slim.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    joined = slim.join(least_id, "class")
    one = Window.partitionBy("class", "doc_id").orderBy("doc_id")
    first = joined.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).withColumn("kept", F.row_number().over(one) == 1)
    rest = joined.where(~F.col("doc_id").eqNullSafe(F.col("class_id"))).withColumn("kept", F.lit(False))
    return first.union(rest).select("doc_id", "class_id", "kept")


def first_of_each(docs: DataFrame, least: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each class of near copies: the one with the least (doc_id, text); others go.

    A row whose doc_id is null comes first in its class.
    """
    rows, classes = near_classes(docs, least, doc_id, text)
    slim = rows.select("doc_id", "key").distinct().join(classes, "key", "left")
    slim = slim.select("doc_id", "key", F.coalesce("class", "key").alias("class"))
    first = stored(slim.groupBy("class").agg(F.min(F.struct("doc_id", "key")).alias("at")).select("at.*"), "first", (classes,))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed_rows = docs.select(whole, F.col(f"`{doc_id}`").alias("_id"), F.xxhash64(value).alias("_key"))
    same = [keyed_rows["_key"] == first["key"], keyed_rows["_id"].eqNullSafe(first["doc_id"])]
    kept = keyed_rows.join(first, same, "left_semi")
    # Equal rows are copies too: one of them stays.
    copies = Window.partitionBy("_key", "_id").orderBy("_key")
    return kept.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").select("_row.*")
