"""Connected components of link tables, and runs of rows with equal keys inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.frames import same_store, stored


def _forest(edges: DataFrame) -> DataFrame:
    """A spanning forest of each partition's edges: dense groups shrink to one edge a node, none is lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent.setdefault(up, up)
                x = up
            return x

        def flushed() -> pa.RecordBatch:
            found = [(x, root(x)) for x in parent]
            found = [(x, r) for x, r in found if x != r]
            parent.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], ["a", "b"]
            )

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > 1_000_000:
                yield flushed()
        yield flushed()

    return edges.mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); the component is its smallest node.

    Large-star and small-star steps in turn: every node's larger neighbours, then its smaller ones, are
    linked to its least neighbour until nothing changes. Both steps are a partial aggregate and one join
    that Spark can split, so a node with very many links is no single task. Rows with a null take no part.
    """
    spark = edges.sparkSession
    now = stored(_forest(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")), "edges")
    before = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
        now = stored(small.where("a <> b").distinct(), "edges", (now,))
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return same_store(found.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), now)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of a sorted partition as tables that end where a key ends, so no key is in two of them."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = tuple(batch.column(k)[-1].as_py() for k in keys)
        same = np.ones(batch.num_rows, bool)
        for k, v in zip(keys, last):
            same &= np.array(batch.column(k)) == v
        cut = batch.num_rows - int(same[::-1].argmin()) if not same.all() else 0
        if cut:
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = [batch.slice(cut)]
        elif kept and tuple(kept[0].column(k)[0].as_py() for k in keys) != last:
            yield pa.Table.from_batches(kept)
            kept = [batch]
        else:
            kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)


def starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First rows of the runs of equal keys, and the number of rows."""
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for k in keys:
        v = np.array(table.column(k))
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)
