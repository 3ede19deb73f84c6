"""Nearest neighbours by several shifted Hilbert orderings.

Vectors are projected to eight directions (turned anew for every ordering, along the principal axes of a sample),
each coordinate is replaced by its place among the sample's, shifted, and the Hilbert index of the cell is the
key. Spark range-partitions and sorts every ordering; ranks are cut into windows of equal size, so that no key, however
common, makes a window larger. A query meets the windows about its own in each ordering; in each window its
nearest are found by matrix products, and the few per window are merged and ranked by the exact distance.

The reach (in ranks) is measured, not guessed: for a sample of queries the true neighbours are found by brute
force, and the reach is the least that has the wanted share of them in some ordering. Rows with equal
vectors are neighbours of one another: of each vector the k + 1 smallest ids are candidates, which is all an
answer can hold. Where the data has no structure (random directions) the reach grows towards the whole table;
the answer stays right and the search approaches a blocked scan.

Cases: vectors that are null, zero, hold a null or non-finite component, or have another length than the
commonest (of equally common ones the longest) take no part, nor do null ids; a repeated id is a query and a candidate with each of its different
vectors, its nearest counts, and it is no neighbour of itself; fewer than k candidates give fewer rows; an empty input gives an empty result; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.frames import stored
from silverlode.llm.links import runs, starts

ORDERINGS, DIRECTIONS, BITS = 6, 8, 7
SAMPLE, AUDITED, WANTED = 2048, 96, 0.97
WINDOW = 512
SEED = 5


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, v): ids and vectors in double precision that take part."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("bigint").alias("key"), v.alias("v")).where("key IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (common["d"] if common else 0))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), float)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def curve(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of whole coordinates below 2^bits."""
    x = cells.T.astype(np.int64).copy()
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for axis in x:
            high = (axis & q) != 0
            swap = np.where(high, 0, (x[0] ^ axis) & p)
            x[0] ^= np.where(high, p, swap)
            axis ^= swap
        q >>= 1
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (axis >> bit & 1)
    return key


class Orderings:
    """Projections, quantiles and shifts of every ordering, from a sample of vectors."""

    def __init__(self, sample: np.ndarray, orderings: int = ORDERINGS, seed: int = SEED) -> None:
        pick = np.random.default_rng(seed)
        self.middle = sample.mean(0)
        _, _, axes = np.linalg.svd(sample - self.middle, full_matrices=True)
        number = min(DIRECTIONS, sample.shape[1])
        self.maps, self.edges, self.shifts = [], [], []
        for k in range(orderings):
            turn = np.linalg.qr(pick.normal(size=(len(axes), len(axes))))[0] if k else np.eye(len(axes))
            self.maps.append((turn @ axes)[:number])
            self.edges.append(np.sort((sample - self.middle) @ self.maps[-1].T, axis=0))
            self.shifts.append(pick.random(number) * 0.25)

    def keys(self, x: np.ndarray) -> Iterator[np.ndarray]:
        for directions, edges, shift in zip(self.maps, self.edges, self.shifts):
            y = (x - self.middle) @ directions.T
            place = np.stack([np.searchsorted(edges[:, d], y[:, d]) for d in range(y.shape[1])], 1) / (len(edges) + 1)
            cells = ((place + shift) / 1.25 * (1 << BITS)).astype(np.int64)
            yield curve(np.minimum(cells, (1 << BITS) - 1), BITS)


def _ordered(rows: DataFrame, orderings: Orderings) -> DataFrame:
    """(ordering, rank, uid, key, candidate, asked): every row's rank in each ordering."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(orderings)
    names = ["ordering", "place", "uid", "key", "candidate", "asked"]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, places in enumerate(shared.value.keys(matrix(batch.column("v"))) if batch.num_rows else []):
                own = [batch.column(c) for c in names[2:]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), k, np.int32)), pa.array(places), *own], names)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            more = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "part", "at"])
            at += n

    schema = "ordering int, place bigint, uid bigint, key bigint, candidate boolean, asked boolean"
    table = stored(rows.select("uid", "key", "v", "candidate", "asked").mapInArrow(keyed, schema), "places")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    dealt = table.repartitionByRange(int(parts), "ordering", "place", "uid").sortWithinPartitions("ordering", "place", "uid")
    table = stored(dealt.mapInArrow(numbered, schema + ", part int, at bigint"), "ranks", (table,))
    sizes = table.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return stored(table.join(bases, "part").select("ordering", (F.col("base") + F.col("at")).alias("rank"), "uid", "key", "candidate", "asked"), "ranked", (table,))


def _best(distance: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` least, ties to smaller keys, with a few more for rounding."""
    if len(distance) <= k + 6:
        return np.arange(len(distance))
    edge = np.partition(distance, k + 5)[k + 5]
    return np.flatnonzero(distance <= edge) if (distance <= edge).sum() <= 4 * k + 24 else np.lexsort((keys, distance))[: k + 6]


def _exactly(asked: np.ndarray, asked_keys, x: np.ndarray, keys: np.ndarray, k: int) -> tuple[list, list, list]:
    """For each query its k nearest of the rows ``x``: query, key, exact distance. A key that is there several times counts once."""
    q, found, score = [], [], []
    square = (x * x).sum(1)
    repeated = len(np.unique(keys)) < len(keys)
    for own, key in zip(asked, asked_keys):
        distance = square - 2 * (x @ own)
        if repeated:
            order = np.lexsort((distance, keys))
            first = order[np.concatenate(([True], np.diff(keys[order]) > 0))]  # the nearest of each key, to rounding
            near = first[_best(distance[first], keys[first], k)]
        else:
            near = _best(distance, keys, k)
        near = near[keys[near] != key]
        exact = np.sqrt(((x[near] - own) ** 2).sum(1))
        near, exact = (v[np.lexsort((keys[near], exact))[:k]] for v in (near, exact))
        q += [int(key)] * len(near)
        found += keys[near].tolist()
        score += exact.tolist()
    return q, found, score


_FOUND = "query_id bigint, vec_id bigint, score double"


def _answer(q: list, found: list, score: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(q, pa.int64()), pa.array(found, pa.int64()), pa.array(score, pa.float64())], ["query_id", "vec_id", "score"]
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def brute_force(queries: list, rows: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of a stated, bounded list of (key, v) against all rows, in blocks."""
    keys = np.array([r["key"] for r in queries], np.int64)
    shared = rows.sparkSession.sparkContext.broadcast((keys, np.array([r["v"] for r in queries], float)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _answer(*_exactly(shared.value[1], shared.value[0], matrix(batch.column("v")), np.array(batch.column("key")), k))

    return _ranked(rows.select("key", "v").mapInArrow(run, _FOUND), k)


def reach(ranked: DataFrame, truth: DataFrame, wanted: float) -> int:
    """Ranks to look to either side, so that the wanted share of true neighbours lies there in some ordering."""
    left = ranked.where("asked").select("ordering", F.col("key").alias("query_id"), F.col("rank").alias("a"))
    right = ranked.select("ordering", F.col("key").alias("vec_id"), F.col("rank").alias("b"))
    both = truth.join(left, "query_id").join(right, ["ordering", "vec_id"])
    apart = both.groupBy("query_id", "vec_id").agg(F.min(F.abs(F.col("a") - F.col("b"))).alias("d"))
    distances = sorted(r["d"] for r in apart.collect())  # at most k rows for each audited query
    return int(distances[min(len(distances) - 1, int(np.ceil(wanted * len(distances))))]) if distances else 0


def _search(rows: DataFrame, ranked: DataFrame, radius: int, k: int) -> DataFrame:
    keys = ["ordering", "window"]
    window = F.floor(F.col("rank") / WINDOW)
    left = ranked.where("candidate").select("ordering", window.alias("window"), "uid", F.lit(False).alias("asked"))
    spread = F.explode(F.sequence(F.floor((F.col("rank") - radius) / WINDOW), F.floor((F.col("rank") + radius) / WINDOW)))
    right = ranked.where("asked").select("ordering", spread.alias("window"), "uid", F.lit(True).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, keys):
            edge = starts(table, keys)
            x, key, asked = matrix(table.column("v")), np.array(table.column("key")), np.array(table.column("asked"))
            for s, e in zip(edge[:-1], edge[1:]):
                q = np.arange(s, e)[asked[s:e]]
                own = np.arange(s, e)[~asked[s:e]]
                if len(q) and len(own):
                    yield _answer(*_exactly(x[q], key[q], x[own], key[own], k))

    met = left.union(right).join(rows.select("uid", "key", "v"), "uid").select(*keys, "key", "asked", "v")
    dealt = met.repartition(*keys).sortWithinPartitions(*keys)
    return _ranked(dealt.mapInArrow(run, _FOUND), k)


def nearest(vectors: DataFrame, queries: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", wanted: float = WANTED) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by Euclidean distance of the rows for which ``queries`` holds.

    ``queries`` is a condition on the column ``key``.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector).withColumn("uid", F.xxhash64("key", "v"))
    rows = stored(rows.dropDuplicates(["uid"]), "rows")
    copies = Window.partitionBy("v").orderBy("key")
    slim = rows.withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k + 1).select("uid", F.lit(True).alias("candidate"))
    known = rows.join(slim, "uid", "left").withColumn("asked", F.coalesce(queries, F.lit(False)))
    known = known.withColumn("candidate", F.coalesce("candidate", F.lit(False))).where("candidate OR asked")
    known = stored(known, "vectors", (rows,))
    sample = known.orderBy(F.xxhash64("key")).limit(SAMPLE).select("v").collect()
    if not sample:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    ranked = _ordered(known, Orderings(np.array([r["v"] for r in sample])))
    audited = known.where("asked").orderBy(F.xxhash64("key", F.lit(1))).limit(AUDITED).select("key", "v").collect()
    truth = brute_force(audited, known.where("candidate"), k)
    radius = reach(ranked, truth.select("query_id", "vec_id"), wanted)
    return _search(known, ranked, radius, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
