"""Near-duplicate vectors by a robust-pruned flat graph.

Equal vectors are one node. Nodes are dealt to the shards of their three nearest centres (k-means of a bounded
sample), each shard builds a robust-pruned neighbour graph of its nodes, and the adjacency lists of all shards are
united. Every node is then searched in its home shard over the united lists: greedily from the shard's medoid
with a beam, then by expanding every node found within range until none is new. Edges that leave the shard are
followed by joins, round by round, as far as the triangle inequality leaves a link possible. Every link is
verified by its cosine in double precision.

Recall is audited against a blocked brute-force scan: nodes are drawn until ``LINKS`` true links have been seen, and the recalls of
the linked nodes are averaged; where ``AUDITED`` nodes hold fewer, nodes that the graph has linked are audited as well. If the recall is
below ``RECALL`` the graph is built again with twice the overlap; only if it is still below at the last overlap are all nodes compared
exactly, block by block, without the rows that the triangle inequality rules out. Tasks return counts and a spanning forest of the links they find, so that a
large group of near copies makes no list of its pairs.

Bounds: the sample has at most 65536 rows and there are at most 16384 centres; a shard holds its vectors and no matrix of
all its pairs.

Cases: vectors that are null, zero, hold a null or non-finite component, or have another length than the commonest
link with nothing and are components of their own; equal vectors are linked; an id with several vectors is one node, whose
rows all get the links of its vectors together; a null id has no links; an empty input gives an empty result; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.frames import stored
from silverlode.llm.hilbert import matrix, usable
from silverlode.llm.links import components, runs, starts

SHARD, OVERLAP, DEGREE, CANDIDATES, SLACK = 1024, 3, 16, 48, 1.2
BEAM, STEPS = 16, 40
SAMPLE, CENTRES = 65536, 16384
RECALL, DRAWN, AUDITED, LINKS = 0.97, 64, 4096, 64
BLOCK, COMPARED = 512, 4096


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centres(sample: np.ndarray, number: int, steps: int = 6) -> np.ndarray:
    """Spherical k-means; empty centres keep their place."""
    number = min(number, len(sample))
    now = sample[np.random.default_rng(3).choice(len(sample), number, replace=False)]
    for _ in range(steps):
        at = np.concatenate([(sample[k : k + 4096] @ now.T).argmax(1) for k in range(0, len(sample), 4096)])
        sums = np.zeros_like(now)
        np.add.at(sums, at, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        now = np.where(size > 0, sums / np.maximum(size, 1e-12), now)
    return now


def pruned(x: np.ndarray, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """Robust-pruned neighbours of every row (-1: none) and their cosines."""
    n = len(x)
    width = min(CANDIDATES, n - 1)
    out, sims = np.full((n, degree), -1), np.zeros((n, degree))
    if width < 1:
        return out, sims
    for s in range(0, n, BLOCK):
        own = np.arange(s, min(n, s + BLOCK))
        near = x[own] @ x.T
        near[np.arange(len(own)), own] = -2
        cand = np.argpartition(-near, width - 1, axis=1)[:, :width]
        away = 1 - np.take_along_axis(near, cand, 1)
        left = away.copy()
        for k in range(degree):
            best = left.argmin(1)
            rows = np.arange(len(own))
            live = np.isfinite(left[rows, best])
            if not live.any():
                break
            chosen = cand[rows, best]
            out[own, k] = np.where(live, chosen, -1)
            sims[own, k] = np.where(live, 1 - away[rows, best], 0)
            between = 1 - np.einsum("rcd,rd->rc", x[cand], x[chosen])
            left[SLACK * between <= away] = np.inf
            left[rows, best] = np.inf
    return out, sims


def searched(x: np.ndarray, adjacency: np.ndarray, asked: np.ndarray, least: float) -> list[np.ndarray]:
    """For each asked row the rows found with a cosine of ``least`` or more, itself left out.

    ``adjacency`` holds rows, -1 where there is none.
    """
    n = len(x)
    middle = x.mean(0)
    medoid = int((x @ middle).argmax())
    found: list[np.ndarray] = []
    for s in range(0, len(asked), BLOCK):
        own = asked[s : s + BLOCK]
        rows = np.arange(len(own))
        seen = np.zeros((len(own), n), bool)
        done = np.zeros((len(own), n), bool)
        beam = np.full((len(own), BEAM), -1)
        score = np.full((len(own), BEAM), -np.inf)
        beam[:, 0], score[:, 0] = medoid, x[own] @ x[medoid]
        seen[:, medoid] = True
        near = np.zeros((len(own), n), bool)
        near[:, medoid] = score[:, 0] >= least
        for _ in range(STEPS):
            open_ = np.where((beam >= 0) & ~done[rows[:, None], np.maximum(beam, 0)], score, -np.inf)
            best = open_.argmax(1)
            live = np.isfinite(open_[rows, best])
            if not live.any():
                break
            node = np.where(live, beam[rows, best], medoid)
            done[rows, node] = True
            more = adjacency[node]
            fresh = (more >= 0) & live[:, None] & ~seen[rows[:, None], np.maximum(more, 0)]
            sim = np.where(fresh, np.einsum("rcd,rd->rc", x[np.maximum(more, 0)], x[own]), -np.inf)
            r, c = np.nonzero(fresh)
            seen[r, more[r, c]] = True
            near[r, more[r, c]] |= sim[r, c] >= least
            beam, score = np.concatenate((beam, more), 1), np.concatenate((score, sim), 1)
            top = np.argsort(-score, axis=1, kind="stable")[:, :BEAM]
            beam, score = np.take_along_axis(beam, top, 1), np.take_along_axis(score, top, 1)
        near[rows, own] = True  # the node itself is within range of itself
        seen[rows, own] = True
        opened = np.zeros_like(near)
        while True:
            r, c = np.nonzero(near & ~opened)
            if not len(r):
                break
            opened[r, c] = True
            for k in range(0, len(r), 1 << 16):
                q, more = r[k : k + (1 << 16)], adjacency[c[k : k + (1 << 16)]]
                a, b = np.nonzero(more >= 0)
                q, more = q[a], more[a, b]
                new = ~seen[q, more]
                q, more = q[new], more[new]
                seen[q, more] = True
                near[q, more] |= np.einsum("rd,rd->r", x[own[q]], x[more]) >= least
        near[rows, own] = False
        found += [np.flatnonzero(v) for v in near]
    return found


def _nodes(rows: DataFrame) -> DataFrame:
    """(key, copies, v): one row for each different vector, its least id and how many hold it."""
    return rows.groupBy("v").agg(F.min("key").alias("key"), F.count("*").alias("copies"))


def _dealt(nodes: DataFrame, overlap: int) -> DataFrame:
    """(shard, home, key, copies, v): every node in its nearest shards."""
    n = nodes.count()
    number = min(CENTRES, -(-n // SHARD))
    sample = nodes.orderBy(F.xxhash64("key")).limit(min(SAMPLE, 64 * number)).select("v").collect()
    found = centres(unit(np.array([r["v"] for r in sample])), number) if sample else np.zeros((1, 1))
    shared = nodes.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(matrix(batch.column("v")))
            near = x @ shared.value.T
            width = min(overlap, near.shape[1])
            order = np.argsort(-near, axis=1, kind="stable")[:, :width]
            for k in range(width):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(order[:, k].astype(np.int32)), pa.array(np.full(len(x), k == 0)), *(batch.column(c) for c in ("key", "copies", "v"))],
                    ["shard", "home", "key", "copies", "v"],
                )

    kind = "shard int, home boolean, key bigint, copies bigint, v array<double>"
    return nodes.select("key", "copies", "v").mapInArrow(run, kind)


def _graph(dealt: DataFrame) -> DataFrame:
    """(key, nbrs, sims): the united adjacency lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["shard"]):
            edge = starts(table, ["shard"])
            for s, e in zip(edge[:-1], edge[1:]):
                own = table.slice(s, e - s)
                keys = np.array(own.column("key"))
                nbrs, sims = pruned(unit(matrix(own.column("v"))))
                r, c = np.nonzero(nbrs >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(keys[r]), pa.array(keys[nbrs[r, c]]), pa.array(sims[r, c])], ["key", "nbr", "sim"])

    rows = dealt.repartition("shard").sortWithinPartitions("shard", "key")
    edges = rows.mapInArrow(run, "key bigint, nbr bigint, sim double").groupBy("key", "nbr").agg(F.max("sim").alias("sim"))
    return edges.groupBy("key").agg(F.collect_list(F.struct("nbr", "sim")).alias("edges"))


def _search(dealt: DataFrame, graph: DataFrame, least: float) -> DataFrame:
    """(kind, a, b, n). 0: node a has n linked vectors in its shard. 1: a and b are linked, maybe over others. 2: b is to be compared with a."""
    theta = float(np.arccos(least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["shard"]):
            edge = starts(table, ["shard"])
            for s, e in zip(edge[:-1], edge[1:]):
                own = table.slice(s, e - s).combine_chunks()
                keys, copies = np.array(own.column("key")), np.array(own.column("copies"))
                x = unit(matrix(own.column("v")))
                lists = own.column("edges").to_pylist()
                size = max([1, *(len(v or ()) for v in lists)])
                nbrs, sims = np.full((len(keys), size), -1), np.full((len(keys), size), -1.0)
                for k, v in enumerate(lists):
                    for j, one in enumerate(v or ()):
                        nbrs[k, j], sims[k, j] = one["nbr"], one["sim"]
                place = np.minimum(np.searchsorted(keys, nbrs), len(keys) - 1)  # rows come sorted by key
                inside = (nbrs >= 0) & (keys[place] == nbrs)
                adjacency = np.where(inside, place, -1)
                angle = np.arccos(np.clip(sims, -1, 1))
                leaving = (nbrs >= 0) & ~inside & (angle <= 2 * theta)
                asked = np.flatnonzero(np.array(own.column("home")))
                label = np.arange(len(keys))
                found = searched(x, adjacency, asked, least)
                moved = True
                while moved:
                    moved = False
                    for q, near in zip(asked, found):
                        if len(near):
                            low = min(label[q], label[near].min())
                            if low < label[q] or (label[near] > low).any():
                                label[q], label[near], moved = low, low, True
                out = [(0, keys[q], -1, copies[near].sum()) for q, near in zip(asked, found)]
                out += [(1, keys[k], keys[label[k]], 0) for k in np.flatnonzero(label != np.arange(len(keys)))]
                for q, near in zip(asked, found):
                    from_ = np.append(near, q)
                    bound = np.arccos(np.clip(x[from_] @ x[q], -1, 1)) + theta + 1e-9
                    r, c = np.nonzero(leaving[from_] & (angle[from_] <= bound[:, None]))
                    out += [(2, keys[q], y, 0) for y in np.unique(nbrs[from_[r], c])]
                columns = [np.array(v, np.int64) for v in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], ["kind", "a", "b", "n"])

    joined = dealt.join(graph, "key", "left").select("shard", "home", "key", "copies", "v", "edges")
    return joined.repartition("shard").sortWithinPartitions("shard", "key").mapInArrow(run, "kind bigint, a bigint, b bigint, n bigint")


def _cosine(a: str, b: str):
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    return dot(F.col(a), F.col(b)) / F.sqrt(dot(F.col(a), F.col(a)) * dot(F.col(b), F.col(b)))


def graph_links(nodes: DataFrame, least: float, overlap: int) -> tuple[DataFrame, DataFrame]:
    """(key, n): linked vectors of every node, and (a, b): links that hold the components together."""
    dealt = stored(_dealt(nodes, overlap), "shards")
    graph = stored(_graph(dealt), "graph")
    found = stored(_search(dealt, graph, least), "found")
    counts = found.where("kind = 0").select(F.col("a").alias("key"), "n")
    edges = found.where("kind = 1").select("a", "b")
    homes = dealt.where("home").select(F.col("key").alias("a"), F.col("shard").alias("home_shard"))
    members = dealt.select(F.col("key").alias("b"), F.col("shard").alias("home_shard"))
    vectors = nodes.select("key", "v", "copies")
    theta = float(np.arccos(least))
    seen = None
    open_ = found.where("kind = 2").select("a", "b").distinct()
    while True:
        asked = stored(open_ if seen is None else open_.join(seen, ["a", "b"], "left_anti"), "open")
        if asked.isEmpty():
            break
        seen = asked if seen is None else seen.union(asked)
        left = vectors.select(F.col("key").alias("a"), F.col("v").alias("x"))
        right = vectors.select(F.col("key").alias("b"), F.col("v").alias("y"), "copies")
        near = asked.join(left, "a").join(right, "b").withColumn("cosine", _cosine("x", "y")).where(F.col("cosine") >= least)
        near = stored(near.select("a", "b", "copies", "cosine"), "near")
        counts = counts.union(near.select(F.col("a").alias("key"), F.col("copies").alias("n")))
        edges = edges.union(near.select("a", "b"))
        more = near.join(graph.select(F.col("key").alias("b"), F.explode("edges").alias("e")), "b")
        more = more.where(F.acos(F.least("e.sim", F.lit(1.0))) <= F.acos(F.least("cosine", F.lit(1.0))) + theta + 1e-9)
        more = more.select("a", F.col("e.nbr").alias("b")).where("a <> b").distinct()
        # What lies in the home shard was searched there.
        open_ = more.join(homes, "a").join(members, ["b", "home_shard"], "left_anti").select("a", "b")
    return counts.groupBy("key").agg(F.sum("n").alias("n")), edges


def recall(nodes: DataFrame, counts: DataFrame, least: float) -> float:
    """Mean share of its true links found of a linked node in a bounded sample.

    Where links are so few that even ``AUDITED`` nodes have under ``LINKS`` of them, as many nodes that have links are audited too, and the
    lesser of both shares counts.
    """
    drawn = DRAWN
    while True:
        some = nodes.orderBy(F.xxhash64("key", F.lit(9))).limit(drawn).select("key", "v").collect()
        if not some:
            return 1.0
        truth = _true_links(nodes, some, least)
        both = truth.where(F.col("true") > 0).join(counts, "key", "left").select("true", F.least("true", F.coalesce("n", F.lit(0))).alias("f"))
        seen = both.agg(F.sum("true").alias("t"), F.avg(F.col("f") / F.col("true")).alias("mean")).first()
        if (seen["t"] or 0) >= LINKS or len(some) < drawn:
            return 1.0 if seen["mean"] is None else seen["mean"]
        if drawn >= AUDITED:
            break
        drawn *= 8
    linked = nodes.join(counts.where("n > 0"), "key", "left_semi").orderBy(F.xxhash64("key", F.lit(10))).limit(DRAWN).select("key", "v").collect()
    if not linked:
        return 1.0 if seen["mean"] is None else seen["mean"]
    own = _true_links(nodes, linked, least).where(F.col("true") > 0).join(counts, "key", "left")
    mean = own.agg(F.avg(F.least("true", F.coalesce("n", F.lit(0))) / F.col("true"))).first()[0]
    return min(x for x in (mean, seen["mean"], 1.0) if x is not None)


def _true_links(nodes: DataFrame, some: list, least: float) -> DataFrame:
    shared = nodes.sparkSession.sparkContext.broadcast((np.array([r["key"] for r in some]), unit(np.array([r["v"] for r in some]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, x = shared.value
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            if batch.num_rows:
                near = x @ unit(matrix(batch.column("v"))).T >= least
                near &= keys[:, None] != np.array(batch.column("key"))[None, :]
                total += near @ np.array(batch.column("copies"))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total)], ["key", "true"])

    return nodes.select("key", "v", "copies").mapInArrow(run, "key bigint, true bigint").groupBy("key").agg(F.sum("true").alias("true"))


def exact_links(nodes: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """As ``graph_links``, by comparing every node with every node that may be near enough."""
    theta = float(np.arccos(least))
    dealt = stored(_dealt(nodes, 1).select("shard", F.xxhash64("key").alias("place"), "key", "copies", "v"), "homes")
    sizes = {r["shard"]: r["n"] for r in dealt.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # a row a centre
    parts = {s: -(-n // COMPARED) for s, n in sizes.items()}
    found = None
    for s in sorted(parts):
        for part in range(parts[s]):
            block = dealt.where((F.col("shard") == s) & (F.pmod("place", F.lit(parts[s])) == part)).select("key", "v").collect()
            if not block:
                continue
            y = unit(np.array([r["v"] for r in block]))
            mean = y.sum(0)
            middle = mean / (np.linalg.norm(mean) or 1.0)
            reach = float(np.arccos(np.clip(y @ middle, -1, 1)).max()) + theta + 1e-9
            shared = nodes.sparkSession.sparkContext.broadcast((np.array([r["key"] for r in block]), y, middle, reach))
            rows = stored(dealt.select("key", "copies", "v").mapInArrow(_compared(shared, least), "kind int, a bigint, b bigint, n bigint"), "exact")
            found = rows if found is None else found.union(rows)
            shared.unpersist()
    if found is None:
        found = nodes.sparkSession.createDataFrame([], "kind int, a bigint, b bigint, n bigint")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n"))
    return counts, found.where("kind = 1").select("a", "b")


def _compared(shared, least: float):
    """Rows as of ``_search``, kinds 0 and 1, of the block in ``shared`` against every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, y, middle, reach = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(matrix(batch.column("v")))
            may = np.flatnonzero(np.arccos(np.clip(x @ middle, -1, 1)) <= reach)
            own, copies = np.array(batch.column("key"))[may], np.array(batch.column("copies"))[may]
            near = (y @ x[may].T >= least) & (keys[:, None] != own[None, :])
            q, r = np.nonzero(near)
            if not len(q):
                continue
            # Components of the block's and the batch's nodes over these links: one edge a node is returned.
            label, other = np.arange(len(keys)), np.full(len(own), len(keys))
            while True:
                before = label.copy()
                np.minimum.at(other, r, label[q])
                np.minimum.at(label, q, other[r])
                if (label == before).all():
                    break
            linked, met = np.unique(q), np.unique(r)
            total = near @ copies
            ends = np.concatenate((keys[linked], keys[linked], own[met]))
            tops = np.concatenate((np.full(len(linked), -1), keys[label[linked]], keys[other[met]]))
            kind = np.repeat(np.array([0, 1, 1], np.int32), [len(linked), len(linked), len(met)])
            number = np.concatenate((total[linked], np.zeros(len(linked) + len(met), np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(ends), pa.array(tops), pa.array(number)], ["kind", "a", "b", "n"])

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.9, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, n_links, component_id, kept) of every row of ``vectors``."""
    rows = usable(vectors, key, vector)
    nodes = stored(_nodes(rows), "nodes")
    overlap = OVERLAP
    while True:
        counts, edges = graph_links(nodes, least, overlap)
        counts = stored(counts, "counts")
        share = recall(nodes, counts, least)
        if share >= RECALL:
            break
        if overlap >= 8 * OVERLAP:
            counts, edges = exact_links(nodes, least)
            counts = stored(counts, "counts")
            break
        overlap *= 2
    found = components(edges).select(F.col("node").alias("key"), "component")
    known = nodes.join(counts, "key", "left").join(found, "key", "left")
    links = F.coalesce("n", F.lit(0)) + F.col("copies") - 1
    known = stored(known.select("v", links.alias("n_links"), F.coalesce("component", "key").alias("component")), "known")
    whole = vectors.select(F.col(key).alias("_key"), F.col(vector).cast("array<double>").alias("v"), F.col(key).isNull().alias("_none"))
    joined = whole.join(known, "v", "left")
    apart = F.col("_none") | F.col("component").isNull()
    return joined.select(
        F.col("_key").alias(key),
        F.when(apart, 0).otherwise(F.col("n_links")).cast("bigint").alias("n_links"),
        F.when(apart, F.col("_key")).otherwise(F.col("component")).alias("component_id"),
    ).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
