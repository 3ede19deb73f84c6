from __future__ import annotations

import numpy as np
import pytest

from conftest import DATA
from silverlode.llm import flat_graph
from silverlode.llm.queries import QUERIES


def brute(rows, least=0.9):
    ok = [k for k, (i, v) in enumerate(rows) if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    x = flat_graph.unit(np.array([rows[k][1] for k in ok], float))
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    label = np.array([rows[k][0] for k in ok])
    while True:
        new = np.array([min([label[a], *label[near[a]]]) for a in range(len(ok))])
        if (new == label).all():
            break
        label = new
    out = [(i, 0, i, True) for i, _ in rows]
    for a, k in enumerate(ok):
        out[k] = (rows[k][0], int(near[a].sum()), int(label[a]), bool(label[a] == rows[k][0]))
    return out


def test_pruned_lists_have_no_dominated_neighbour():
    x = flat_graph.unit(np.random.default_rng(0).normal(size=(200, 6)))
    nbrs, _ = flat_graph.pruned(x)
    for a in range(200):
        own = [b for b in nbrs[a] if b >= 0]
        away = [1 - x[a] @ x[b] for b in own]
        assert own and a not in own and away == sorted(away)
        for i, p in enumerate(own):
            assert all(flat_graph.SLACK * (1 - x[p] @ x[c]) > 1 - x[a] @ x[c] for c in own[i + 1 :])


def test_whole_table(spark):
    folder = str(DATA / "sf0.1")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op2_flat_graph"](spark, folder).collect()]
    assert sorted(got) == sorted(brute(rows))


@pytest.mark.parametrize("seed", [0, 1])
def test_many_shards(spark, seed, monkeypatch):
    monkeypatch.setattr(flat_graph, "SHARD", 40)
    pick = np.random.default_rng(seed)
    base = pick.normal(size=(150, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    for k in range(25):
        for _ in range(int(pick.integers(1, 9))):
            rows.append((len(rows), (base[k] * pick.uniform(0.5, 2) + pick.normal(size=16) * 0.12).tolist()))
    rows += [(len(rows) + k, base[0].tolist()) for k in range(4)]
    rows += [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16), (9003, [1.0]), (9004, [None] * 16)]
    vectors = spark.createDataFrame([(*r, 2) for r in rows], "vec_id bigint, embedding array<double>, copies int").repartition(4)
    got = sorted(tuple(r) for r in flat_graph.near_duplicates(vectors).collect())
    want = sorted(brute([r for r in rows if r[0] != 9003]) + [(9003, 0, 9003, True)])
    assert [g[0] for g in got] == [w[0] for w in want]
    hit = sum(min(g[1], w[1]) for g, w in zip(got, want))
    assert all(g[1] <= w[1] for g, w in zip(got, want)) and hit >= 0.97 * sum(w[1] for w in want)
    assert sum(g[2:] == w[2:] for g, w in zip(got, want)) >= 0.97 * len(want)


def test_null_ids_and_empty(spark):
    kind = "vec_id bigint, embedding array<float>"
    got = flat_graph.near_duplicates(spark.createDataFrame([(None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.1])], kind)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in got) == [(0, 0, 0, True), (3, 2, 3, True), (3, 2, 3, True)]
    assert flat_graph.near_duplicates(spark.createDataFrame([], kind)).collect() == []


def _pairs(pairs):
    pick = np.random.default_rng(4)
    base = pick.normal(size=(300, 32))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    return rows + [(300 + k, (base[k % 30] + pick.normal(size=32) * 0.05).tolist()) for k in range(pairs)]


@pytest.mark.parametrize("pairs", [1, 6])
def test_few_links_stay_with_the_graph(spark, monkeypatch, pairs):
    for name, value in (("SHARD", 100), ("DRAWN", 8), ("AUDITED", 64)):
        monkeypatch.setattr(flat_graph, name, value)
    monkeypatch.setattr(flat_graph, "exact_links", None)
    rows = _pairs(pairs)
    got = flat_graph.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows)) and sum(r.n_links for r in got) >= 2 * pairs


def test_one_odd_length_does_not_decide(spark):
    rows = [(0, [1.0]), *[(k, [1.0, 2.0, 3.0]) for k in range(1, 5)]]
    got = flat_graph.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(0, 0, 0), *[(k, 3, 1) for k in range(1, 5)]]


@pytest.mark.parametrize("pairs", [60])
def test_links_that_the_graph_loses_are_found(spark, monkeypatch, pairs):
    for name, value in (("SHARD", 100), ("DRAWN", 8), ("AUDITED", 64), ("COMPARED", 60)):
        monkeypatch.setattr(flat_graph, name, value, raising=False)
    none = spark.createDataFrame([], "key bigint, n bigint"), spark.createDataFrame([], "a bigint, b bigint")
    monkeypatch.setattr(flat_graph, "graph_links", lambda *_: none)
    rows = _pairs(pairs)
    got = flat_graph.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows)) and sum(r.n_links for r in got) >= 2 * pairs
