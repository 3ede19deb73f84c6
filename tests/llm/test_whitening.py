from __future__ import annotations

import numpy as np
import pytest

from conftest import DATA
from silverlode.llm import whitening
from silverlode.llm.queries import QUERIES

KIND = "vec_id bigint, embedding array<float>"


def plain(rows, most=4):
    """Rows (vec_id, component, n, deviation, |whitened|, explained) by whole numbers and one eigenproblem."""
    kept = [(k, v) for k, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in kept]
    size = max(set(sizes), key=lambda d: (sizes.count(d), d)) if sizes else 0
    x = [(k, [int(np.floor(256 * np.float64(np.float32(c)))) for c in v]) for k, v in kept if len(v) == size]
    fit = sorted({tuple(v) for _, v in x})
    if not fit:
        return [], np.zeros((0, 0))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[c - s / n for c, s in zip(v, sums)] for v in fit])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    order = [k for k in np.argsort(values)[::-1][:most] if values[k] > 1e-12 * np.trace(covariance)]
    out = []
    for k, v in x:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        z = np.array([c - s / n for c, s in zip(v, sums)]) @ axes[:, order] / np.sqrt(values[order])
        out += [(k, c + 1, n, deviation, z[c], values[order[c]] / np.trace(covariance)) for c in range(len(order))]
    return out, covariance


def agree(got, rows):
    want, _ = plain(rows)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], abs(r[4]))
    got = sorted(((r.vec_id, r.component, r.n, int(r.deviation), r.whitened, r.explained) for r in got), key=key)
    want = sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    signs: dict = {}
    for g, w in zip(got, want):
        assert abs(abs(g[4]) - abs(w[4])) < 1e-8 and abs(g[5] - w[5]) < 1e-9
        if abs(w[4]) > 1e-6:
            signs.setdefault(g[1], set()).add(np.sign(g[4]) == np.sign(w[4]))
    return signs


def test_query_on_a_whole_table(spark):
    folder = str(DATA / "sf0.001")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    result = QUERIES["op13_block_whitening"](spark, folder)
    kinds = dict(result.dtypes)
    assert kinds == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    got = result.collect()
    assert len(got) == 4 * len(rows) and {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    # Either sign, but the same for all rows.
    assert all(len(s) == 1 for s in agree(got, rows).values())


def test_cases(spark):
    pick = np.random.default_rng(3)
    rows = [(int(k), pick.normal(size=3).round(2).tolist()) for k in range(40)]
    rows += [(7, [0.5, 0.25, -0.25])] * 30 + [(7, [0.1, 0.2, 0.3]), (None, [0.0, 0.0, 0.0]), (90, [-0.0, 9.0, 1e-9])]
    rows += [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 1.0, 1.0]), (104, [float("inf"), 1.0, 1.0]), (105, [1.0, 2.0])]
    vectors = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], KIND + ", index int, x string, n int").repartition(5)
    agree(whitening.whiten(vectors).collect(), rows)


def test_blocks_of_many_rows_and_columns(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 4)
    monkeypatch.setattr(whitening, "TASK_BLOCKS", 2)
    pick = np.random.default_rng(4)
    rows = [(k, (pick.normal(size=10) * np.arange(1, 11)).tolist()) for k in range(100)]
    got = whitening.whiten(spark.createDataFrame(rows, KIND).repartition(3)).collect()
    assert len(got) == 400 and got[0].identity_error < 1e-9
    agree(got, rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_without_variance(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, KIND)).collect() == []


def test_fewer_dimensions_than_components(spark):
    rows = [(1, [0.0, 1.0]), (2, [0.5, 1.0]), (3, [2.0, 1.0])]
    agree(whitening.whiten(spark.createDataFrame(rows, KIND)).collect(), rows)
