from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from silverlode.llm import hilbert
from silverlode.llm.queries import QUERIES


@pytest.mark.parametrize("axes,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_steps_to_a_neighbouring_cell(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    key = hilbert.curve(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    along = cells[np.argsort(key)]
    assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def brute(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, v in ok:
        if q % 100 == 0:
            found = sorted((float(np.sqrt(((x - v) ** 2).sum())), i) for i, x in ok if i != q)
            out[q] = found[:k]
    return out


def test_whole_table(spark):
    folder = str(DATA / "sf0.1")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute(rows, 10)
    got: dict = {}
    for r in QUERIES["op7_shifted_hilbert"](spark, folder).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = total = 0
    for q, true in want.items():
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, 11)) and [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        hit += len({i for _, i, _ in own} & {i for _, i in true})
        total += len(true)
    assert set(got) == set(want) and hit / total >= 0.93


def test_copies_ties_and_unusable_rows(spark):
    rows = [(k, [1.0, 2.0, 0.0]) for k in range(0, 60)] + [(100, [1.0, 2.0, 0.0]), (200, [0.0, 0.0, 0.0]), (300, None), (None, [1.0, 1.0, 1.0])]
    rows += [(400, [float("nan"), 1.0, 1.0]), (500, [None, 1.0, 1.0]), (600, [5.0, 5.0, 5.0]), (601, [float("inf"), 1.0, 1.0]), (602, [1.0])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, key int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in hilbert.nearest(vectors, F.col("key") % 100 == 0).collect())
    at = {q: [(i, s) for qq, _, i, s in got if qq == q] for q in {g[0] for g in got}}
    assert set(at) == {0, 100, 600}
    assert at[0] == [(k, 0.0) for k in range(1, 11)] and at[100] == [(k, 0.0) for k in range(10)]
    assert [i for i, _ in at[600]] == list(range(10))


def test_empty_and_single(spark):
    kind = "vec_id bigint, embedding array<float>"
    for rows in ([], [(100, [1.0, 2.0])]):
        assert hilbert.nearest(spark.createDataFrame(rows, kind), F.col("key") % 100 == 0).collect() == []


def test_repeated_ids_with_different_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 0.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (3, [3.0, 0.0]), (5, [9.0])]
    rows += [(200, [2.0 + k, 1.0]) for k in range(40)]  # one id with many vectors
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in hilbert.nearest(vectors, F.col("key") % 100 == 0, 10).collect())
    assert got == [(100, 1, 1, 0.0), (100, 2, 200, round(2**0.5, 6)), (100, 3, 3, 2.0), (200, 1, 3, 1.0), (200, 2, 1, round(2**0.5, 6)), (200, 3, 100, round(2**0.5, 6))]
