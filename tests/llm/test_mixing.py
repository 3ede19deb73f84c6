from __future__ import annotations

import numpy as np
import pytest

from conftest import DATA
from silverlode.llm import mixing


def plain(tokens, targets, budget, steps=2000):
    """Proportional fitting on a full array."""
    total = tokens.sum() * budget
    taken = tokens * budget
    for _ in range(steps):
        for axis, target in enumerate(targets):
            others = tuple(k for k in range(tokens.ndim) if k != axis)
            share = np.where(tokens.sum(others) > 0, target, 0.0)
            have = taken.sum(others)
            factor = np.divide(total * share / share.sum(), have, out=np.ones_like(have), where=have > 0)
            taken = np.minimum(tokens, taken * factor.reshape([-1 if k == axis else 1 for k in range(tokens.ndim)]))
    return taken


def cells_of(spark, tokens):
    rows = [(f"s{i}", f"l{j}", int(k), float(n)) for (i, j, k), n in np.ndenumerate(tokens)]
    return spark.createDataFrame(rows, "source string, lang string, topic int, n double")


@pytest.mark.parametrize("seed", range(3))
def test_raking_against_the_full_array(spark, seed):
    pick = np.random.default_rng(seed)
    tokens = pick.integers(50, 100, (4, 3, 5)).astype(float)
    tokens[1, 1] = 0
    targets = [pick.uniform(0.8, 1.2, n) for n in tokens.shape]
    names = (lambda k: f"s{k}", lambda k: f"l{k}", int)
    given = {m: {name(k): v for k, v in enumerate(t)} for m, name, t in zip(mixing.MARGINS, names, targets)}
    cells = cells_of(spark, tokens)
    goals = mixing.margin_goals(cells, given)
    got = {(r.source, r.lang, r.topic): r.taken for r in mixing.raked(cells, goals, 0.5).collect()}
    want = plain(tokens, targets, 0.5)
    assert all(abs(got[f"s{i}", f"l{j}", k] - v) < 1e-3 * tokens.sum() for (i, j, k), v in np.ndenumerate(want))
    have = np.array([got[f"s{i}", f"l{j}", k] for (i, j, k), _ in np.ndenumerate(tokens)]).reshape(tokens.shape)
    assert (have <= tokens + 1e-9).all() and have.sum() == pytest.approx(tokens.sum() * 0.5, rel=1e-4)


def test_thousands_of_sources_each_for_itself(spark):
    pick = np.random.default_rng(9)
    size = np.concatenate(([200_000.0], pick.integers(5, 60, 4999)))  # a hot source and a long tail far below 1/4096
    rows = [(f"s{i}", f"l{j}", 0, float(max(1, n // 2))) for i, n in enumerate(size) for j in range(2)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic int, n double").repartition(4)
    targets = {"source": {f"s{i}": 1.0 for i in range(5000)}}
    goals = mixing.margin_goals(cells, targets)
    budget = mixing.scarcest(goals) * 0.95
    taken = mixing.raked(cells, goals, budget).toPandas().groupby("source").taken.sum()
    assert len(taken) == 5000 and np.allclose(taken / taken.sum(), 1 / 5000, rtol=1e-3)


def test_small_sources_with_targets_are_drawn(spark):
    rows = [(k, f"word{k % 13} and more words for {k}", "en", "big") for k in range(6000)]
    rows += [(10_000 + k, f"small text {k} of few", "en", f"tiny{k % 5}") for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    targets = {"source": {"big": 0.9} | {f"tiny{k}": 0.02 for k in range(5)}}
    got = mixing.weights(docs, targets).where("source <> 'big'").collect()
    assert len(got) == 10 and all(r.probability > 0.05 and r.weight > 5 for r in got)


def test_whole_table(spark):
    docs = spark.read.parquet(str(DATA / "sf0.1" / "documents.parquet"))
    rows = mixing.weights(docs).toPandas()
    assert len(rows) == docs.count() and rows.probability.between(0, 1).all()
    cells = rows.groupby(["source", "lang", "topic"]).agg(n=("n_tokens", "sum"), p=("probability", "first"), kinds=("probability", "nunique"))
    assert (cells.kinds == 1).all()
    for name in ("source", "lang", "topic"):
        share = cells.n.groupby(level=name).sum()
        goal = (share / share.sum()) ** mixing.TEMPER
        have = (cells.n * cells.p).groupby(level=name).sum()
        assert np.allclose(have / have.sum(), goal / goal.sum(), rtol=5e-3)
    expected = (rows.n_tokens * rows.probability).sum()
    assert rows.n_tokens[rows.sampled].sum() == pytest.approx(expected, rel=0.03)
    assert expected > 0.4 * rows.n_tokens.sum()


def test_given_targets_nulls_and_clashing_names(spark):
    rows = [(k, f"word{k % 7} and more {k}", "en" if k % 2 else None, "ab"[k % 2], 1.0) for k in range(200)]
    rows += [(None, None, None, None, None), (7, "same", "en", "a", 1.0), (7, "same", "en", "a", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, weight double").withColumnRenamed("weight", "topic")
    assert mixing.weights(docs.drop("topic"), {"source": {"a": 1.0}}).where("source = 'b' AND probability > 0 AND n_tokens > 0").count() == 0
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns and 100 < kept.count() <= 203
    drawn = mixing.weights(docs).where("sampled")
    assert sorted(map(str, (r.doc_id for r in drawn.collect()))) == sorted(map(str, (r.doc_id for r in kept.collect())))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")
    assert mixing.weights(docs).collect() == [] and mixing.mixed(docs).collect() == []
