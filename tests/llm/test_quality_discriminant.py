from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest import DATA
from silverlode.llm import quality
from silverlode.llm.buffers import text_buffer
from silverlode.llm.queries import QUERIES


def test_statistics_of_plain_texts():
    rows = quality.statistics(*text_buffer(pa.array(["The cat sat. The cat sat!", None, "", "AA BB\nAA BB", "é"])))
    at = {n: k for k, n in enumerate(quality.NAMES)}
    assert rows.shape == (5, len(quality.NAMES)) and np.isfinite(rows).all()
    assert rows[0, at["log_words"]] == pytest.approx(np.log1p(6)) and rows[0, at["distinct_words"]] == pytest.approx(0.5)
    assert rows[0, at["top_word"]] == pytest.approx(np.sqrt(2 / 6)) and rows[0, at["distinct_pairs"]] == pytest.approx(3 / 5)
    assert rows[3, at["upper_words"]] == 1 and rows[3, at["log_lines"]] == pytest.approx(np.log1p(2))
    assert (rows[1] == rows[2]).all()


def test_score_is_the_log_density_difference():
    pick = np.random.default_rng(1)
    x = np.concatenate((pick.normal(0, 1, (400, 29)), pick.normal(0.7, 2, (900, 29))))
    y = np.repeat([0, 1], [400, 900])
    model = quality.Discriminant.fit_rows(x, y, 0.05)
    z = (x - model.centre) / model.unit
    want = []
    for k in (0, 1):
        inverse = model.factor[k].T @ model.factor[k]
        d = z - model.mean[k]
        want.append(-0.5 * (np.einsum("ij,jk,ik->i", d, inverse, d) - np.linalg.slogdet(inverse)[1]))
    odds = want[1] - want[0] + np.log(900 / 400)
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-np.clip(odds, -500, 500))))


def test_held_out_accuracy(spark):
    folder = str(DATA / "sf0.1")
    got = QUERIES["op9_quality_discriminant"](spark, folder)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    test = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in test]) > 0.98


def test_nulls_and_clashing_names(spark):
    rows = [(1, "word " * 30, 0.5), (1, "word " * 30, 0.5), (None, None, None), (2, "#" * 90, 1.0), (3, "", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (None, 1), (3, 7)], "doc_id bigint, quality int")
    got = quality.score_documents(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    _, model = quality.learnt(docs, labels)
    assert quality.accepted(docs, model, 0.0).count() == 5 and quality.accepted(docs, model).columns == docs.columns


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.score_documents(docs, labels).collect() == []
