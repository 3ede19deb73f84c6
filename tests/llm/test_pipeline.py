from __future__ import annotations

import re

import numpy as np
import pytest

import corpus_pipeline
from conftest import DATA
from silverlode.llm import quality
from test_order_minhash import lcs, plain_kmers
from test_paragraphs import brute_repeats as without_passages

FOLDER = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def _texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    assert all(s.columns == stages[0].columns and s.dtypes == stages[0].dtypes for s in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5


def test_classifier_takes_its_decisions(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows, model = quality.learnt(stages[0], labels)
    accepted = {r.doc_id for r in quality.scored(rows, model).where("score >= 0.3").collect()}
    assert set(_texts(stages[1])) == accepted and len(accepted) < stages[0].count()


def test_one_of_each_class_stays(stages):
    texts = _texts(stages[1])
    ids = sorted(texts)
    grams = {k: plain_kmers(texts[k]) for k in ids}
    sets = {k: set(grams[k]) for k in ids}
    label = {k: k for k in ids}
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = len(grams[i]), len(grams[j])
            if texts[i] != texts[j]:
                if not a or not b or min(a, b) < 0.8 * max(a, b) or len(sets[i] & sets[j]) < 0.8 * max(a, b):
                    continue
                n_common = lcs(grams[i], grams[j])
                if n_common / (a + b - n_common) < 0.8:
                    continue
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label = {k: new if v == old else v for k, v in label.items()}
    assert set(_texts(stages[2])) == set(label.values())


def test_passages_go(stages):
    before = sorted(_texts(stages[2]).items())
    want = without_passages(before)
    assert _texts(stages[3]) == {k: t for (k, _), t in zip(before, want)}
    assert all(r.n_chars == len(r.text) or r.text == dict(before)[r.doc_id] for r in stages[3].collect())


def test_sample_is_part_of_its_input(stages):
    before, after = _texts(stages[3]), _texts(stages[4])
    assert 0.3 * len(before) < len(after) <= len(before) and all(before[k] == t for k, t in after.items())


def test_packing_holds_every_document(stages):
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == set(_texts(stages[4]))
    used: dict[int, int] = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 4096 and len(used) <= int(np.ceil(sum(used.values()) / 4096)) + 1


def test_run_is_the_stages_in_turn(spark, stages):
    got = sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in stages[5].collect())


def test_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "w " * 3000, None, "s", 6000), (3, re.sub("", " ", "abc"), "en", None, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([(2, 1, 0), (3, 0, 0), (1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for part in (docs, docs.limit(0)):
        now = part
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path))
        now.collect()
