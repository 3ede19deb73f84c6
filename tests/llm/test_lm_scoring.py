from __future__ import annotations

import math
from collections import Counter

import pytest

from conftest import DATA
from silverlode.llm import lm_scoring
from silverlode.llm.queries import QUERIES


def brute(texts, wanted):
    def symbols(t):
        return [int(lm_scoring._OF_BYTE[b]) for b in (t or "").encode()]

    nl, size = int(lm_scoring._OF_BYTE[10]), lm_scoring.SYMBOLS
    grams = []
    for t in texts:
        s = [nl, nl, *symbols(t)]
        grams.append([tuple(s[k : k + 3]) for k in range(len(s) - 2)])

    def model(chosen):
        c = Counter(g for own in chosen for g in own)
        c2, c1, h3, h2 = Counter(), Counter(), Counter(), Counter()
        for (a, b, z), n in c.items():
            c2[b, z] += n
            c1[z] += n
            h3[a, b] += n
            h2[b] += n
        total = sum(c1.values())
        w0, w1, w2, w3 = lm_scoring.WEIGHTS

        def loss(g):
            a, b, z = g
            p = w0 / size
            p += w1 * (c1[z] / total if total else 1 / size)
            p += w2 * (c2[b, z] / h2[b] if h2[b] else 1 / size)
            p += w3 * (c[g] / h3[a, b] if h3[a, b] else 1 / size)
            return -math.log(p)

        return loss

    target, background = model([g for g, w in zip(grams, wanted) if w]), model(grams)
    return [
        (len(own), *(sum(map(f, own)) / max(1, len(own)) for f in (target, background))) for own in grams
    ]


def test_against_a_plain_model(spark):
    texts = ["The cat sat.\nOn a mat, 12 times", "Élan vital — ünd", None, "", "a", "ab", "THE CAT!!! " * 30, "The cat sat.\nOn a mat, 12 times"]
    wanted = [k in (0, 1, 5) for k in range(len(texts))]
    docs = spark.createDataFrame([(k, t, True) for k, t in enumerate(texts)], "doc_id bigint, text string, wanted boolean")
    good = spark.createDataFrame([(0,), (1,), (5,), (5,), (None,), (99,)], "doc_id bigint")
    got = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(docs, good).collect()}
    for k, (n, target, background) in enumerate(brute(texts, wanted)):
        r = got[k]
        assert r.n_tokens == n and r.target_loss == pytest.approx(target, rel=1e-4) and r.background_loss == pytest.approx(background, rel=1e-4)
        assert r.difference == pytest.approx(target - background, abs=1e-4)


def test_good_documents_score_lower(spark):
    folder = str(DATA / "sf0.01")
    rows = QUERIES["op4_cross_entropy_difference"](spark, folder).toPandas().set_index("doc_id").difference
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id").quality
    both = labels.to_frame("quality").join(rows)
    assert both.difference[both.quality == 1].mean() < both.difference[both.quality == 0].mean()


def test_empty_and_repeated(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm_scoring.cross_entropy_difference(none, none).collect() == []
    rows = spark.createDataFrame([(None, "abc"), (1, "abc"), (1, "abc")], "doc_id bigint, text string")
    got = lm_scoring.cross_entropy_difference(rows, none).collect()
    assert len(got) == 3 and len({r.background_loss for r in got}) == 1


def test_query_scores_words_against_a_plain_model(spark, tmp_path):
    texts = ["the cat sat on the mat", "The cat sat; the cat ran", "on the mat sat the cat", None, "", "mat", "a dog ran on the mat"]
    docs = [(k, t) for k, t in enumerate(texts)] + [(6, texts[6]), (None, "the cat")]
    good = {0, 1, 5}
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, int(k in good), 0) for k in range(7)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    split = [(t or "").lower().replace(";", "").split() for _, t in docs]
    grams = [list(zip(["", "", *w], ["", *w], w)) for w in split]
    size = len({w for own in split for w in own})

    def model(chosen):
        c3 = Counter(g for own in chosen for g in own)
        c2, c1, h3, h2 = Counter(), Counter(), Counter(), Counter()
        for (a, b, z), n in c3.items():
            for c, k in ((c2, (b, z)), (c1, z), (h3, (a, b)), (h2, b)):
                c[k] += n
        share = lambda c, h: c / h if h else 1 / size
        w0, w1, w2, w3 = lm_scoring.WEIGHTS
        return lambda a, b, z: -math.log(
            w0 / size + w1 * share(c1[z], sum(c1.values())) + w2 * share(c2[b, z], h2[b]) + w3 * share(c3[a, b, z], h3[a, b])
        )

    models = model([g for (k, _), g in zip(docs, grams) if k in good]), model(grams)
    want = sorted((-1 if k is None else k, len(g), *(sum(m(*x) for x in g) / max(1, len(g)) for m in models)) for (k, _), g in zip(docs, grams))
    rows = QUERIES["op4_cross_entropy_difference"](spark, str(tmp_path)).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.target_loss, r.background_loss) for r in rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(g[2:] == pytest.approx(w[2:]) for g, w in zip(got, want))
    assert all(r.difference == pytest.approx(r.target_loss - r.background_loss) for r in rows)


def test_slices_of_trigrams_are_a_partition_by_middle_word(spark, monkeypatch):
    texts = ["a b c a b d e", "", None, "b", "x y z x y z x y", "a b c a b d e"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = docs.selectExpr("doc_id AS doc_key", "doc_id % 2 = 0 AS wanted", "coalesce(text, '') AS text")
    whole = sorted(map(tuple, lm_scoring.word_trigrams(rows).collect()))
    parts = [lm_scoring.word_trigrams(rows, k, 3).collect() for k in range(3)]
    assert sorted(tuple(r) for p in parts for r in p) == whole
    middles = [{r["b"] for r in p} for p in parts]
    assert sum(len(m) for m in middles) == len(set().union(*middles)) and sum(1 for m in middles if m) > 1
    found = {}
    for slices in (1, 5):
        monkeypatch.setattr(lm_scoring, "SLICES", slices)
        found[slices] = sorted(map(tuple, lm_scoring.word_cross_entropy_difference(docs, docs.where("doc_id < 2").select("doc_id")).collect()))
    for one, five in zip(found[1], found[5]):
        assert one[:2] == five[:2] and one[2:] == pytest.approx(five[2:])


def test_a_common_pair_is_one_entry_a_batch_and_batches_do_not_show(spark, monkeypatch):
    texts = [f"of the {w} of the {w}{k % 3} of the" for k in range(40) for w in ("a", "b")] + ["", None, "of the"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    good = docs.where("doc_id % 3 = 0").select("doc_id")
    whole = sorted(map(tuple, lm_scoring.word_cross_entropy_difference(docs, good).collect()))
    monkeypatch.setattr(lm_scoring, "TOKENS", 50)
    monkeypatch.setattr(lm_scoring, "RANGE_TOKENS", 100)
    monkeypatch.setattr("silverlode.llm.lm_scoring.groups", lambda offsets: ((k, k + 1) for k in range(len(offsets) - 1)))
    rows = docs.selectExpr("doc_id", "doc_id % 3 = 0 AS wanted", "text")
    batches = lm_scoring.stored(lm_scoring.word_batches(rows), "batches")
    many = batches.count()
    sent = lm_scoring.counted_elsewhere(batches, "short", 1).collect()
    pairs = len({g for t in texts for w in [["", *(t or "").split()]] for g in zip(w, w[1:])})
    names = len({w for t in texts for w in (t or "").split()}) + 1
    assert many > 5 and len(sent) == many and all(r.n_keys <= pairs + names + 1 for r in sent)
    assert sum(r.n_words for r in sent) == names
    cut = sorted(map(tuple, lm_scoring.word_cross_entropy_difference(docs, good).collect()))
    assert [r[:2] for r in cut] == [r[:2] for r in whole]
    assert all(a[2:] == pytest.approx(b[2:]) for a, b in zip(cut, whole))
