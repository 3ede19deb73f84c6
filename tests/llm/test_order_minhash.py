from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from silverlode.llm import order_minhash as om
from silverlode.llm.buffers import text_buffer
from silverlode.llm.links import components
from silverlode.llm.pairs import kmers


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


@pytest.mark.parametrize("seed", range(60))
def test_similarity_is_the_best_alignment(seed):
    pick = np.random.default_rng(seed)
    a = pick.choice(1000, pick.integers(1, 60), replace=False).astype(np.uint64)
    b = list(a)
    for _ in range(pick.integers(0, 6)):
        k = int(pick.integers(0, len(b)))
        if pick.random() < 0.5 and len(b) > 1:
            b.pop(k)
        else:
            b.insert(k, np.uint64(2000 + pick.integers(0, 10**6)))
    if seed % 4 == 0:
        b = b[len(b) // 8 :] + b[: len(b) // 8]
    b = np.array(list(dict.fromkeys(b)), np.uint64)
    aligned = lcs(a.tolist(), b.tolist())
    true = aligned / (len(a) + len(b) - aligned)
    assert (om.similarity(a, b) >= 0.8) == (true >= 0.8)
    if true >= 0.8:
        assert om.similarity(a, b) == true


def plain_kmers(text):
    import re

    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []
    seen: dict = {}
    out = []
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
        out.append((g, seen[g]))
    return out


def _corpus(seed):
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choices("abcdeéf", k=pick.randint(2, 7))) for _ in range(300)]
    texts = []
    for _ in range(25):
        base = pick.choices(vocabulary, k=pick.randint(3, 120))
        texts.append(" ".join(base))
        for _ in range(pick.randint(0, 5)):
            copy = list(base)
            for _ in range(pick.randint(0, 4)):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            texts.append(" ".join(copy).capitalize() + ".")
    return [*texts, "", None, "", "...", "one", "One!", texts[0]]


@pytest.mark.parametrize("seed", [0, 1])
def test_classes_against_all_pairs(spark, seed):
    texts = _corpus(seed)
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id bigint, text string, key int")
    got = {r.doc_id: (r.class_id, r.kept) for r in om.near_duplicates(docs).collect()}
    grams = [plain_kmers(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            n = lcs(grams[i], grams[j])
            same = (texts[i] or "") == (texts[j] or "")
            if same or (n and n / (len(grams[i]) + len(grams[j]) - n) >= 0.8):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    assert {k: c for k, (c, _) in got.items()} == dict(enumerate(label))
    assert {k for k, (_, kept) in got.items() if kept} == set(label)


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "x y"), (4, "x y"), (None, None)]
    got = om.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0, r.kept) for r in got) == [(0, 0, False), (0, 0, True), (0, 0, True), (4, 4, False), (4, 4, True)]


def test_empty(spark):
    assert om.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_kmers_do_not_cross_rows():
    data, offsets = text_buffer(pa.array(["a b", "c d", None, "a b"]))
    grams, begins = kmers(data, offsets)
    assert begins.tolist() == [0, 1, 2, 2, 3] and grams[0] == grams[2] != grams[1]


def test_components(spark):
    pick = random.Random(3)
    edges = [(pick.randrange(400), pick.randrange(400)) for _ in range(330)] + [(k, k + 1) for k in range(1000, 1100)] + [(None, 4), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)).collect()}
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    assert got == {x: root(x) for x in parent}


@pytest.mark.parametrize("words", [60, 420])
def test_large_groups_in_small_tiles(spark, monkeypatch, words):
    """Near copies of short texts and of texts over 256 k-mers, in buckets of many slices; most pairs of a group are below the threshold."""
    from silverlode.llm import pairs

    monkeypatch.setattr(pairs, "TILE", 16)
    pick = random.Random(words)
    vocabulary = ["".join(pick.choices("abcdefgh", k=6)) for _ in range(2000)]
    texts = []
    for _ in range(3):
        base = pick.choices(vocabulary, k=words)
        for k in range(70):
            copy = list(base)
            for _ in range(max(1, int(words * pick.choice((0.004, 0.012, 0.02))))):
                copy[pick.randrange(words)] = pick.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [" ".join(pick.choices(vocabulary, k=words)) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r.class_id for r in om.near_duplicates(docs).collect()}
    data, offsets = text_buffer(pa.array(texts))
    grams, begins = kmers(data, offsets)
    own = [grams[a:b] for a, b in zip(begins[:-1], begins[1:])]
    label = list(range(len(texts)))
    near = [(i, j) for i in range(len(own)) for j in range(i) if om.similarity(own[i], own[j]) >= 0.8]
    for i, j in near:
        old, new = max(label[i], label[j]), min(label[i], label[j])
        label = [new if x == old else x for x in label]
    found = sum(got[i] == got[j] for i, j in near)
    assert near and found >= 0.99 * len(near)
    assert all(label[k] == label[c] for k, c in got.items())  # no class joins what no links join
