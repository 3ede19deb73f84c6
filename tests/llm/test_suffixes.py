from __future__ import annotations

import random
from collections import defaultdict

import pytest

from silverlode.llm import suffixes


def brute(texts, length):
    places = defaultdict(list)
    for k, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            places[t[s : s + length]].append((k, s))
    keep = [bytearray(b"\1" * len(t)) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for k, s in found:
                keep[k][s : s + length] = b"\0" * length
    out = []
    for t, flags in zip(texts, keep):
        runs = sum(1 for i, f in enumerate(flags) if not f and (i == 0 or flags[i - 1]))
        out.append((len(t), flags.count(0), runs, bytes(b for b, f in zip(t, flags) if f)))
    return out


def _texts(seed):
    pick = random.Random(seed)
    alphabet = "ab" if seed % 3 == 0 else "abcdefgh é\n"
    passages = ["".join(pick.choices(alphabet, k=pick.randint(15, 90))) for _ in range(6)]
    texts = []
    for _ in range(40):
        parts = [pick.choice(passages) if pick.random() < 0.5 else "".join(pick.choices(alphabet, k=pick.randint(0, 60))) for _ in range(pick.randint(0, 5))]
        t = list("".join(parts))
        if t and pick.random() < 0.4:
            t[pick.randrange(len(t))] = "z"
        texts.append("".join(t))
    return [*texts, "", "x" * 300, "ab" * 150, texts[3], texts[3]]


@pytest.mark.parametrize("seed,length", [(0, 20), (1, 40), (2, 64), (3, 45)])
def test_against_all_windows(spark, seed, length):
    texts = _texts(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in suffixes.remove_repeats(docs, length).collect()}
    for k, (n, removed, runs, kept) in enumerate(brute([t.encode() for t in texts], length)):
        r = got[k]
        assert (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans)) == (n, removed, runs), k
        assert (texts[k].encode() if r.kept is None else bytes(r.kept)) == kept


def test_nulls_repeated_rows_and_clashing_names(spark):
    rows = [(1, "p" * 10 + "0123456789" * 3, "k"), (1, "p" * 10 + "0123456789" * 3, "k"), (None, None, "k"), (None, "q0123456789", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key string")
    got = suffixes.remove_repeats(docs, 20).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, sum(s.end - s.start for s in r.spans)) for r in got) == [(0, 0, 0), (0, 11, 0), (1, 40, 40), (1, 40, 40)]


def test_empty(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string"), 20).collect() == []
