from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from silverlode.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


def _bins(counts, capacity):
    segments = packing.plan(counts, capacity)
    placed = {}
    for size, rank, items, sequence, each, offset in segments.tolist():
        for k in range(items):
            placed[size, rank + k] = (sequence + k // each, offset + k % each * size)
    return placed


def _exact(items, capacity):
    """The fewest bins by search, for small instances."""
    best = len(items)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= items[k] and rooms[i] not in rooms[:i]:
                go(k + 1, [*rooms[:i], rooms[i] - items[k], *rooms[i + 1 :]])
        go(k + 1, [*rooms, capacity - items[k]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_reduction_keeps_the_optimum(seed):
    pick = random.Random(seed)
    capacity = 20
    items = sorted((pick.randint(1, 20) for _ in range(9)), reverse=True)
    counts = {s: items.count(s) for s in set(items)}
    fixed, rest = packing.reduced(counts, capacity)
    remaining = sorted((s for s, n in rest.items() for _ in range(n)), reverse=True)
    assert sum(t for _, t in fixed) + _exact(remaining, capacity) == _exact(items, capacity)


@pytest.mark.parametrize("seed", range(10))
def test_plan_places_every_item_once_without_gaps(seed):
    pick = np.random.default_rng(seed)
    counts = {int(s): int(pick.integers(1, 50)) for s in pick.choice(np.arange(1, 101), 30, replace=False)}
    placed = _bins(counts, 100)
    assert set(placed) == {(s, k) for s, n in counts.items() for k in range(n)}
    by_bin: dict[int, list] = {}
    for (size, _), (sequence, offset) in placed.items():
        by_bin.setdefault(sequence, []).append((offset, size))
    for content in by_bin.values():
        end = 0
        for offset, size in sorted(content):
            assert offset == end
            end += size
        assert end <= 100


def test_documents(spark):
    rows = [(1, "One two three.", "x"), (2, None, "x"), (2, None, "x"), (None, "", None), (5, "word " * 50, "x"), (6, "Éa b\nc" * 9, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length string")
    got = packing.pack_documents(docs, WORDS, 1, 16).collect()
    tool = Tokenizer.from_file(WORDS)
    want = []
    for key, text, _ in rows:
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 16):
            part = np.array(ids[at : at + 16], "<u4")
            want.append((key, at // 16, at, len(part), zlib.crc32(part.tobytes())))
    order = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(want, key=order)
    by_bin: dict[int, list] = {}
    for r in got:
        by_bin.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for content in by_bin.values():
        content.sort()
        assert [o for o, _ in content] == [sum(n for _, n in content[:k]) for k in range(len(content))]
        assert sum(n for _, n in content) <= 16


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack_documents(docs, WORDS, 1).collect() == []


def test_clashing_names(spark):
    rows = spark.createDataFrame([(3, 5, 6), (4, 5, 6)], "length int, sequence_id int, offset int")
    got = packing.pack(rows, 8)
    assert got.columns == ["length", "sequence_id", "offset", "sequence_id_", "offset_"]
    assert len({r["sequence_id_"] for r in got.collect()}) == 1
