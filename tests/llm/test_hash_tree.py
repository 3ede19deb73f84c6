from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from conftest import DATA
from silverlode.llm import hash_tree
from silverlode.llm.queries import ORACLE, QUERIES


def plain(key, tree):
    """The shard of a key, one draw after the other."""
    weight = lambda n: sum(map(weight, n.values())) if isinstance(n, dict) else n
    path, node = "", tree
    while isinstance(node, dict):
        live = [n for n in sorted(node) if weight(node[n]) > 0]

        def score(n):
            u = (int(hashlib.md5(f"{'null' if key is None else key}{path}/{n}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return -math.log(u) / weight(node[n])

        name = min(live, key=score)
        path, node = f"{path}/{name}", node[name]
    return name


TREES = [
    hash_tree.standard_tree(24),
    hash_tree.grown(hash_tree.standard_tree(24)),
    hash_tree.standard_tree(1),
    {0: {0: {0: 1.0, 1: 0.0}, 1: {2: 2.5}}, 3: {7: {3: 0.0}}, 5: {4: {9: 4.0, 8: 0.5, 10: 1.0}}},
]


@pytest.mark.parametrize("tree", TREES)
def test_against_plain_descent(spark, tree):
    rows = spark.createDataFrame([(k,) for k in [*range(3000), None, -5, 2**62]], "k bigint")
    for r in hash_tree.with_shard(rows, "k", tree).collect():
        assert r.shard == plain(r.k, tree)


def counts(spark, tree, n=60_000):
    return {r.id: r.shard for r in hash_tree.with_shard(spark.range(n), "id", tree).collect()}


def test_shares_follow_weights(spark):
    tree = TREES[3]
    got = Counter(counts(spark, tree).values())
    total = 1 + 2.5 + 5.5
    for shard, weight in {0: 1, 2: 2.5, 8: 0.5, 9: 4, 10: 1}.items():
        assert abs(got[shard] / 60_000 - weight / total) < 0.01
    assert set(got) == {0, 2, 8, 9, 10}


def test_movement_stays_in_changed_subtrees(spark):
    before = hash_tree.standard_tree(24)
    one = counts(spark, before)
    larger = hash_tree.grown(before)
    for k, shard in counts(spark, larger).items():
        assert shard in (one[k], 24)
    heavier = {r: {q: dict(m) for q, m in own.items()} for r, own in before.items()}
    heavier[1][3][13] = 3.0  # region 1 holds shards 8 to 15, its rack 3 shards 12 to 15
    moved = 0
    for k, shard in counts(spark, heavier).items():
        if shard != one[k]:
            moved += 1
            assert 8 <= shard <= 15  # only into the region that grew
            assert one[k] // 8 != 1 or 12 <= shard <= 15  # inside it only into the rack that grew
            assert one[k] // 4 != 3 or shard == 13  # inside that only into the shard that grew
    assert moved
    assert all(a == b for a, b in zip(counts(spark, before, 1000).values(), one.values()))


def test_query_matches_sql(spark):
    folder = str(DATA / "sf0.001")
    assert differences(QUERIES["op12_hash_tree"](spark, folder), ORACLE["op12_hash_tree"], connect(folder)) == []


def test_cases(spark):
    rows = [(1, "ä"), (1, "ä"), (None, "x"), (2, None), (3, ""), (1, "b"), (7, "y" * 200_000)] + [(9, "hot")] * 4000
    docs = spark.createDataFrame([(*r, 5, "s", 1) for r in rows], "doc_id bigint, text string, shard int, slot string, size int")
    tree = hash_tree.standard_tree(24)
    got = hash_tree.slots(hash_tree.place(docs.repartition(5), tree, hash_tree.grown(tree))).collect()
    want = Counter((k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), plain(k, tree)) for k, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard) for r in got) == want
    by: dict = {}
    for r in got:
        by.setdefault(r.shard, []).append((r.slot, r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"]))
    for own in by.values():
        own.sort()
        assert [s[0] for s in own] == list(range(len(own)))
        assert [s[1:] for s in own] == sorted(s[1:] for s in own)


def test_empty_and_no_python(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    tree = hash_tree.standard_tree(24)
    result = hash_tree.slots(hash_tree.place(docs, tree))
    assert result.collect() == []
    placed = hash_tree.place(spark.range(5).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), tree, hash_tree.grown(tree))
    plan = placed._jdf.queryExecution().executedPlan().toString() + result._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan
    with pytest.raises(ValueError, match="weight"):
        hash_tree.with_shard(docs, "doc_id", {0: {0: {0: 0.0}}})
