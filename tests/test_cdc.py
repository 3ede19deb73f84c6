from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverlode.operators import cdc
from silverlode.operators.skew import add_slices
from silverlode.sources.files import read_change_feed
from silverlode.sources.storage import Snapshots
from silverlode.streaming import changes as streams

DDL = "name string, address string, email string, id long, operation string, operation_date timestamp"
SILVER = "id long, name string, address string, email string, operation_date timestamp"
FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def at(minute: int) -> datetime:
    return datetime(2022, 1, 1, 10, minute)


def table(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_merge_cases(spark):
    target = spark.createDataFrame(
        [(1, "a", "x", "a@x", at(0)), (2, "b", "x", "b@x", at(0)), (3, "c", "x", "c@x", at(0))], SILVER
    )
    changes = spark.createDataFrame(
        [
            ("a1", "y", "a@x", 1, "UPDATE", at(1)),
            ("a2", "y", "a@x", 1, "UPDATE", at(2)),
            (None, None, None, 2, "DELETE", at(1)),
            ("ignored", "y", "c@x", 3, None, at(1)),
            ("new", "y", "d@x", 4, "APPEND", at(1)),
            (None, None, None, 9, "DELETE", at(1)),
        ],
        DDL,
    )
    merged = cdc.merge_changes(target, changes, ["id"], "operation = 'DELETE'", "operation_date")
    assert table(merged, "id", "name") == [(1, "a2"), (3, "c"), (4, "new")]
    upserted = cdc.merge_changes(target, changes, ["id"], "operation = 'DELETE'", "operation_date", null_operation="upsert")
    assert table(upserted, "id", "name") == [(1, "a2"), (3, "ignored"), (4, "new")]


def test_merge_without_sequence_refuses_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a")], "id long, name string")
    changes = spark.createDataFrame([(1, "b", "U"), (1, "c", "U")], "id long, name string, operation string")
    with pytest.raises(Exception, match="more than one source row"):
        cdc.merge_changes(target, changes, ["id"], "operation = 'D'").collect()
    with pytest.raises(Exception, match="more than one source row"):
        cdc.upsert_columns(target, changes, ["id"], {"name": "name"}, {"id": "id"}).collect()


def test_null_keys_and_sequences_are_set_apart(spark):
    rows = [(1, 5, "a"), (None, 6, "b"), (2, None, "c")]
    changes = spark.createDataFrame(rows, "id int, seq int, v string")
    assert table(cdc.latest_per_key(changes, ["id"], "seq"), "id", "v") == [(1, "a")]
    assert table(cdc.apply_changes_scd2(changes, ["id"], "seq"), "id", "v") == [(1, "a")]
    assert table(cdc.unusable(changes, ["id"], "seq"), "v") == [("b",), ("c",)]


def test_map_columns_survive(spark):
    changes = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2})], "id int, seq int, m map<string,int>")
    assert cdc.latest_per_key(changes, ["id"], "seq").collect()[0].m == {"b": 2}


def test_update_with_null_flag_is_no_delete(spark):
    rows = [(1, "a", 1, at(0)), (1, "b", None, at(1)), (2, "c", 1, at(0)), (2, "c", 0, at(2))]
    events = spark.createDataFrame(rows, "id int, name string, active int, update_dt timestamp")
    current = cdc.apply_changes_scd1(events, ["id"], "update_dt", "active = 0", except_columns=["active"])
    assert table(current, "id", "name") == [(1, "b")]


def test_feed_kinds_and_propagation(spark):
    before = spark.createDataFrame([(1, 'x "q"'), (2, "b"), (3, None)], "id int, address string")
    after = spark.createDataFrame([(2, 'b "q"'), (3, None), (4, 'd "q"')], "id int, address string")
    feed = cdc.snapshot_diff(before, after, ["id"], 5)
    assert table(feed, "id", "change_type") == [
        (1, "delete"), (2, "update_postimage"), (2, "update_preimage"), (4, "insert"),
    ]
    gold = cdc.propagate_changes(before, feed, ["id"], {"address": "regexp_replace(address, '\"', '')"})
    assert table(gold) == [(2, "b q"), (3, None), (4, "d q")]


def test_feed_of_several_versions_takes_the_newest(spark):
    rows = [
        (1, "a", "insert", 1), (1, "a", "update_preimage", 2), (1, "b", "update_postimage", 2),
        (1, "b", "delete", 3), (1, "c", "insert", 3), (2, "z", "insert", 1), (2, "z", "delete", 2),
    ]
    feed = spark.createDataFrame(rows, "id int, v string, change_type string, commit_version long")
    gold = cdc.propagate_changes(spark.createDataFrame([], "id int, v string"), feed, ["id"])
    assert table(gold) == [(1, "c")]


CHANGES = st.lists(
    st.tuples(st.integers(1, 4), st.integers(0, 12), st.sampled_from("abc"), st.booleans()), min_size=1, max_size=25
)


def brute_scd2(rows):
    newest = {}
    for key, seq, v, gone in rows:
        newest[(key, seq)] = max(newest.get((key, seq), (v, gone)), (v, gone))
    out = []
    for (key, seq), (v, gone) in newest.items():
        later = [s for k, s in newest if k == key and s > seq]
        if not gone:
            out.append((key, v, seq, min(later) if later else None))
    return sorted(out, key=repr)


@FEW
@given(CHANGES, st.randoms())
def test_scd_forms_agree(spark, rows, random):
    schema = "k int, seq int, v string, gone boolean"
    shuffled = list(rows)
    random.shuffle(shuffled)
    changes = spark.createDataFrame(shuffled, schema)
    want = brute_scd2(rows)
    plain = cdc.apply_changes_scd2(changes, ["k"], "seq", "gone")
    assert table(plain, "k", "v", "start_at", "end_at") == want
    sliced = cdc.apply_changes_scd2(changes, ["k"], "seq", "gone", hot_keys=True, share=0.1)
    assert table(sliced, "k", "v", "start_at", "end_at") == want
    current = [(k, v) for k, v, _, end in want if end is None]
    assert table(cdc.apply_changes_scd1(changes, ["k"], "seq", "gone"), "k", "v") == current
    half = len(shuffled) // 2
    log = spark.createDataFrame(shuffled[:half], schema)
    old = cdc.apply_changes_scd2(log, ["k"], "seq", "gone")
    again = cdc.refresh_scd2(old, changes, spark.createDataFrame(shuffled[half:], schema), ["k"], "seq", "gone")
    assert table(again, "k", "v", "start_at", "end_at") == want


SNAPSHOT = st.dictionaries(st.integers(1, 6), st.sampled_from(["a", "b", None]), max_size=6)


@FEW
@given(SNAPSHOT, SNAPSHOT)
def test_applying_a_diff_gives_the_new_snapshot(spark, a, b):
    before = spark.createDataFrame(list(a.items()), "id int, v string")
    after = spark.createDataFrame(list(b.items()), "id int, v string")
    feed = cdc.snapshot_diff(before, after, ["id"], 1)
    assert table(cdc.propagate_changes(before, feed, ["id"])) == table(after)


def test_one_key_with_most_rows(spark):
    """A heavy key is cut into ranges, and copies of its rows collapse."""
    rows = spark.range(40000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("seq"), F.lit("v").alias("v")
    )
    twice = rows.unionByName(rows)
    plain = cdc.apply_changes_scd2(twice, ["k"], "seq")
    sliced = cdc.apply_changes_scd2(twice, ["k"], "seq", hot_keys=True, share=0.01)
    assert plain.count() == sliced.count() == 40000
    assert plain.exceptAll(sliced).count() == 0
    slices = add_slices(rows, ["k"], "seq", 0.01)
    assert len(slices.heavy) == 1 and not slices.copies
    sizes = [r["count"] for r in slices.rows.where("k = -1").groupBy("_slice").count().collect()]
    assert len(sizes) > 50 and max(sizes) < 3 * 26667 / len(sizes)


def test_one_pair_with_most_rows(spark):
    """Re-delivered copies of one change, a third of all rows, are combined before they meet."""
    rows = spark.range(9000).selectExpr("IF(id % 2 = 0, -1, id) AS k", "IF(id % 3 = 0, 0, id) AS seq", "'v' AS v")
    assert add_slices(rows, ["k"], "seq", 0.01).copies
    plain = cdc.apply_changes_scd2(rows, ["k"], "seq")
    sliced = cdc.apply_changes_scd2(rows, ["k"], "seq", hot_keys=True, share=0.01)
    assert table(plain) == table(sliced) and plain.where("k = -1 AND seq = 0").count() == 1


def stream_of(spark, folder, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        yield i, spark.readStream.schema(schema).parquet(f"{folder}/in")


def test_streams_equal_batch_and_survive_reruns(spark, folder):
    schema = "k int, seq int, v string, gone boolean"
    batches = [
        [(1, 1, "a", False), (2, 1, "b", False)],
        [(1, 5, "z", True), (2, 3, "c", False)],
        [(1, 3, "late", False), (3, 1, "d", False)],
        [(2, 2, "late", False)],
    ]
    for i, stream in stream_of(spark, folder, batches, schema):
        streams.upsert_stream(stream, ["k"], "seq", f"{folder}/log", f"{folder}/c1")
        streams.stateful_upserts(stream, ["k"], "seq", f"{folder}/state", f"{folder}/c2")
        streams.merge_log_stream(stream, ["k"], "seq", "gone", f"{folder}/merge-log", f"{folder}/c5")
        streams.merge_stream(stream, f"{folder}/merged", f"{folder}/c3", "k int, v string", ["k"], "seq", "gone", f"{folder}/feed")
    want = table(cdc.apply_changes_scd1(spark.read.parquet(f"{folder}/in"), ["k"], "seq", "gone"))
    assert table(streams.upserted_table(spark, f"{folder}/log", ["k"], "seq", "gone")) == want
    assert table(streams.upserted_table(spark, f"{folder}/state", ["k"], "seq", "gone")) == want
    streams.compact_upserts(spark, f"{folder}/log", f"{folder}/compacted", ["k"], "seq")
    assert table(streams.upserted_table(spark, f"{folder}/compacted", ["k"], "seq", "gone")) == want

    merged = Snapshots(spark, f"{folder}/merged")
    assert merged.versions() == [0, 1, 2, 3, 4]
    # MERGE compares no sequences across batches: the late rows of batches 3 and 4 win.
    assert table(merged.read()) == [(1, "late"), (2, "late"), (3, "d")]
    assert table(merged.read(2)) == [(2, "c")]

    # The log form gives the same versions and the same feeds (its version is the batch id).
    for version in merged.versions()[1:]:
        logged = streams.merged_table(spark, f"{folder}/merge-log", ["k"], "gone", version - 1)
        assert table(logged, "k", "v") == table(merged.read(version))
        fed = streams.merged_feed(spark, f"{folder}/merge-log", ["k"], "gone", version - 1)
        whole = read_change_feed(spark, f"{folder}/feed", version).where(F.col("commit_version") == version)
        assert table(fed, "k", "v", "change_type") == table(whole, "k", "v", "change_type")

    feed = read_change_feed(spark, f"{folder}/feed", 1, stream=True)
    streams.propagate_stream(feed, f"{folder}/gold", f"{folder}/c4", "k int, v string", ["k"], {"v": "upper(v)"})
    assert table(Snapshots(spark, f"{folder}/gold").read()) == [(1, "LATE"), (2, "LATE"), (3, "D")]
    assert read_change_feed(spark, f"{folder}/feed", 4).select("k").distinct().count() == 1


def test_scd2_batches_in_any_order_with_replays_and_odd_rows(spark, folder):
    from itertools import permutations

    from silverlode.streaming.history import add_scd2_batch, compact_scd2, scd2_quarantine, scd2_table

    kind = "k long, seq long, v string, gone boolean"
    batches = [
        [(1, 10, "a", False), (2, 5, "x", False), (None, 1, "n", False)],
        [(1, 30, "c", True), (3, None, "n", False)],
        [(1, 20, "b", False), (2, 5, "x", False), (4, 1, "q", True)],
    ]
    for n, order in enumerate(permutations(range(3))):
        root = f"{folder}/{n}"
        for batch_id, k in enumerate(order):
            for _ in range(2 if batch_id == 1 else 1):  # a replay
                add_scd2_batch(spark.createDataFrame(batches[k], kind), batch_id, root, ["k"], "seq", "gone", buckets=4)
        want = [(1, "a", 10, 20), (1, "b", 20, 30), (2, "x", 5, None)]
        got = sorted((r.k, r.v, r.start_at, r.end_at) for r in scd2_table(spark, root, ["k"]).collect())
        assert got == want
        assert scd2_quarantine(spark, root).count() == 2
    compact_scd2(spark, root, f"{folder}/compact", ["k"], 2)
    add_scd2_batch(spark.createDataFrame([(1, 15, "m", False)], kind), 3, f"{folder}/compact", ["k"], "seq", "gone", buckets=4)
    got = sorted((r.k, r.v, r.start_at, r.end_at) for r in scd2_table(spark, f"{folder}/compact", ["k"]).collect())
    assert got == [(1, "a", 10, 15), (1, "b", 20, 30), (1, "m", 15, 20), (2, "x", 5, None)]
