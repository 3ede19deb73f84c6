"""Batches in any order, replays and odd rows: schema per batch, bucketed merge, totals, bitmaps, journal, staged publishing."""

from __future__ import annotations

import itertools
import random
import time
from pathlib import Path

import duckdb
import pytest
from compare import differences
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.checks import registry
from silverlode.checks import streams as checks
from silverlode.functions import datagen
from silverlode.operators import bitmaps, layout
from silverlode.operators.quality import DROP, FAIL, ExpectationFailed, Rule
from silverlode.sources import sinks, variants
from silverlode.sources.storage import exists, names
from silverlode.streaming import buckets, history, journal, totals, writers
from silverlode.streaming import changes as streams
from silverlode.streaming.writers import append_checked, each_batch

CHANGES = "k long, seq long, v string, gone boolean"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_a_schema_grows_by_batches(spark, folder):
    steps = [
        ['{"a": 1, "n": null}', "  "],
        ['{"a": 2, "b": {"x": 1}, "z.z": true}', '{"a": "text"}', "no json", "[1]"],
        ['{"a": 1.5, "b": {"x": 2, "y": "s"}}', '{"b": 7, "n": 3}', '{"c": [{"p": 1}, {"p": 2.5, "q": "r"}]}'],
        ['{"b": {"x": 3, "y": "s"}}'],
    ]
    for i, texts in enumerate(steps):
        for _ in range(2):  # a replay
            variants.add_json_batch(lines(spark, *texts), i, f"{folder}/out", f"{folder}/schema")
    schema = variants.pinned_schema(spark, f"{folder}/schema")
    assert schema.simpleString() == "struct<a:bigint,b:struct<x:bigint,y:string>,z.z:boolean,c:array<struct<p:double,q:string>>,n:bigint>"
    assert variants.pinned_schema(spark, f"{folder}/schema", 3).simpleString() == schema.simpleString().replace(",y:string", "")
    assert variants.pinned_schema(spark, f"{folder}/schema", 1).names == ["a"]
    table = variants.evolving_table(spark, f"{folder}/out", f"{folder}/schema")
    assert rows(table, "batch_id", "a", F.to_json("b"), "`z.z`", F.to_json("c"), "n", "_rescued") == sorted(
        [
            (0, 1, None, None, None, None, None),
            (1, 2, '{"x":1}', True, None, None, None),
            (1, None, None, None, None, None, '{"a":"text"}'),
            (1, None, None, None, None, None, "no json"),
            (1, None, None, None, None, None, "[1]"),
            (2, None, '{"x":2}', None, None, None, '{"a":1.5,"b":{"x":2,"y":"s"}}'),  # b is of two kinds in this batch: it grows no field
            (3, None, '{"x":3,"y":"s"}', None, None, None, None),
            (2, None, None, None, None, 3, '{"b":7}'),
            (2, None, None, None, '[{"p":1.0},{"p":2.5,"q":"r"}]', None, '{"c":[{"p":1},{"p":2.5,"q":"r"}]}'),
        ],
        key=repr,
    )


def test_a_pinned_schema_rescues_new_columns(spark, folder):
    for i, text in enumerate(['{"a": 1}', '{"a": 2, "b": [1]}', "{}"]):
        variants.add_json_batch(lines(spark, text), i, f"{folder}/out", f"{folder}/schema", evolve=False)
    table = variants.evolving_table(spark, f"{folder}/out", f"{folder}/schema")
    assert rows(table, "a", "_rescued") == sorted([(1, None), (2, '{"b":[1]}'), (None, None)], key=repr)


def test_bucketed_merge_equals_a_plain_one(spark, folder):
    pick = random.Random(1)
    batches, state = [], {}
    for b in range(6):
        batch = {}
        for n in range(40):
            k = pick.choice([None, *range(30)])
            seq = pick.choice([None, b * 100 + n, b * 100 + n])
            batch[n] = (k, seq, f"v{b}-{n}", pick.choice([True, False, False, None]))
        batches.append(list(batch.values()))
        newest = {}
        for k, seq, v, gone in batches[-1]:
            if k is not None and seq is not None and (k not in newest or newest[k][0] < seq):
                newest[k] = (seq, v, gone)
        for k, (seq, v, gone) in newest.items():
            if gone is True:
                state.pop(k, None)
            elif gone is False:
                state[k] = (k, seq, v, False)
        frame = spark.createDataFrame(batches[-1], CHANGES)
        for _ in range(2 if b == 3 else 1):
            buckets.merge_batch(frame, b, f"{folder}/t", ["k"], "seq", "gone", buckets=2, rows_per_bucket=4, keep_batches=2)
        table = buckets.bucketed_table(spark, f"{folder}/t", ["k"], frame.schema)
        assert rows(table) == sorted(state.values(), key=repr)
    bad = sum(k is None or s is None for b in batches for k, s, _, _ in b)
    assert buckets.quarantined(spark, f"{folder}/t").count() == bad
    log = {r.batch_id: r.counts for r in journal.history(spark, f"{folder}/t").collect()}
    assert sorted(log) == list(range(6)) and log[5]["buckets"] > 2 and log[5]["rows"] == len(state)
    # Only two batches back are kept, and a bucket without rows is a bucket still.
    older = buckets.bucketed_table(spark, f"{folder}/t", ["k"], spark.createDataFrame([], CHANGES).schema, 4)
    assert older.count() == log[4]["rows"]


def test_untouched_buckets_are_not_written(spark, folder):
    first = spark.createDataFrame([(k, 1, "a", False) for k in range(200)], CHANGES)
    buckets.merge_batch(first, 0, folder, ["k"], "seq", "gone", buckets=16)
    buckets.merge_batch(spark.createDataFrame([(7, 2, "b", False)], CHANGES), 1, folder, ["k"], "seq", "gone", buckets=16)
    path = f"{folder}/table/buckets=16"
    written = [b for b in names(spark, path) if "batch_id=1" in names(spark, f"{path}/{b}")]
    counts = journal.last_batch(spark, folder, 2)["counts"]
    assert len(written) == 1 and counts["buckets_written"] == 1 and counts["rows_written"] < 40 and counts["rows"] == 200
    buckets.merge_batch(spark.createDataFrame([], CHANGES), 2, folder, ["k"], "seq", "gone", buckets=16)
    assert buckets.bucketed_table(spark, folder, ["k"], first.schema).count() == 200


def test_many_buckets_share_few_folders(spark, folder):
    def changes(keys, seq, gone=False):
        return spark.createDataFrame([(k, seq, f"{seq}", gone) for k in keys], CHANGES)

    def merge(batch, number):
        buckets.merge_batch(batch, number, folder, ["k"], "seq", "gone", buckets=2, rows_per_bucket=1, keep_batches=1)

    merge(changes(range(300), 1), 0)
    merge(changes([5, 6], 2), 1)
    merge(changes([7], 3, True), 2)
    path = f"{folder}/table/buckets=512"
    parts = names(spark, path)
    assert len([p for p in parts if p.startswith("_part=")]) <= 64
    counts = journal.last_batch(spark, folder, 3)["counts"]
    assert counts["buckets"] == 512 and counts["buckets_written"] == 1 and counts["rows"] == 299
    wanted = sorted((k, 2 if k in (5, 6) else 1, "2" if k in (5, 6) else "1", False) for k in range(300) if k != 7)
    table = buckets.bucketed_table(spark, folder, ["k"], changes([], 0).schema)
    assert sorted(map(tuple, table.collect())) == wanted
    older = buckets.bucketed_table(spark, folder, ["k"], changes([], 0).schema, 1)
    assert older.count() == 300


def test_history_reads_the_log_for_late_keys_alone(spark, folder):
    for i in range(4):
        batch = spark.createDataFrame([(k, 10 * i + 1, f"{i}", False) for k in range(8)], CHANGES)
        history.add_scd2_batch(batch, i, folder, ["k"], "seq", "gone", buckets=4)
    late = spark.createDataFrame([(3, 5, "late", False), (4, 99, "new", True)], CHANGES)
    history.add_scd2_batch(late, 4, folder, ["k"], "seq", "gone", buckets=4)
    counts = {r.batch_id: r.counts for r in journal.history(spark, folder).collect()}
    assert [counts[i]["late_keys"] for i in range(5)] == [0, 0, 0, 0, 1] and counts[4]["keys"] == 2
    got = rows(history.scd2_table(spark, folder, ["k"]).where("k IN (3, 4)"), "k", "v", "start_at", "end_at")
    assert got == sorted(
        [(3, "0", 1, 5), (3, "late", 5, 11), (3, "1", 11, 21), (3, "2", 21, 31), (3, "3", 31, None)]
        + [(4, "0", 1, 11), (4, "1", 11, 21), (4, "2", 21, 31), (4, "3", 31, 99)],
        key=repr,
    )
    assert rows(history.scd2_table(spark, folder, ["k"], 1).where("k = 3"), "v", "start_at", "end_at") == [("0", 1, 11), ("1", 11, None)]


FEED = "g string, n long, change_type string"


def test_totals_follow_changes(spark, folder):
    pick = random.Random(4)
    table, schema = [], "g string, row_count bigint, total bigint, top bigint"
    for b in range(5):
        feed = [(pick.choice(["a", "b", None]), pick.randrange(20), "insert") for _ in range(6)]
        gone = pick.sample(table, min(len(table), 4))
        changed = [x for x in table if x not in gone][:1]
        feed += [(g, n, "delete") for g, n in gone]
        feed += [row for g, n in changed for row in ((g, n, "update_preimage"), ("c", n + 1, "update_postimage"))]
        for g in gone:
            table.remove(g)
        for c in changed:
            table.remove(c)
            table.append(("c", c[1] + 1))
        table += [(g, n) for g, n, kind in feed if kind == "insert"]
        source = spark.createDataFrame(table, "g string, n long")
        for _ in range(2 if b == 2 else 1):
            totals.add_changes(spark.createDataFrame(feed, FEED), b, folder, ["g"], {"total": "n"}, {"top": "n"}, lambda s=source: s, buckets=2)
        want = rows(source.groupBy("g").agg(F.count("*"), F.sum("n"), F.max("n")))
        assert rows(totals.totals(spark, folder, schema, ["g"])) == want
    none = spark.createDataFrame([(g, n, "delete") for g, n in table], FEED)
    totals.add_changes(none, 5, folder, ["g"], {"total": "n"}, {"top": "n"}, lambda: source.limit(0), buckets=2)
    assert rows(totals.totals(spark, folder, schema, ["g"])) == []
    with pytest.raises(ValueError, match="lost its maximum"):
        totals.add_changes(spark.createDataFrame([("x", 1, "insert")], FEED), 6, folder, ["g"], {"total": "n"}, {"top": "n"}, None, 2)
        totals.add_changes(spark.createDataFrame([("x", 1, "delete"), ("x", 0, "insert")], FEED), 7, folder, ["g"], {"total": "n"}, {"top": "n"}, None, 2)


def test_bitmaps_count_and_name_missing_ids(spark):
    pick = random.Random(2)
    left = [pick.randrange(-70_000, 140_000) for _ in range(400)] + [0, 1, -1, 32767, 32768, 32769, -32768, None]
    right = pick.sample([x for x in left if x is not None], 300) + [999_999, None]
    both = [spark.createDataFrame([(x,) for x in ids], "id long") for ids in (left, right)]
    one, two = (bitmaps.bitmaps(df, "id") for df in both)
    halves = bitmaps.bitmaps(both[0].limit(250), "id").unionByName(bitmaps.bitmaps(both[0], "id"))
    known = {x for x in left if x is not None}
    assert bitmaps.distinct_ids(halves).first()[0] == len(known)
    missing = known - set(right)
    assert {r.id for r in bitmaps.missing_ids(one, two).collect()} == missing
    assert bitmaps.missing_count(one, two).first()[0] == len(missing)
    assert bitmaps.missing_count(one, one).first()[0] == 0 and bitmaps.missing_ids(one, one).count() == 0


def test_journal_finds_batches_by_time(spark, folder):
    table = f"{folder}/t"
    for i in range(3):
        journal.commit(spark, table, i, "MERGE", {"n": i})
        time.sleep(0.02)
    times = {r.batch_id: r.committed_at.astimezone() for r in journal.history(spark, table).collect()}
    journal.commit(spark, table, 1, "MERGE", {"n": 1})  # a replay keeps its time
    assert {r.batch_id: r.committed_at.astimezone() for r in journal.history(spark, table).collect()} == times
    assert [journal.batch_at(spark, table, times[i]) for i in range(3)] == [0, 1, 2]
    assert journal.last_batch(spark, table, 2)["batch_id"] == 1 and journal.last_batch(spark, f"{folder}/none", 9) is None
    with pytest.raises(ValueError, match="no batch"):
        journal.batch_at(spark, table, times[0].replace(year=2000))


def test_nothing_is_published_with_a_violation(spark, folder):
    rules = [Rule("has_id", "id IS NOT NULL", FAIL), Rule("small", "id < 10", DROP), Rule("d", "d <> 'x'")]
    good = spark.createDataFrame([(1, "a"), (20, "x")], "id long, d string")
    sinks.publish_checked(good, rules, f"{folder}/t")
    assert rows(spark.read.parquet(f"{folder}/t")) == [(1, "a")]
    bad = good.unionByName(spark.createDataFrame([(None, "b"), (None, "c")], "id long, d string"))
    with pytest.raises(ExpectationFailed, match="has_id: 2 rows"):
        sinks.publish_checked(bad, rules, f"{folder}/t")
    assert rows(spark.read.parquet(f"{folder}/t")) == [(1, "a")] and names(spark, folder) == ["t"]
    sinks.publish_checked(bad.limit(0), rules, f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 0
    for n, frame in enumerate((good, bad, good)):
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(good.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    with pytest.raises(Exception, match="has_id"):
        append_checked(stream, rules, f"{folder}/log", f"{folder}/c")
    assert exists(spark, f"{folder}/log/batch_id=0") and not exists(spark, f"{folder}/log/batch_id=1")


@pytest.mark.parametrize("axes,bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_key_steps_to_a_neighbouring_cell(spark, axes, bits):
    cells = list(itertools.product(range(1 << bits), repeat=axes))
    frame = spark.createDataFrame(cells, ", ".join(f"_b{i} int" for i in range(axes)))
    kept = frame.select("*", *[F.col(f"_b{i}").alias(f"c{i}") for i in range(axes)])
    turned = layout._hilbert_axes(kept, [f"_b{i}" for i in range(axes)], bits)
    key = layout._packed([layout._bit(F.col(f"_b{i}"), bit) for bit in range(bits - 1, -1, -1) for i in range(axes)])
    path = [tuple(r)[:axes] for r in turned.select(*[f"c{i}" for i in range(axes)], key.alias("z")).orderBy("z").collect()]
    assert sorted(path) == cells
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in itertools.pairwise(path))


def test_curves_wider_than_a_long(spark):
    pick = random.Random(5)
    data = [tuple(pick.randrange(1000) for _ in range(9)) + (None if k % 9 == 0 else f"t{k}",) for k in range(300)]
    frame = spark.createDataFrame(data, ", ".join(f"c{i} int" for i in range(9)) + ", t string")
    for curve in ("hilbert", "morton"):
        keyed = layout.with_curve_key(frame, [f"c{i}" for i in range(9)] + ["t"], 8, curve)
        assert keyed.select(F.max(F.length("_z"))).first()[0] == 10 and keyed.drop("_z").exceptAll(frame).isEmpty()
        assert rows(layout.cluster(frame, ["c0", "t"], 4, curve)) == rows(frame)
    with pytest.raises(ValueError, match="curve"):
        layout.with_curve_key(frame, ["c0"], 3, "peano")


def test_schemas_inherit_and_refer(spark):
    base = {"properties": {"id": {"type": "string"}, "kind": {"type": "string", "enum": ["x"]}}, "required": ["id"]}
    child = {"allOf": [{"$ref": "base"}, {"properties": {"n": {"$ref": "#/definitions/n"}}}], "definitions": {"n": {"type": "integer", "minimum": 1, "maximum": 3}}}
    child |= {"properties": {"kind": {"type": "string", "enum": ["y"]}}, "required": ["n"]}
    whole = datagen.resolved(child, {"base": base})
    assert list(whole["properties"]) == ["id", "kind", "n"] and whole["required"] == ["id", "n"]
    assert whole["properties"]["kind"]["enum"] == ["y"] and whole["properties"]["n"]["maximum"] == 3
    assert rows(datagen.generate(spark, child, 20, documents={"base": base}).select("kind").distinct()) == [("y",)]
    with pytest.raises(ValueError, match="back to itself"):
        datagen.resolved({"allOf": [{"$ref": "a"}]}, {"a": {"allOf": [{"$ref": "b"}]}, "b": {"$ref": "a"}})
    with pytest.raises(ValueError, match="back to itself"):
        datagen.resolved({"properties": {"x": {"$ref": "#/properties/x"}}})
    assert len(datagen.country_codes(spark)) > 200 and "CHF" in datagen.currency_codes(spark)


def test_schema_merging_keeps_pinned_types():
    pinned = T.StructType.fromDDL("a long, s struct<x: long>, l array<struct<p: long>>")
    found = T.StructType.fromDDL("a string, s struct<x: string, y: long>, l array<struct<q: long>>, z long")
    want = "struct<a:bigint,s:struct<x:bigint,y:bigint>,l:array<struct<p:bigint,q:bigint>>,z:bigint>"
    assert variants.merged_schema(pinned, found).simpleString() == want


def test_a_batch_of_many_files_is_one_micro_batch(spark, folder, monkeypatch):
    """No task takes a whole batch, and a batch smaller than its number of files is one all the same."""
    monkeypatch.setattr(registry, "ROWS_PER_FILE", 10)
    rows = spark.range(95).withColumn("batch", F.when(F.col("id") < 90, 0).when(F.col("id") < 92, 1).otherwise(2))
    seen = {}
    each_batch(registry.in_batches(rows, f"{folder}/in"), lambda batch, i: seen.update({i: sorted(r.id for r in batch.collect())}), f"{folder}/c")
    assert seen == {0: list(range(90)), 1: [90, 91], 2: [92, 93, 94]}
    assert len([p for p in Path(f"{folder}/in").iterdir() if p.name.startswith("part-")]) == 27


def counted(spark, df, column):
    """The same rows, and how many of them were worked out so far."""
    seen = spark.sparkContext.accumulator(0)

    def see(value):
        seen.add(1)
        return value

    return df.withColumn(column, F.udf(see, df.schema[column].dataType)(column)), seen


def test_compacted_logs_read_the_events_twice(spark, folder, monkeypatch):
    n = 400
    made = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.expr("timestampadd(MINUTE, cast(id * 7919 % 43200 as int), timestamp_ntz'2024-01-01 00:00:00')").alias("ts"),
        (F.col("id") % 17).alias("user_id"),
        F.when(F.col("id") % 9 == 0, "error").otherwise("view").alias("event_type"),
        F.col("id").cast("double").alias("value"),
        F.lit("{}").alias("props"),
    )
    made.unionByName(made.where("event_id % 50 = 1")).coalesce(1).write.parquet(f"{folder}/events.parquet")
    events, seen = counted(spark, spark.read.parquet(f"{folder}/events.parquet"), "value")
    monkeypatch.setattr(checks, "table", lambda *_: events)
    found = checks.cdc_compacted_logs(spark, folder)
    connection = duckdb.connect()
    # The SQL numbers rows; copies of an event are one change.
    connection.execute(f"CREATE VIEW events AS SELECT DISTINCT * FROM '{folder}/events.parquet/*.parquet'")
    assert differences(found, registry.ORACLE["cdc_compacted_logs"], connection) == []
    assert seen.value <= 2 * (n + n // 50)


def test_a_history_batch_reads_its_changes_once_for_the_log(spark, folder):
    made = spark.createDataFrame([(i % 7 if i % 5 else None, i, "x", False) for i in range(60)], CHANGES)
    batch, seen = counted(spark, made, "k")
    history.add_scd2_batch(batch, 0, f"{folder}/h", ["k"], "seq", "gone", ["v"], 4)
    assert seen.value == 60
    assert history.scd2_table(spark, f"{folder}/h", ["k"]).count() == 48
    assert history.scd2_quarantine(spark, f"{folder}/h").count() == 12


def test_a_log_counts_its_sides_with_one_job(spark, folder):
    made = spark.createDataFrame([(1, 1, "x", False), (1, 2, "y", False), (None, 3, "z", False), (2, None, "w", True)], CHANGES)
    streams._add(streams.cdc.latest_per_key(made, ["k"], "seq"), streams.cdc.unusable(made, ["k"], "seq"), f"{folder}/u", 0, "TEST")
    spark.sparkContext.setJobGroup("sides", "")
    try:
        assert writers.side_counts(spark, f"{folder}/u", 0) == {"good": 1, "quarantine": 2}
        plans = spark.sparkContext.statusTracker().getJobIdsForGroup("sides")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(plans) <= 2  # an adaptive plan's shuffle is a job of its own
    assert journal.history(spark, f"{folder}/u").first()["counts"] == {"keys": 1, "quarantined": 2}
