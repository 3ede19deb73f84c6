"""Streams of several batches, some out of order, over the whole events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.checks.changes import CUT, DELETED, FEED, KEYS, MIDDLE, SCD2, SEQ, scd1
from silverlode.checks.registry import check, files_for, in_batches, land, land_batches, table
from silverlode.operators import bitmaps, cdc
from silverlode.operators.quality import DROP, Rule, expect, with_stored_measure
from silverlode.session import new_folder
from silverlode.sources import variants
from silverlode.streaming import buckets, history, journal, totals, windows
from silverlode.streaming import changes as streams
from silverlode.streaming.writers import write_batch

# Fixed cuts of the events' time; rows whose number divides by 40 come late, with the last batch.
DAYS = ("2024-01-07", "2024-01-13", "2024-01-19", "2024-01-25")
IN_ORDER = "CASE WHEN ts < TIMESTAMP '{} 00:00:00' THEN 0 WHEN ts < TIMESTAMP '{} 00:00:00' THEN 1 WHEN ts < TIMESTAMP '{} 00:00:00' THEN 2 ELSE 3 END".format(*DAYS[:3])
WITH_LATE = f"CASE WHEN event_id % 40 = 0 THEN 4 ELSE {IN_ORDER} END"
# Some changes have no key, some no time.
ODD = f"""SELECT event_id, CASE WHEN event_id % 89 <> 0 THEN ts END AS ts, CASE WHEN event_id % 97 <> 0 THEN user_id END AS user_id,
    event_type, value, props, {IN_ORDER} AS batch FROM events"""


def _events(spark: SparkSession, folder: str, batch: str = IN_ORDER) -> DataFrame:
    return table(spark, folder, "events").withColumn("batch", F.expr(batch))


def _odd(spark: SparkSession, folder: str) -> DataFrame:
    empty = {SEQ: F.expr(f"CASE WHEN event_id % 89 <> 0 THEN {SEQ} END"), "user_id": F.expr("CASE WHEN event_id % 97 <> 0 THEN user_id END")}
    return _events(spark, folder).withColumns(empty)


@check(
    """SELECT event_id % 4 AS batch_id, count(*) AS n, count(*) AS ids, count(*) FILTER (WHERE event_id % 4 <> 3) AS types,
        count(value) FILTER (WHERE event_id % 4 <> 2 OR event_id % 8 <> 2) AS vals, count(*) FILTER (WHERE event_id % 4 = 3) AS users,
        count(*) FILTER (WHERE event_id % 8 = 2) AS rescued, 'bigint double string struct<id:bigint,type:string>' AS kinds
    FROM events GROUP BY 1"""
)
def schema_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Four batches of JSON, each inferred from its own files: the third holds text for a number, the last a nested column and no type."""
    root = new_folder(spark, "variants")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    common = [F.col("event_id"), F.col("event_type")]
    text = F.concat(F.lit("n/a "), F.col("value").cast("string"))
    shapes = {
        0: [*common, "value"],
        1: [*common, "value"],
        2: [*common, F.when(F.col("event_id") % 8 != 2, F.col("value")).alias("value"), F.when(F.col("event_id") % 8 == 2, text).alias("_text")],
        3: ["event_id", "value", F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("type")).alias("user")],
    }
    files = files_for(events.count())
    for number, columns in shapes.items():
        lines = events.where(F.col("event_id") % 4 == number).select(F.to_json(F.struct(*columns)).alias("value"))
        land(lines.select(F.replace("value", F.lit('"_text"'), F.lit('"value"')).alias("value")), f"{root}/in", files, "text")
    variants.ingest_json_evolving(spark, f"{root}/in", f"{root}/out", f"{root}/schema", f"{root}/_checkpoint", max_files_per_batch=files)
    rows = variants.evolving_table(spark, f"{root}/out", f"{root}/schema")
    kinds = dict(rows.dtypes)
    return rows.groupBy(F.col("batch_id").cast("bigint").alias("batch_id")).agg(
        F.count("*").alias("n"),
        F.count("event_id").alias("ids"),
        F.count("event_type").alias("types"),
        F.count("value").alias("vals"),
        F.count("user").alias("users"),
        F.count("_rescued").alias("rescued"),
        F.lit(" ".join(kinds[c] for c in ("event_id", "value", "event_type", "user"))).alias("kinds"),
    )


@check(f"WITH events AS (SELECT * FROM ({ODD}) o WHERE ts IS NOT NULL AND user_id IS NOT NULL) {scd1()}")
def cdc_merge_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """MERGE of four batches into a table in hash buckets, of which each batch rewrites its own and whose number doubles as it grows."""
    root = new_folder(spark, "bucketed")
    rows = _odd(spark, folder)
    stream = in_batches(rows, f"{root}/in")
    buckets.merge_bucketed_stream(stream, KEYS, SEQ, DELETED, f"{root}/t", f"{root}/_checkpoint", ["event_id"], buckets=2, rows_per_bucket=20)
    return buckets.bucketed_table(spark, f"{root}/t", KEYS, rows.drop("batch").schema)


@check(
    f"""WITH o AS ({ODD}), k AS (
        SELECT batch, user_id, max_by(event_type, (ts, event_id)) AS last FROM o WHERE ts IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2)
    SELECT o.batch AS batch_id, 'MERGE' AS operation, count(*) FILTER (WHERE ts IS NULL OR user_id IS NULL) AS quarantined,
        (SELECT count(*) FROM k WHERE k.batch = o.batch) AS keys, (SELECT count(*) FROM k WHERE k.batch = o.batch AND last = 'error') AS deletes,
        TRUE AS within_touched FROM o GROUP BY 1"""
)
def cdc_merge_bucketed_history(spark: SparkSession, folder: str) -> DataFrame:
    """The journal of such a merge: operation and counts of each batch, and that it wrote no more than the rows of the buckets it touched."""
    root = new_folder(spark, "bucketed")
    stream = in_batches(_odd(spark, folder), f"{root}/in")
    buckets.merge_bucketed_stream(stream, KEYS, SEQ, DELETED, f"{root}/t", f"{root}/_checkpoint", ["event_id"], buckets=8, keep_batches=1)
    counts = {c: F.col("counts")[c] for c in ("quarantined", "keys", "deletes", "rows", "rows_written", "buckets_written", "buckets")}
    rows = journal.history(spark, f"{root}/t").withColumns(counts)
    within = (F.col("rows_written") <= F.col("rows")) & (F.col("buckets_written") <= F.col("buckets"))
    return rows.select("batch_id", "operation", "quarantined", "keys", "deletes", within.alias("within_touched"))


FORMS = ("bucketed", "history", "merge_log", "upsert_log")


@check(
    f"""WITH o AS ({ODD}) SELECT form, count(*) FILTER (WHERE ts IS NULL OR user_id IS NULL) AS quarantined,
        count(DISTINCT user_id) FILTER (WHERE ts IS NOT NULL) AS keys FROM o, (VALUES {", ".join(f"('{f}')" for f in FORMS)}) AS v(form) GROUP BY 1"""
)
def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Every stream form keeps what it cannot use: quarantined rows of each, and the keys of the others."""
    root = new_folder(spark, "sides")
    rows = _odd(spark, folder)
    files = land_batches(rows, f"{root}/in")

    def stream() -> DataFrame:
        return spark.readStream.schema(rows.drop("batch").schema).option("maxFilesPerTrigger", 2 * files).parquet(f"{root}/in")

    streams.upsert_stream(stream(), KEYS, SEQ, f"{root}/u", f"{root}/_cu", ["event_id"])
    streams.merge_log_stream(stream(), KEYS, SEQ, DELETED, f"{root}/m", f"{root}/_cm")
    buckets.merge_bucketed_stream(stream(), KEYS, SEQ, DELETED, f"{root}/b", f"{root}/_cb", ["event_id"], buckets=4)
    history.scd2_stream(stream(), KEYS, SEQ, f"{root}/h", f"{root}/_ch", DELETED, ["event_id"], 4)
    kept = {
        "upsert_log": (streams.quarantined(spark, f"{root}/u"), streams.read_side(spark, f"{root}/u")),
        "merge_log": (streams.quarantined(spark, f"{root}/m"), streams.read_side(spark, f"{root}/m")),
        "bucketed": (buckets.quarantined(spark, f"{root}/b"), streams.read_side(spark, f"{root}/b/staged")),
        "history": (history.scd2_quarantine(spark, f"{root}/h"), spark.read.parquet(f"{root}/h/touched")),
    }
    found = None
    for form, (bad, good) in kept.items():
        own = bad.agg(F.lit(form).alias("form"), F.count("*").alias("quarantined")).crossJoin(good.agg(F.count_distinct("user_id").alias("keys")))
        found = own if found is None else found.unionByName(own)
    return found


# A key is late in a batch whose first change of it is not later than the last one before.
LATE = f"""WITH e AS (SELECT *, {WITH_LATE} AS batch FROM events),
    k AS (SELECT batch, user_id, min(ts) AS first, max(ts) AS last FROM e GROUP BY 1, 2),
    j AS (SELECT k.batch, k.user_id, k.first <= (SELECT max(p.last) FROM k p WHERE p.user_id = k.user_id AND p.batch < k.batch) AS late FROM k)"""


@check(f"{LATE} SELECT batch AS batch_id, 'APPLY CHANGES (SCD 2)' AS operation, count(*) AS keys, count(*) FILTER (WHERE late) AS late_keys FROM j GROUP BY 1")
def cdc_scd2_stream_history(spark: SparkSession, folder: str) -> DataFrame:
    """The journal of a history kept by a stream: only in the last batch are there late keys, for which alone the log is read."""
    root = new_folder(spark, "scd2-journal")
    history.scd2_stream(in_batches(_events(spark, folder, WITH_LATE), f"{root}/in"), KEYS, SEQ, f"{root}/t", f"{root}/_c", DELETED, ["event_id"], 4)
    counts = {c: F.col("counts")[c] for c in ("keys", "late_keys")}
    return journal.history(spark, f"{root}/t").withColumns(counts).select("batch_id", "operation", "keys", "late_keys")


def _before(number: int) -> str:
    return f"(SELECT * FROM events WHERE {WITH_LATE} <= {number})"


@check(
    " UNION ALL ".join(
        f"""SELECT {n} AS batch_id, (SELECT count(*) FROM ({scd1(f"{WITH_LATE} <= {n}")}) a) AS upserted,
        (SELECT count(*) FROM ({SCD2.replace("FROM events", f"FROM {_before(n)} events")}) b) AS versions,
        (SELECT count(*) FROM ({SCD2.replace("FROM events", f"FROM {_before(n)} events")}) b WHERE end_at IS NULL) AS open_versions"""
        for n in range(5)
    )
)
def log_read_at_time(spark: SparkSession, folder: str) -> DataFrame:
    """An upsert log and a history log read again as they were at the commit time of each batch."""
    root = new_folder(spark, "log-times")
    stream = in_batches(_events(spark, folder, WITH_LATE), f"{root}/in")
    streams.upsert_stream(stream, KEYS, SEQ, f"{root}/u", f"{root}/_cu", ["event_id"])
    history.scd2_stream(stream, KEYS, SEQ, f"{root}/h", f"{root}/_ch", DELETED, ["event_id"], 4)
    found = None
    times = {f: {r.batch_id: r.committed_at.astimezone() for r in journal.history(spark, f"{root}/{f}").collect()} for f in "uh"}
    for number, at in times["u"].items():
        rows = streams.upserted_table(spark, f"{root}/u", KEYS, SEQ, DELETED, ["event_id"], journal.batch_at(spark, f"{root}/u", at))
        versions = history.scd2_table(spark, f"{root}/h", KEYS, journal.batch_at(spark, f"{root}/h", times["h"][number]))
        own = rows.agg(F.lit(number).alias("batch_id"), F.count("*").alias("upserted"))
        own = own.crossJoin(versions.agg(F.count("*").alias("versions"), F.count_if(F.col("end_at").isNull()).alias("open_versions")))
        found = own if found is None else found.unionByName(own)
    return found


# The watermark of a batch is one hour behind the latest event of the batches before; late rows are judged by that of the batch before.
WINDOWS = f"""WITH e AS (SELECT *, {WITH_LATE} AS batch, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end FROM events),
    last AS (SELECT max(ts) - INTERVAL 1 HOUR AS w FROM e),
    late AS (SELECT max(ts) - INTERVAL 1 HOUR AS w FROM e WHERE batch <= 2),
    kept AS (SELECT e.* FROM e, late WHERE batch < 4 OR CAST(window_end AS TIMESTAMP) > late.w),
    best AS (SELECT user_id, window_start, window_end, max(ts) AS ts FROM kept GROUP BY 1, 2, 3)"""


@check(
    f"""{WINDOWS} SELECT CAST(best.window_start AS TIMESTAMP) AS window_start, best.user_id, best.ts, kept.event_id, kept.event_type
    FROM best JOIN kept ON kept.user_id = best.user_id AND kept.ts = best.ts, last WHERE CAST(best.window_end AS TIMESTAMP) <= last.w"""
)
def state_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's newest event of each day, given out when the watermark passes the day; late rows of closed days are dropped."""
    root = new_folder(spark, "windows")
    stream = in_batches(_events(spark, folder, WITH_LATE), f"{root}/in")
    windows.windowed_upserts(stream, KEYS, SEQ, "1 day", "1 hour", f"{root}/out", f"{root}/_checkpoint", ["event_id"])
    return spark.read.parquet(f"{root}/out").select("window_start", "user_id", "ts", "event_id", "event_type")


@check(f"{WINDOWS} SELECT count(*) AS open_windows, max(best.ts) AS latest FROM best, last WHERE CAST(best.window_end AS TIMESTAMP) > last.w")
def state_windows_open(spark: SparkSession, folder: str) -> DataFrame:
    """What the state store still holds after the last batch, read back from the checkpoint: only windows that the watermark has not passed."""
    root = new_folder(spark, "windows")
    stream = in_batches(_events(spark, folder, WITH_LATE), f"{root}/in")
    windows.windowed_upserts(stream, KEYS, SEQ, "1 day", "1 hour", f"{root}/out", f"{root}/_checkpoint", ["event_id"])
    state = windows.open_windows(spark, f"{root}/_checkpoint")
    return state.agg(F.count("*").alias("open_windows"), F.max(F.col(state.columns[-1])["ts"]).alias("latest"))


TOTALS = "event_type string, row_count bigint, cents bigint, latest timestamp_ntz"


@check(
    f"""SELECT event_type, count(*) AS row_count, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, max(ts) AS latest
    FROM ({scd1()}) s GROUP BY 1"""
)
def gold_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, sums and latest change by type of the current rows, kept from the feeds of four versions with deletes and updates."""
    root = new_folder(spark, "gold")
    events = table(spark, folder, "events")
    versions = [events.limit(0)]
    cuts = [f"{DAYS[0]} 00:00:00", MIDDLE, CUT, "9999-01-01 00:00:00"]
    versions += [cdc.apply_changes_scd1(events.where(F.col(SEQ) < F.lit(c).cast("timestamp_ntz")), KEYS, SEQ, DELETED, ["event_id"]) for c in cuts]
    files = files_for(events.count())
    for number, (before, after) in enumerate(zip(versions[:-1], versions[1:])):
        land(cdc.snapshot_diff(before, after, KEYS, number), f"{root}/feed", files)
    schema = spark.read.parquet(f"{root}/feed").schema
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{root}/feed")
    sums, maxima = {"cents": "CAST(round(value * 100) AS BIGINT)"}, {"latest": "ts"}
    totals.totals_stream(feed, f"{root}/t", f"{root}/_c", ["event_type"], sums, maxima, lambda i: versions[i + 1])
    return totals.totals(spark, f"{root}/t", TOTALS, ["event_type"])


@check(
    """WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type FROM events WHERE event_id % 10 <> 0),
        s AS (SELECT user_id, day, count(*) AS n FROM e WHERE event_type = 'purchase' GROUP BY 1, 2)
    SELECT e.*, coalesce(s.n, 0) AS purchases FROM e LEFT JOIN s ON s.user_id = e.user_id AND s.day = e.day WHERE coalesce(s.n, 0) <= 1"""
)
def dq_set_rule_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The set rule judged by stored counts: three batches of events come, a fourth takes every tenth away; nothing is counted anew."""
    root = new_folder(spark, "set-counts")
    events = table(spark, folder, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), "event_type")
    comes = events.withColumns({"change_type": F.lit("insert"), "batch": (F.col("event_id") % 3).cast("int")})
    goes = events.where("event_id % 10 = 0").withColumns({"change_type": F.lit("delete"), "batch": F.lit(3)})
    feed = in_batches(comes.unionByName(goes), f"{root}/in")
    group = ["user_id", "day"]
    totals.totals_stream(feed.where("event_type = 'purchase'"), f"{root}/t", f"{root}/_c", group, {}, {})
    counts = totals.totals(spark, f"{root}/t", "user_id bigint, day date, row_count bigint", group)
    measured = with_stored_measure(events.where("event_id % 10 <> 0"), counts, group, "row_count", "purchases")
    return expect(measured, [Rule("at_most_1", "purchases <= 1", DROP)])


@check(
    """SELECT 'bronze' AS layer, count(DISTINCT user_id) AS users, count(DISTINCT event_id) AS events, CAST(0 AS BIGINT) AS missing FROM events
    UNION ALL SELECT 'silver', count(DISTINCT user_id), count(DISTINCT event_id), (SELECT count(*) FROM events WHERE event_type = 'error')
    FROM events WHERE event_type <> 'error'"""
)
def dq_reconcile_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct users and events of two layers, and how many events one lacks, from the bitmaps that each of four batches left behind."""
    root = new_folder(spark, "bitmaps")
    events = _events(spark, folder)
    layers = {"bronze": events, "silver": events.where("event_type <> 'error'")}
    for layer, rows in layers.items():
        for number in range(4):
            for column in ("user_id", "event_id"):
                write_batch(bitmaps.bitmaps(rows.where(F.col("batch") == number), column), f"{root}/{layer}/{column}", number)
    stored = {(layer, c): spark.read.parquet(f"{root}/{layer}/{c}").drop("batch_id") for layer in layers for c in ("user_id", "event_id")}
    found = None
    for layer in layers:
        counts = [bitmaps.distinct_ids(stored[layer, c], name=n) for c, n in (("user_id", "users"), ("event_id", "events"))]
        own = counts[0].crossJoin(counts[1]).crossJoin(bitmaps.missing_count(stored["bronze", "event_id"], stored[layer, "event_id"]))
        own = own.withColumn("layer", F.lit(layer))
        found = own if found is None else found.unionByName(own)
    return found


@check("SELECT event_id FROM events WHERE event_type = 'error'")
def dq_missing_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Which events the silver layer lacks, from both layers' bitmaps."""
    events = table(spark, folder, "events")
    return bitmaps.missing_ids(bitmaps.bitmaps(events, "event_id"), bitmaps.bitmaps(events.where("event_type <> 'error'"), "event_id"), "event_id")


@check(
    f"""SELECT 'upsert' AS form, user_id, event_id, CAST(NULL AS TIMESTAMP) AS end_at FROM ({scd1()}) a
    UNION ALL SELECT 'merge', user_id, event_id, NULL FROM ({scd1()}) b UNION ALL SELECT 'history', user_id, event_id, end_at FROM ({SCD2}) c"""
)
def cdc_compacted_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Three logs compacted after three batches; their streams go on in the compacted folders with the last batch, late rows among it."""
    root = new_folder(spark, "compacted")
    events = _events(spark, folder)
    schema = events.drop("batch").schema
    # The last batch has the newest event of every user: merges take batches in their order.
    newest = cdc.latest_per_key(events.drop("batch"), KEYS, SEQ, ["event_id"]).select("event_id", F.lit(True).alias("_newest")).distinct()
    is_late = F.coalesce(F.expr("event_id % 5 = 0"), F.lit(False)) | F.col("_newest").isNotNull()
    dealt = events.join(newest, "event_id", "left").withColumn("batch", F.when(is_late, 3).otherwise(F.col("batch"))).drop("_newest")
    dealt.write.partitionBy("batch").parquet(f"{root}/dealt")
    events = spark.read.schema(events.schema).parquet(f"{root}/dealt")
    files = files_for(events.count())

    def run(stage: str) -> None:
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in")
        streams.upsert_stream(rows, KEYS, SEQ, f"{root}/{stage}/u", f"{root}/_cu", ["event_id"])
        streams.merge_log_stream(rows, KEYS, SEQ, DELETED, f"{root}/{stage}/m", f"{root}/_cm")
        history.scd2_stream(rows, KEYS, SEQ, f"{root}/{stage}/h", f"{root}/_ch", DELETED, ["event_id"], 4)

    for number in range(3):
        land(events.where(F.col("batch") == number).drop("batch"), f"{root}/in", files)
    run("first")
    streams.compact_upserts(spark, f"{root}/first/u", f"{root}/second/u", KEYS, SEQ, ["event_id"])
    streams.compact_merges(spark, f"{root}/first/m", f"{root}/second/m", KEYS, SEQ)
    history.compact_scd2(spark, f"{root}/first/h", f"{root}/second/h", KEYS, 2)
    land(events.where("batch = 3").drop("batch"), f"{root}/in", files)
    run("second")
    kept = {
        "upsert": streams.upserted_table(spark, f"{root}/second/u", KEYS, SEQ, DELETED, ["event_id"]),
        "merge": streams.merged_table(spark, f"{root}/second/m", KEYS, DELETED),
        "history": history.scd2_table(spark, f"{root}/second/h", KEYS),
    }
    found = None
    for form, rows in kept.items():
        end = F.col("end_at") if form == "history" else F.lit(None).cast("timestamp_ntz")
        own = rows.select(F.lit(form).alias("form"), "user_id", "event_id", end.alias("end_at"))
        found = own if found is None else found.unionByName(own)
    return found


@check(FEED)
def cdc_merged_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The change feed of the second version of a merge log, from the states of the keys that its batch touched."""
    root = new_folder(spark, "merged-feed")
    rows = table(spark, folder, "events").withColumn("batch", F.when(F.col(SEQ) < F.lit(CUT).cast("timestamp_ntz"), 0).otherwise(1))
    streams.merge_log_stream(in_batches(rows, f"{root}/in"), KEYS, SEQ, DELETED, f"{root}/m", f"{root}/_c")
    return streams.merged_feed(spark, f"{root}/m", KEYS, DELETED, 1).select("user_id", "event_id", "value", "change_type")
