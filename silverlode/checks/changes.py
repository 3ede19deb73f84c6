"""Change data capture: each user's events are the changes of one row, an error deletes it."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.checks.registry import check, files_for, in_batches, land, table
from silverlode.functions.scalar import full_name
from silverlode.operators import cdc
from silverlode.operators.project import delete_where, update_where
from silverlode.session import new_folder
from silverlode.sources.files import read_change_feed, stream_table
from silverlode.sources.storage import Snapshots
from silverlode.streaming import changes as streams
from silverlode.streaming import history
from silverlode.streaming.writers import append_stream

KEYS, SEQ, DELETED = ["user_id"], "ts", "event_type = 'error'"
CUT = "2024-01-30 12:00:00"
MIDDLE = "2024-01-16 00:00:00"

NEWEST = """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {source}
    ) z WHERE rn = 1"""


def newest(where: str = "TRUE") -> str:
    return NEWEST.format(source=f"(SELECT * FROM events WHERE {where}) e")


def scd1(where: str = "TRUE") -> str:
    return f"SELECT * FROM ({newest(where)}) n WHERE event_type <> 'error'"


SCD2 = """
    SELECT event_id, ts, user_id, event_type, value, props, ts AS start_at, nxt AS end_at FROM (
        SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM events
    ) z WHERE event_type <> 'error'"""

FEED = f"""
    WITH b AS ({scd1(f"ts < TIMESTAMP '{CUT}'")}), a AS ({scd1()})
    SELECT a.user_id, a.event_id, a.value, 'insert' AS change_type
        FROM a LEFT JOIN b ON a.user_id = b.user_id WHERE b.user_id IS NULL
    UNION ALL SELECT b.user_id, b.event_id, b.value, 'delete'
        FROM b LEFT JOIN a ON a.user_id = b.user_id WHERE a.user_id IS NULL
    UNION ALL SELECT b.user_id, b.event_id, b.value, 'update_preimage'
        FROM a JOIN b ON a.user_id = b.user_id WHERE a.ts <> b.ts
    UNION ALL SELECT a.user_id, a.event_id, a.value, 'update_postimage'
        FROM a JOIN b ON a.user_id = b.user_id WHERE a.ts <> b.ts"""


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _state(changes: DataFrame) -> DataFrame:
    return cdc.apply_changes_scd1(changes, KEYS, SEQ, DELETED, ["event_id"])


@check(
    """SELECT 'current' AS part, count(DISTINCT CASE WHEN event_id % 7 <> 0 THEN user_id END) AS n FROM events WHERE event_id % 11 <> 0
    UNION ALL SELECT 'quarantined', count(*) FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0
    UNION ALL SELECT 'usable', count(*) FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0"""
)
def cdc_unusable_quarantined(spark: SparkSession, folder: str) -> DataFrame:
    """Changes without a key or a sequence reach the quarantine, all others the current rows: none is lost."""
    events = _events(spark, folder).withColumns(
        {"user_id": F.when(F.col("event_id") % 7 != 0, F.col("user_id")), SEQ: F.when(F.col("event_id") % 11 != 0, F.col(SEQ))}
    )
    parts = {
        "current": cdc.latest_per_key(events, KEYS, SEQ, ["event_id"]),
        "quarantined": cdc.unusable(events, KEYS, SEQ),
        "usable": cdc.usable(events, KEYS, SEQ),
    }
    counts = [rows.agg(F.lit(name).alias("part"), F.count("*").alias("n")) for name, rows in parts.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@check(newest())
def cdc_latest(spark: SparkSession, folder: str) -> DataFrame:
    return cdc.latest_per_key(_events(spark, folder), KEYS, SEQ, ["event_id"])


@check(scd1())
def cdc_scd1(spark: SparkSession, folder: str) -> DataFrame:
    return _state(_events(spark, folder))


@check(scd1())
def cdc_scd1_stream(spark: SparkSession, folder: str) -> DataFrame:
    log = new_folder(spark, "upserts")
    stream = stream_table(spark, folder, _events(spark, folder).schema, "events.parquet")
    streams.upsert_stream(stream, KEYS, SEQ, log, f"{log}-checkpoint", ["event_id"])
    return streams.upserted_table(spark, log, KEYS, SEQ, DELETED, ["event_id"])


@check(scd1())
def cdc_scd1_state_stream(spark: SparkSession, folder: str) -> DataFrame:
    log = new_folder(spark, "state")
    # Three batches out of order: the oldest events come last.
    batch = F.when(F.col(SEQ) >= _at(CUT), 0).when(F.col(SEQ) >= _at(MIDDLE), 1).otherwise(2)
    stream = in_batches(_events(spark, folder).withColumn("batch", batch), f"{log}-in")
    streams.stateful_upserts(stream, KEYS, SEQ, log, f"{log}-checkpoint", ["event_id"])
    return streams.upserted_table(spark, log, KEYS, SEQ, DELETED, ["event_id"])


@check(scd1())
def cdc_merge(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    target = _state(events.where(F.col(SEQ) < _at(MIDDLE)))
    return cdc.merge_changes(target, events.where(F.col(SEQ) >= _at(MIDDLE)), KEYS, DELETED, SEQ, ["event_id"])


@check(
    f"""
    WITH t AS ({scd1(f"ts < TIMESTAMP '{MIDDLE}'")}),
         s AS ({newest(f"ts >= TIMESTAMP '{MIDDLE}'")}),
         k AS (SELECT t.* FROM t LEFT JOIN s ON t.user_id = s.user_id
               WHERE s.user_id IS NULL OR s.event_type = 'view')
    SELECT * FROM k UNION ALL SELECT * FROM s WHERE event_type NOT IN ('error', 'view')"""
)
def cdc_merge_null_operation(spark: SparkSession, folder: str) -> DataFrame:
    """A change whose operation is NULL (here: every view) does nothing."""
    events = _events(spark, folder)
    target = _state(events.where(F.col(SEQ) < _at(MIDDLE)))
    later = events.where(F.col(SEQ) >= _at(MIDDLE))
    return cdc.merge_changes(target, later, KEYS, "nullif(event_type, 'view') = 'error'", SEQ, ["event_id"])


@check(scd1())
def cdc_merge_stream(spark: SparkSession, folder: str) -> DataFrame:
    root = new_folder(spark, "merge")
    events = _events(spark, folder)
    ddl = ", ".join(f"{name} {kind}" for name, kind in events.dtypes)
    stream = stream_table(spark, folder, events.schema, "events.parquet")
    streams.merge_stream(stream, f"{root}/silver", f"{root}/checkpoint", ddl, KEYS, SEQ, DELETED)
    return Snapshots(spark, f"{root}/silver").read()


@check(scd1())
def cdc_merge_log_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same merge as an append-only log that is resolved on read."""
    log = new_folder(spark, "merge-log")
    batch = F.when(F.col(SEQ) < _at(MIDDLE), 0).when(F.col(SEQ) < _at(CUT), 1).otherwise(2)
    stream = in_batches(_events(spark, folder).withColumn("batch", batch), f"{log}-in")
    streams.merge_log_stream(stream, KEYS, SEQ, DELETED, log, f"{log}-checkpoint")
    return streams.merged_table(spark, log, KEYS, DELETED)


@check(SCD2)
def cdc_scd2(spark: SparkSession, folder: str) -> DataFrame:
    return cdc.apply_changes_scd2(_events(spark, folder), KEYS, SEQ, DELETED, ["event_id"])


@check(SCD2)
def cdc_scd2_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The history kept by a stream: five batches out of order, each touching only its own users."""
    root = new_folder(spark, "scd2")
    _events(spark, folder).repartition(5, "event_id").write.parquet(f"{root}/in")
    source = spark.read.parquet(f"{root}/in")
    rows = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    history.scd2_stream(rows, KEYS, SEQ, f"{root}/table", f"{root}/_checkpoint", DELETED, ["event_id"], 8)
    return history.scd2_table(spark, f"{root}/table", KEYS)


@check(SCD2)
def cdc_scd2_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """The plan for hot keys: every user with over 1/500 of the rows is cut into ranges."""
    return cdc.apply_changes_scd2(_events(spark, folder), KEYS, SEQ, DELETED, ["event_id"], hot_keys=True, share=1 / 500)


@check(
    """SELECT l_linenumber, stamp, n, lead(stamp) OVER (PARTITION BY l_linenumber ORDER BY stamp) AS end_at FROM (
        SELECT l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS stamp, count(*) AS n FROM lineitem GROUP BY 1, 2) z"""
)
def cdc_scd2_hot_text(spark: SparkSession, folder: str) -> DataFrame:
    """Seven keys hold all rows and their sequence is text; equal changes are one version with the number of its copies."""
    lines = table(spark, folder, "lineitem").select("l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("stamp"))
    versions = cdc.apply_changes_scd2(lines, ["l_linenumber"], "stamp", hot_keys=True)
    copies = lines.groupBy("l_linenumber", "stamp").agg(F.count("*").alias("n"))
    return versions.join(copies, ["l_linenumber", "stamp"]).select("l_linenumber", "stamp", "n", "end_at")


@check(SCD2)
def cdc_scd2_refresh(spark: SparkSession, folder: str) -> DataFrame:
    log = _events(spark, folder)
    before = log.where(F.col(SEQ) < _at(CUT))
    history = cdc.apply_changes_scd2(before, KEYS, SEQ, DELETED, ["event_id"])
    return cdc.refresh_scd2(history, log, log.where(F.col(SEQ) >= _at(CUT)), KEYS, SEQ, DELETED, ["event_id"])


@check(scd1(f"ts <= TIMESTAMP '{MIDDLE}'"))
def cdc_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return cdc.as_of(_events(spark, folder), KEYS, SEQ, MIDDLE, DELETED, ["event_id"])


@check(scd1(f"ts <= TIMESTAMP '{MIDDLE}'"))
def cdc_versions_as_of(spark: SparkSession, folder: str) -> DataFrame:
    history = cdc.apply_changes_scd2(_events(spark, folder), KEYS, SEQ, DELETED, ["event_id"])
    return cdc.versions_as_of(history, MIDDLE).drop("start_at", "end_at")


@check(
    f"""SELECT event_type, count(*) AS current_count, max(ts) AS latest_change
    FROM ({SCD2}) h WHERE end_at IS NULL GROUP BY event_type"""
)
def cdc_current_counts(spark: SparkSession, folder: str) -> DataFrame:
    history = cdc.apply_changes_scd2(_events(spark, folder), KEYS, SEQ, DELETED, ["event_id"])
    return cdc.current_counts(history, ["event_type"], "ts")


def _feed(spark: SparkSession, folder: str, version: int | None = None) -> tuple[DataFrame, DataFrame]:
    events = _events(spark, folder)
    before = _state(events.where(F.col(SEQ) < _at(CUT)))
    return before, cdc.snapshot_diff(before, _state(events), KEYS, version)


@check(FEED)
def cdc_diff(spark: SparkSession, folder: str) -> DataFrame:
    return _feed(spark, folder)[1].select("user_id", "event_id", "value", "change_type")


@check(
    f"""SELECT event_id, ts, user_id, event_type, value, regexp_replace(props, '"', '', 'g') AS props
    FROM ({scd1()}) s WHERE ts >= TIMESTAMP '{CUT}'
    UNION ALL SELECT * FROM ({scd1()}) s WHERE ts < TIMESTAMP '{CUT}'"""
)
def cdc_propagate(spark: SparkSession, folder: str) -> DataFrame:
    """The feed brings the old state up to date; quotes are stripped from what it changes."""
    before, feed = _feed(spark, folder, 1)
    return cdc.propagate_changes(before, feed, KEYS, {"props": "regexp_replace(props, '\"', '')"})


@check(
    f"""SELECT event_id, ts, user_id, event_type, value, regexp_replace(props, '"', '', 'g') AS props FROM ({scd1()}) s"""
)
def cdc_propagate_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Feeds of three versions of the users replayed by a stream, one version a batch, without rewriting the target."""
    root = new_folder(spark, "propagate")
    events = _events(spark, folder)
    before, files = events.limit(0), files_for(events.count())
    for version, until in enumerate((MIDDLE, CUT, "9999-01-01 00:00:00"), 1):
        after = cdc.apply_changes_scd1(events.where(F.col(SEQ) < F.lit(until).cast("timestamp")), KEYS, SEQ, DELETED, ["event_id"])
        land(cdc.snapshot_diff(before, after, KEYS, version), f"{root}/feed", files)
        before = after
    schema = spark.read.parquet(f"{root}/feed").schema
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{root}/feed")
    clean = {"props": "regexp_replace(props, '\"', '')"}
    streams.propagate_log_stream(feed, KEYS, f"{root}/log", f"{root}/_checkpoint", clean)
    return streams.propagated_table(spark, f"{root}/log", KEYS)


@check(FEED)
def change_feed_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The feed written as version 7 and read back as a stream from version 7 on."""
    root = new_folder(spark, "feed")
    _feed(spark, folder)[1].write.parquet(f"{root}/feed/commit_version=7")
    stream = read_change_feed(spark, f"{root}/feed", from_version=7, stream=True)
    append_stream(stream, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").select("user_id", "event_id", "value", "change_type")


@check(
    f"""
    WITH t AS (SELECT * FROM ({scd1(f"ts < TIMESTAMP '{MIDDLE}'")}) x),
         s AS ({newest(f"ts >= TIMESTAMP '{MIDDLE}'")})
    SELECT t.event_id, t.ts, t.user_id, t.event_type, t.props,
           CASE WHEN s.user_id IS NULL THEN t.value ELSE s.value END AS value
    FROM t LEFT JOIN s ON t.user_id = s.user_id
    UNION ALL
    SELECT NULL, NULL, s.user_id, s.event_type, NULL, NULL
    FROM s LEFT JOIN t ON t.user_id = s.user_id WHERE t.user_id IS NULL"""
)
def cdc_upsert_cols(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    target = _state(events.where(F.col(SEQ) < _at(MIDDLE)))
    source = cdc.latest_per_key(events.where(F.col(SEQ) >= _at(MIDDLE)), KEYS, SEQ, ["event_id"])
    update, insert = {"value": "value"}, {"user_id": "user_id", "event_type": "event_type"}
    return cdc.upsert_columns(target, source, KEYS, update, insert)


@check(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"""
)
def cdc_erase(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a negative balance are erased from the orders."""
    erased = table(spark, folder, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return cdc.erase_keys({"orders": orders}, erased, ["o_custkey"])["orders"]


@check(
    """SELECT CAST(ts AS DATE) AS version, count(*) AS changes,
           count(*) FILTER (WHERE event_type = 'error') AS deletes,
           count(*) FILTER (WHERE event_type <> 'error') AS upserts,
           min(ts) AS first_change, max(ts) AS last_change
    FROM events GROUP BY 1"""
)
def cdc_history(spark: SparkSession, folder: str) -> DataFrame:
    log = _events(spark, folder).withColumn("version", F.to_date("ts"))
    return cdc.change_history(log, "version", "ts", {"deletes": DELETED, "upserts": "event_type <> 'error'"})


@check(
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer WHERE c_acctbal >= 0"""
)
def cdc_delete_update(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    kept = delete_where(customers, "c_acctbal < 0")
    return update_where(kept, "c_mktsegment = 'MACHINERY'", {"c_acctbal": "0.0"})


@check(
    """SELECT user_id, full_name, ts FROM (
        SELECT user_id, event_type || ' ' || props AS full_name, ts, event_type,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events
    ) z WHERE rn = 1 AND event_type <> 'error'"""
)
def cdc_materialize(spark: SparkSession, folder: str) -> DataFrame:
    """An append-only table kept as a keyed table with a derived full name."""
    view = _events(spark, folder).select("user_id", full_name("event_type", "props").alias("full_name"), "event_type", "ts")
    return cdc.apply_changes_scd1(view, KEYS, SEQ, DELETED, except_columns=["event_type"])


@check(
    f"""SELECT 0 AS version, count(*) AS n, TRUE AS found_by_time FROM ({scd1(f"ts < TIMESTAMP '{MIDDLE}'")}) a
    UNION ALL SELECT 1, count(*), TRUE FROM ({scd1(f"ts < TIMESTAMP '{CUT}'")}) b UNION ALL SELECT 2, count(*), TRUE FROM ({scd1()}) c"""
)
def version_history(spark: SparkSession, folder: str) -> DataFrame:
    """Three versions of the table listed by their commit times, and each read again by its own time."""
    events = _events(spark, folder)
    versions = Snapshots(spark, new_folder(spark, "history"))
    for until in (MIDDLE, CUT, "9999-01-01 00:00:00"):
        versions.write(_state(events.where(F.col(SEQ) < _at(until))))
        time.sleep(0.01)  # commit times are told apart by the millisecond
    listed = versions.history().select("version")
    rows = None
    for version, at in versions.committed_at().items():
        same = versions.read_at(at).exceptAll(versions.read(version)).isEmpty()
        own = versions.read_at(at).agg(F.lit(version).alias("version"), F.count("*").alias("n"), F.lit(same).alias("found_by_time"))
        rows = own if rows is None else rows.unionByName(own)
    return listed.join(rows, "version")


@check(scd1(f"ts < TIMESTAMP '{CUT}'"))
def version_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Two written versions of the table, the older one restored and read."""
    events = _events(spark, folder)
    versions = Snapshots(spark, new_folder(spark, "versions"))
    first = versions.write(_state(events.where(F.col(SEQ) < _at(CUT))))
    versions.write(_state(events))
    versions.restore(first)
    return versions.read()
