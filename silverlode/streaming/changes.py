"""Keyed targets fed by streams: an upsert log, merged snapshots, and change-feed propagation.

Rows that cannot be ordered or matched (no key, no sequence) are the quarantine side of the write that takes the others: what a batch
brings is in the log or in ``quarantined``, and both sides are committed together. Logs have a journal (``streaming.journal``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from silverlode.operators import cdc
from silverlode.sources.storage import Snapshots
from silverlode.streaming import journal
from silverlode.streaming.writers import each_batch, read_side, side_counts, write_batch, write_sides

VERSION = "batch_id"


def _add(good: DataFrame, rest: DataFrame, folder: str, batch_id: int, operation: str) -> None:
    """Both sides of a batch in one write, and then its journal row."""
    write_sides(good, rest, folder, batch_id)
    spark = good.sparkSession
    sides = side_counts(spark, folder, batch_id)
    journal.commit(spark, folder, batch_id, operation, {"keys": sides["good"], "quarantined": sides["quarantine"]})


def quarantined(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all batches of a log that have no key or no sequence, with their batch."""
    return read_side(spark, folder, "quarantine")


def upsert_stream(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    folder: str,
    checkpoint: str,
    tiebreak: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Apply-changes (SCD 1) as an append-only log of each batch's newest row per key.

    A batch writes only its own keys, deletes included, so the cost follows the changes and
    not the table; late rows lose when the log is read. No streaming state is kept.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        _add(cdc.latest_per_key(batch, keys, seq, tiebreak), cdc.unusable(batch, keys, seq), folder, batch_id, "APPLY CHANGES (SCD 1)")

    return each_batch(changes, add, checkpoint, every)


def upserted_table(
    spark: SparkSession,
    folder: str,
    keys: Sequence[str],
    seq: str,
    delete_when: str | None = None,
    tiebreak: Sequence[str] = (),
    version: int | None = None,
) -> DataFrame:
    """Current rows of an upsert log, or those as of a batch."""
    log = read_side(spark, folder)
    log = log if version is None else log.where(F.col(VERSION) <= version)
    return cdc.apply_changes_scd1(log.drop(VERSION), keys, seq, delete_when, tiebreak)


def compact_upserts(
    spark: SparkSession, folder: str, target: str, keys: Sequence[str], seq: str, tiebreak: Sequence[str] = ()
) -> None:
    """Rewrite a log to one row per key, tombstones kept, as batch -1 of a new folder, which a stream may go on with."""
    newest = cdc.latest_per_key(read_side(spark, folder).drop(VERSION), keys, seq, tiebreak)
    _add(newest, quarantined(spark, folder).drop(VERSION), target, -1, "COMPACT")


def compact_merges(spark: SparkSession, folder: str, target: str, keys: Sequence[str], seq: str) -> None:
    """Rewrite a merge log to the last acting row per key, deletes kept, as batch -1 of a new folder, which a stream may go on with."""
    newest = cdc.latest_per_key(read_side(spark, folder), keys, VERSION, [seq]).drop(VERSION)
    _add(newest, quarantined(spark, folder).drop(VERSION), target, -1, "COMPACT")


def stateful_upserts(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    folder: str,
    checkpoint: str,
    tiebreak: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """The same log from a streaming aggregate: late rows are dropped by the state already.

    The state holds one row for every key ever seen; ``streaming.windows`` has the form whose state ends. Unusable rows never
    reach the state: a query of its own, with a checkpoint of its own, takes them to ``folder`` with "-quarantine" added.
    """
    newest = cdc.latest_per_key(changes, keys, seq, tiebreak)
    nothing = newest.sparkSession.createDataFrame([], newest.schema)
    each_batch(cdc.unusable(changes, keys, seq), lambda batch, i: write_batch(batch, f"{folder}-quarantine", i), f"{checkpoint}-quarantine", every)
    return each_batch(newest, lambda batch, i: write_sides(batch, nothing, folder, i), checkpoint, every, mode="update")


def merge_log_stream(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    delete_when: str,
    folder: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """MERGE as a log: each batch appends its newest acting row per key, nothing is rewritten.

    The form for large targets. A change whose delete condition is NULL does nothing. Later
    batches win over earlier ones, as with a MERGE run per batch.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        newest = cdc.latest_per_key(batch, keys, seq)
        _add(newest.where(F.expr(delete_when).isNotNull()), cdc.unusable(batch, keys, seq), folder, batch_id, "MERGE")

    return each_batch(changes, add, checkpoint, every)


def _merged(log: DataFrame, keys: Sequence[str], delete_when: str) -> DataFrame:
    return cdc.apply_changes_scd1(log, keys, VERSION, delete_when, except_columns=[VERSION])


def merged_table(
    spark: SparkSession, folder: str, keys: Sequence[str], delete_when: str, version: int | None = None
) -> DataFrame:
    """Rows of a merge log, now or as of a version (a batch id; later batches are not read)."""
    log = read_side(spark, folder)
    return _merged(log if version is None else log.where(F.col(VERSION) <= version), keys, delete_when)


def merged_feed(
    spark: SparkSession, folder: str, keys: Sequence[str], delete_when: str, version: int
) -> DataFrame:
    """Change feed of one version of a merge log, from the states of the keys it touched."""
    keys = list(keys)
    log = read_side(spark, folder)
    touched = log.where(F.col(VERSION) == version).select(*keys)
    own = log.where(F.col(VERSION) <= version).join(touched, keys, "left_semi")
    before = _merged(own.where(F.col(VERSION) < version), keys, delete_when)
    return cdc.snapshot_diff(before, _merged(own, keys, delete_when), keys, version)


def merge_stream(
    changes: DataFrame,
    target: str,
    checkpoint: str,
    schema: str,
    keys: Sequence[str],
    seq: str,
    delete_when: str,
    feed: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """MERGE each micro-batch into a table of snapshots, and append its change feed to ``feed``.

    Batch N reads the newest version before N + 1 and writes version N + 1, so a replay
    rewrites the same folders. Version 0 is the empty table. The whole target is rewritten
    each time; see ``merge_log_stream`` for large ones.
    """
    keys = list(keys)

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = Snapshots(spark, target)
        version = batch_id + 1
        earlier = [v for v in table.versions() if v < version]
        if not earlier:
            table.write(spark.createDataFrame([], schema), 0)
            earlier = [0]
        before = table.read(earlier[-1])
        write_batch(cdc.unusable(batch, keys, seq), f"{target}-quarantine", batch_id)
        table.write(cdc.merge_changes(before, batch, keys, delete_when, seq), version)
        if feed:
            changed = cdc.snapshot_diff(before, table.read(version), keys)
            changed.write.mode("overwrite").parquet(f"{feed.rstrip('/')}/commit_version={version}")

    return each_batch(changes, merge, checkpoint, every)


def propagate_stream(
    feed: DataFrame,
    target: str,
    checkpoint: str,
    schema: str,
    keys: Sequence[str],
    clean: Mapping[str, str] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Replay a streamed change feed into a downstream table of snapshots."""
    keys = list(keys)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = Snapshots(spark, target)
        version = batch_id + 1
        earlier = [v for v in table.versions() if v < version]
        before = table.read(earlier[-1]) if earlier else spark.createDataFrame([], schema)
        write_batch(cdc.unusable(batch, keys, cdc.COMMIT_VERSION), f"{target}-quarantine", batch_id)
        table.write(cdc.propagate_changes(before, batch, keys, clean), version)

    return each_batch(feed, apply, checkpoint, every)


def propagate_log_stream(
    feed: DataFrame,
    keys: Sequence[str],
    folder: str,
    checkpoint: str,
    clean: Mapping[str, str] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Replay a streamed change feed as a log: each batch appends its newest change per key, cleaned; nothing is rewritten.

    The form for large targets; ``propagated_table`` reads it.
    """
    keys = list(keys)

    def add(batch: DataFrame, batch_id: int) -> None:
        newest = cdc.latest_feed_rows(batch, keys)
        cleaned = newest.withColumns({name: F.expr(text) for name, text in (clean or {}).items()})
        _add(cleaned, cdc.unusable(batch, keys, cdc.COMMIT_VERSION), folder, batch_id, "PROPAGATE")

    return each_batch(feed, add, checkpoint, every)


def propagated_table(spark: SparkSession, folder: str, keys: Sequence[str]) -> DataFrame:
    """Current rows of a propagation log: a key's newest change by commit version."""
    newest = cdc.latest_feed_rows(read_side(spark, folder).drop(VERSION), keys)
    return newest.where(F.col(cdc.CHANGE_TYPE) != "delete").drop(cdc.CHANGE_TYPE, cdc.COMMIT_VERSION)
