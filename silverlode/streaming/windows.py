"""Keyed state with an end: the newest row of each key and window, kept only until the watermark has passed the window.

Native aggregation on the RocksDB store, no Python in the state. A row that comes after its window was closed is dropped by the
engine; ``late_rows`` tells how many groups of them were.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from silverlode.streaming.writers import each_batch, write_batch

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def windowed_latest(
    changes: DataFrame, keys: Sequence[str], seq: str, window: str, delay: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key in each window of event time, with ``window_start`` and ``window_end``.

    On a stream in append mode a window's row comes once, when the watermark (``delay`` behind the latest row of all batches before) has
    reached its end, and its state goes. Rows without key or time take no part.
    """
    usable = changes.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (*keys, seq)))
    ranked = [seq, *tiebreak, *[c for c in changes.columns if c not in {seq, *tiebreak, *keys}]]
    timed = usable.withColumn("_time", F.col(seq).cast("timestamp")).withWatermark("_time", delay)  # event time has a zone
    newest = timed.groupBy(F.window("_time", window).alias("_window"), *keys).agg(F.max(F.struct(*ranked)).alias("_row"))
    columns = [F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in changes.columns]
    kind = changes.schema[seq].dataType
    return newest.select(*columns, *[F.col(f"_window.{side}").cast(kind).alias(f"window_{side}") for side in ("start", "end")])


def windowed_upserts(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    window: str,
    delay: str,
    folder: str,
    checkpoint: str,
    tiebreak: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Append the rows of closed windows to ``folder`` by batch; what is still open stays in the state store."""
    spark = changes.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # read when the query starts, and from then on by its checkpoint
    try:
        newest = windowed_latest(changes, keys, seq, window, delay, tiebreak)
        return each_batch(newest, lambda batch, i: write_batch(batch, folder, i), checkpoint, every)
    finally:
        spark.conf.set(PROVIDER, before)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the state still holds, read from the checkpoint by the state data source: one row for each open key and window."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.*", "value.*")


def late_rows(query: StreamingQuery) -> int:
    """How many partial groups of late rows the state operators of the recent batches have dropped."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
