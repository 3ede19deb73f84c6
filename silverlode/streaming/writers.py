"""Streaming sinks. Every writer needs a checkpoint: it is what makes reads exactly-once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from silverlode.operators.quality import Rule
from silverlode.sources.sinks import publish_checked

SIDE = "_side"


def _writer(df: DataFrame, checkpoint: str, every: str | None, name: str | None, mode: str) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    # All there is, then stop; or keep running at an interval such as "10 seconds".
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def _started(query: StreamingQuery, every: str | None) -> StreamingQuery:
    if not every:
        query.awaitTermination()
    return query


def append_stream(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Append to a parquet folder. Readers see whole committed batches through the sink's log."""
    return _started(_writer(df, checkpoint, every, name, "append").format("parquet").start(path), every)


def append_to_table(
    df: DataFrame, table: str, checkpoint: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    return _started(_writer(df, checkpoint, every, name, "append").format("parquet").toTable(table), every)


def each_batch(
    df: DataFrame,
    function: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Call ``function(batch, batch_id)`` per micro-batch. A batch can be replayed after a failure,
    so the function must give the same result for the same batch id."""
    return _started(_writer(df, checkpoint, every, name, mode).foreachBatch(function).start(), every)


def write_batch(batch: DataFrame, folder: str, batch_id: int) -> None:
    """Add one micro-batch to a log folder; a replay overwrites the same partition."""
    batch.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch_id={batch_id}")


def append_checked(
    df: DataFrame, rules: Sequence[Rule], folder: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append each micro-batch under its id, judged while it is written: one FAIL violation stops the stream and publishes nothing of its batch."""
    return each_batch(df, lambda batch, i: publish_checked(batch, rules, f"{folder.rstrip('/')}/batch_id={i}"), checkpoint, every)


def write_sides(good: DataFrame, quarantined: DataFrame, folder: str, batch_id: int) -> None:
    """Write what a batch adds to a log and what it sends to quarantine as one job, so that both are committed or neither."""
    sides = good.withColumn(SIDE, F.lit("good")).unionByName(quarantined.withColumn(SIDE, F.lit("quarantine")), allowMissingColumns=True)
    sides.write.mode("overwrite").partitionBy(SIDE).parquet(f"{folder.rstrip('/')}/batch_id={batch_id}")


def side_counts(spark: SparkSession, folder: str, batch_id: int) -> dict[str, int]:
    """How many rows of a batch are on each side, from the footers of its own files."""
    rows = spark.read.schema(f"{SIDE} string").parquet(f"{folder.rstrip('/')}/batch_id={batch_id}")
    return rows.agg(*[F.count_if(F.col(SIDE) == side).alias(side) for side in ("good", "quarantine")]).first().asDict()


def read_side(spark: SparkSession, folder: str, side: str = "good") -> DataFrame:
    """One side of all batches; only its files are read."""
    return spark.read.parquet(folder).where(F.col(SIDE) == side).drop(SIDE)
