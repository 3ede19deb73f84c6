"""One row for each batch of a log: what it did and when, so that logs have a history and can be read by time."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.sources.storage import exists
from silverlode.streaming.writers import write_batch

SCHEMA = "committed_at timestamp, operation string, counts map<string,bigint>"


def journal_folder(folder: str) -> str:
    return f"{folder.rstrip('/')}-journal"


def commit(spark: SparkSession, folder: str, batch_id: int, operation: str, counts: Mapping[str, int]) -> None:
    """Note a batch as done; written after all its data. A replay keeps the time of the first commit."""
    target = journal_folder(folder)
    at = datetime.now(timezone.utc)
    if exists(spark, f"{target}/batch_id={batch_id}/_SUCCESS"):
        at = spark.read.schema(SCHEMA).parquet(f"{target}/batch_id={batch_id}").first()["committed_at"].astimezone(timezone.utc)
    pairs = F.create_map(*[F.lit(part) for k, v in counts.items() for part in (k, int(v))])
    row = spark.range(0, 1, 1, 1).select(F.lit(at).alias("committed_at"), F.lit(operation).alias("operation"), pairs.cast("map<string,bigint>").alias("counts"))
    write_batch(row, target, batch_id)


def history(spark: SparkSession, folder: str) -> DataFrame:
    """(batch_id, committed_at, operation, counts), one row for each committed batch."""
    schema = f"{SCHEMA}, batch_id int"
    return spark.read.schema(schema).parquet(journal_folder(folder)).select("batch_id", "committed_at", "operation", "counts")


def batch_at(spark: SparkSession, folder: str, when: datetime) -> int:
    """The newest batch committed by a time (TIMESTAMP AS OF); naive times are UTC."""
    if when.tzinfo is None:
        when = when.replace(tzinfo=timezone.utc)
    found = history(spark, folder).where(F.col("committed_at") <= F.lit(when)).agg(F.max("batch_id")).first()[0]
    if found is None:
        raise ValueError(f"no batch of {folder} was committed by {when}")
    return found


def last_batch(spark: SparkSession, folder: str, before: int) -> dict | None:
    """The row of the newest batch before ``before``, or None."""
    if not exists(spark, journal_folder(folder)):
        return None
    found = history(spark, folder).where(F.col("batch_id") < before).orderBy(F.desc("batch_id")).first()
    return found.asDict() if found else None
