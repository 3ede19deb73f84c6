from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.sources.storage import names

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
ROWS_PER_FILE = 500_000


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name; ``sql`` states the same result independently."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            ORACLE[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def files_for(rows: int) -> int:
    """How many files a batch of that many rows is landed in: no task writes or reads more than one."""
    return max(1, ceil(rows / ROWS_PER_FILE))


def land(rows: DataFrame, folder: str, count: int, kind: str = "parquet") -> None:
    """Append the rows to a folder as exactly ``count`` files, which a stream that takes as many at once brings as one micro-batch.

    A partition without rows writes no file; empty ones make up for it.
    """
    spark = rows.sparkSession

    def landed() -> int:
        return sum(n.startswith("part-") for n in names(spark, folder))

    wanted = landed() + count
    rows.repartition(count).write.mode("append").option("maxRecordsPerFile", 0).format(kind).save(folder)
    for _ in range(wanted - landed()):
        rows.sparkSession.createDataFrame([], rows.schema).write.mode("append").format(kind).save(folder)


def land_batches(rows: DataFrame, folder: str, batch: str = "batch") -> int:
    """Land the rows of each number in ``batch`` in turn; the file source takes files by time. Returns the files of each batch."""
    sizes = {r[0]: r[1] for r in rows.groupBy(batch).count().collect()}
    count = files_for(max(sizes.values(), default=0))
    for number in sorted(sizes):
        land(rows.where(F.col(batch) == number).drop(batch), folder, count)
    return count


def in_batches(rows: DataFrame, folder: str, batch: str = "batch") -> DataFrame:
    """A stream that brings the rows of each number in ``batch`` as one micro-batch, in turn."""
    count = land_batches(rows, folder, batch)
    schema = rows.drop(batch).schema
    return rows.sparkSession.readStream.schema(schema).option("maxFilesPerTrigger", count).parquet(folder)
