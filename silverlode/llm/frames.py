"""Small helpers on DataFrames shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silverlode.session import new_folder
from silverlode.sources.storage import remove

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str, done: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Write a frame into the shared folder and read it back: its rows stay the same from here on.

    The write's shuffle files go when it has ended, and with them the stored frames ``done``, which nothing reads any more.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(_CLEAN, before)
    release(*done)
    return _kept(spark.read.schema(df.schema).parquet(folder), folder)


def _kept(frame: DataFrame, folder: str) -> DataFrame:
    frame.stored_at = folder
    return frame


def same_store(frame: DataFrame, stored_frame: DataFrame) -> DataFrame:
    """``frame``, read from ``stored_frame`` alone, as the one to release instead of it."""
    return _kept(frame, stored_frame.stored_at)


def release(*frames: DataFrame) -> None:
    """Delete stored frames once all that reads them has been written."""
    for frame in frames:
        remove(frame.sparkSession, frame.stored_at)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores added while a column of ``taken`` (case aside) has it."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Let Spark hand at most ``rows`` rows at a time to Python: rows hold whole texts, and both sides keep a batch in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
