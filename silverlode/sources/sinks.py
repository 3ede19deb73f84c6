"""Batch sinks: tables, published CSV, JSON batches, backups."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from silverlode.operators.layout import has_map
from silverlode.operators.quality import DROP, FAIL, ExpectationFailed, Rule, expect, observe_violations, raise_broken
from silverlode.sources.storage import names, remove, replace


def _text(value: str) -> str:
    """A SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def overwrite_table(
    df: DataFrame, table: str, path: str | None = None, comment: str | None = None, tier: str | None = None
) -> None:
    """Replace a parquet table (CREATE OR REPLACE ... AS), with a comment and a quality tier tag."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    tags = {k: v for k, v in {"quality": tier, "comment": comment}.items() if v}
    if tags:
        pairs = ", ".join(f"'{k}' = {_text(v)}" for k, v in tags.items())
        name = ".".join(f"`{part.strip('`').replace('`', '``')}`" for part in table.split("."))
        df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def register_table(spark: SparkSession, table: str, path: str) -> None:
    """A table on files that a stream or job has already written."""
    spark.catalog.createTable(table, path=path, source="parquet")


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_json_batch(df: DataFrame, folder: str, batch: int) -> None:
    """One numbered batch of JSON lines, written in parallel; a rerun replaces that batch."""
    df.write.mode("overwrite").json(f"{folder.rstrip('/')}/batch={batch}")


def publish_checked(df: DataFrame, rules: Sequence[Rule], target: str) -> None:
    """Write the rows that the rules keep to the folder ``target``, unless one breaks a FAIL rule.

    One pass: violations are observed in the rows as they came while a staged copy is written, and the copy takes the place of ``target``
    only if there are none. Works on a stream's batch too, so that a broken batch publishes nothing.
    """
    spark = df.sparkSession
    parent, _, _ = target.rstrip("/").rpartition("/")
    staged, seen = f"{parent}/_staged-{uuid.uuid4().hex}", Observation()
    fails = [r for r in rules if r.action == FAIL]
    rows = observe_violations(df, fails, seen) if fails else df
    expect(rows, [r for r in rules if r.action == DROP]).write.parquet(staged)
    try:
        raise_broken(fails, seen.get if fails else {})
    except ExpectationFailed:
        remove(spark, staged)
        raise
    replace(spark, staged, target)


def _one_reader(df: DataFrame, folder: str) -> DataFrame:
    """The rows for one task, which reads their compressed columns from ``folder``; no row goes through a shuffle."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder).coalesce(1)


def publish_csv(
    df: DataFrame,
    folder: str,
    file: str,
    delimiter: str = ",",
    header: bool = True,
    compression: str | None = None,
    single: bool = True,
) -> list[str]:
    """Publish a gold table as CSV; returns the published paths.

    The caller chooses the form: ``single`` gives the one file ``folder/file``, written by one task, which reads nothing but the
    compressed columns of the rows: they are worked out and staged in parallel. Otherwise the folder ``folder/file`` gets parts
    that are written in parallel. Both are written beside the target and then put in its place, whichever form was there before.
    """
    spark = df.sparkSession
    target = f"{folder.rstrip('/')}/{file}"
    staging = f"{folder.rstrip('/')}/_staging-{file}"
    columns = f"{folder.rstrip('/')}/_columns-{file}"
    writer = (_one_reader(df, columns) if single else df).write.mode("overwrite")
    writer = writer.option("header", header).option("delimiter", delimiter)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(staging)
    parts = [n for n in names(spark, staging) if n.startswith("part-")]
    if not single:
        replace(spark, staging, target)
        return [f"{target}/{n}" for n in parts]
    replace(spark, f"{staging}/{parts[0]}", target)
    remove(spark, staging)
    remove(spark, columns)
    return [target]


def _fingerprint(df: DataFrame) -> list[Column]:
    """Row count and an order-free sum of row hashes."""
    row = F.xxhash64(*[F.to_json(f.name) if has_map(f.dataType) else F.col(f"`{f.name}`") for f in df.schema.fields])
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).alias("hash")]


def copy_tables(spark: SparkSession, tables: Mapping[str, str], target: str, at_once: int = 4) -> dict[str, int]:
    """Full copy of each parquet table to ``target/name``; returns row counts.

    The source is fingerprinted while it is written and compared with the copy.
    """

    def copy(name: str, path: str) -> tuple[str, int]:
        source, seen = spark.read.parquet(path), Observation()
        source.observe(seen, *_fingerprint(source)).write.mode("overwrite").parquet(f"{target.rstrip('/')}/{name}")
        written = spark.read.parquet(f"{target.rstrip('/')}/{name}")
        check = written.agg(*_fingerprint(written)).first().asDict()
        if check != seen.get:
            raise RuntimeError(f"copy of {name} differs: {seen.get} became {check}")
        return name, check["rows"]

    with ThreadPoolExecutor(at_once) as pool:
        return dict(pool.map(lambda item: copy(*item), tables.items()))
