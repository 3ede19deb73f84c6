"""File sources: incremental ingest, pinned schemas, checked CSV, registered sources, change feeds."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.sources.storage import exists

CORRUPT = "_corrupt_record"


def with_file_lineage(df: DataFrame, name: str = "input_file_name", full_path: bool = False) -> DataFrame:
    """Each row with the file it came from; on batch and streaming file scans."""
    return df.withColumn(name, F.col("_metadata.file_path" if full_path else "_metadata.file_name"))


def ingest_files(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
    glob: str | None = None,
    lineage: str | None = "input_file_name",
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """Streaming read of a landing folder: with a checkpoint each file is read exactly once."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    rows = reader.options(**dict(options or {})).load(path)
    return with_file_lineage(rows, lineage) if lineage else rows


def infer_schema(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
) -> T.StructType:
    """The merged schema of all files; the column that would hold broken lines is no part of it."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "true")
    return T.StructType([f for f in reader.load(path).schema.fields if f.name != CORRUPT])


def infer_and_pin_schema(
    spark: SparkSession,
    path: str,
    schema_location: str,
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
    evolve: bool = False,
) -> T.StructType:
    """Infer once, keep the schema at ``schema_location`` and use it from then on.

    With ``evolve`` columns that new files bring are appended to the pinned schema; known columns
    keep their types.
    """
    pinned = None
    if exists(spark, schema_location):
        pinned = T.StructType.fromJson(json.loads(spark.read.text(schema_location, wholetext=True).first()[0]))
        if not evolve:
            return pinned
    schema = infer_schema(spark, path, fmt, options)
    if pinned is not None:
        known = set(pinned.names)
        added = [f for f in schema.fields if f.name not in known]
        if not added:
            return pinned
        schema = T.StructType([*pinned.fields, *added])
    text = spark.createDataFrame([(schema.json(),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(schema_location)
    return schema


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Batch CSV with a header; without ``schema`` the types are inferred (a second pass)."""
    reader = spark.read.option("header", "true").options(**dict(options or {}))
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", "true").csv(path)


def read_csv_checked(
    spark: SparkSession, path: str, schema: str, fail_fast: bool = False, options: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): malformed rows go to rejects with their text, or fail the read."""
    reader = spark.read.option("header", "true").options(**dict(options or {}))
    if fail_fast:
        rows = reader.option("mode", "FAILFAST").schema(schema).csv(path)
        return rows, rows.where(F.lit(False)).withColumn(CORRUPT, F.lit(None).cast("string"))
    rows = (
        reader.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(f"{schema}, {CORRUPT} string")
        .csv(path)
    )
    # Only columns that a query reads are parsed, so a bad value elsewhere would go unseen: both
    # sides name every column in a condition that always holds.
    parsed = F.xxhash64(*[f"`{c}`" for c in rows.columns if c != CORRUPT]) >= F.lit(-(2**63))
    return rows.where(F.col(CORRUPT).isNull() & parsed).drop(CORRUPT), rows.where(F.col(CORRUPT).isNotNull() & parsed)


def ingest_csv_with_rejects(
    spark: SparkSession,
    path: str,
    schema: str,
    options: Mapping[str, str] | None = None,
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """Streaming CSV with the text of every malformed row, wrong types included, in ``_corrupt_record``.

    Write it whole, or take both sides in each batch with ``without_rejects``; no value is lost unseen.
    """
    checked = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **dict(options or {})}
    return ingest_files(
        spark, path, f"{schema}, {CORRUPT} string", "csv", checked, lineage=None, max_files_per_batch=max_files_per_batch
    )


def without_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of rows read with their rejects."""
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.where(F.col(CORRUPT).isNotNull())


def ingest_json_rescued(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    rescued: str = "_rescued",
    stream: bool = True,
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """JSON lines in a fixed schema, with what does not fit it kept in one text column.

    ``rescued`` holds as a JSON object the columns outside the schema and the values that are not of
    their column's type (NULL there), or the whole line where it is no JSON object; otherwise it is NULL.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    lines = reader.text(path).where(F.trim("value") != "")
    parsed = lines.withColumns({"_typed": F.from_json("value", schema), "_raw": F.from_json("value", "map<string,string>")})
    empty = F.map_from_arrays(
        F.array(*[F.lit(n) for n in schema.names]), F.array(*[F.col(f"_typed.`{n}`").isNull() for n in schema.names])
    )
    left = F.map_filter("_raw", lambda k, v: v.isNotNull() & F.coalesce(F.element_at(empty, k), F.lit(True)))
    kept = F.when(F.col("_raw").isNull(), F.col("value")).when(F.size(left) > 0, F.to_json(left))
    return parsed.select(*[F.col(f"_typed.`{n}`").alias(n) for n in schema.names], kept.alias(rescued))


def csv_view(spark: SparkSession, name: str, path: str, options: Mapping[str, str] | None = None) -> None:
    """A temporary view over CSV files."""
    spark.read.option("header", "true").options(**dict(options or {})).csv(path).createOrReplaceTempView(name)


def read_path(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """Query files in place: ``SELECT * FROM fmt.`path` ``."""
    if fmt not in ("csv", "json", "parquet", "orc", "text"):
        raise ValueError(f"unknown format {fmt}")
    return spark.sql(f"SELECT * FROM {fmt}.`{path.replace('`', '``')}`")


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, glob: str | None = None
) -> DataFrame:
    """An append-only parquet table as a stream; rows that arrive later are read once."""
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(path)


def registered_source(spark: SparkSession, registry: DataFrame, entity: str) -> tuple[dict[str, str], dict[str, str]]:
    """(reader options, expectations) of one entity of a source registry.

    The registry has a row per entity: TableName, ReadOptions and Expectations as JSON maps.
    """
    row = (
        registry.where(F.col("TableName") == entity)
        .select(
            F.from_json("ReadOptions", "map<string,string>").alias("options"),
            F.from_json("Expectations", "map<string,string>").alias("expectations"),
        )
        .first()
    )
    if row is None:
        raise KeyError(f"{entity} is not registered")
    return dict(row["options"] or {}), dict(row["expectations"] or {})


def read_registered(spark: SparkSession, registry: DataFrame, entity: str, base: str) -> DataFrame:
    options, _ = registered_source(spark, registry, entity)
    return spark.read.options(**options).csv(f"{base.rstrip('/')}/{entity}")


def read_change_feed(spark: SparkSession, folder: str, from_version: int = 0, stream: bool = False) -> DataFrame:
    """Rows of a change feed folder from a version on; the version is a partition, so older ones are not read."""
    schema = spark.read.parquet(folder).schema
    reader = spark.readStream.schema(schema) if stream else spark.read
    return reader.parquet(folder).where(F.col("commit_version") >= from_version)
