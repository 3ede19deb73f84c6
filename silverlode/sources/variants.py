"""JSON lines whose schema is inferred from each micro-batch alone, by VARIANT.

A batch is parsed once to VARIANT; ``schema_of_variant_agg`` merges the shapes of its rows map-side into one row, so what is
read for a batch is the batch and not the landing folder. The shape is merged into the pinned schema: known columns keep their types,
new columns (and new fields of nested ones) are appended, and what does not fit its column is kept as JSON text.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from silverlode.sources.storage import names
from silverlode.streaming.writers import each_batch, write_batch

RESCUED = "_rescued"


def _plain(kind: T.DataType) -> T.DataType | None:
    """The column type for an inferred type: decimals with a fraction are doubles, mixed kinds text, and only-null has none."""
    if isinstance(kind, T.NullType):
        return None
    if isinstance(kind, T.VariantType):
        return T.StringType()
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale else T.DecimalType(38, 0)
    if isinstance(kind, T.ArrayType):
        inner = _plain(kind.elementType)
        return T.ArrayType(inner) if inner else None
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, inner) for f in kind.fields if (inner := _plain(f.dataType))]
        return T.StructType(fields) if fields else None
    return kind


def batch_schema(variants: DataFrame, column: str = "v") -> T.StructType:
    """The merged shape of a column of VARIANT objects, as one map-side merged aggregate."""
    found = variants.agg(F.schema_of_variant_agg(column)).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([])
    kind = T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", found))
    return _plain(kind) or T.StructType([])


def merged_schema(pinned: T.DataType, found: T.DataType) -> T.DataType:
    """``pinned`` with the fields that only ``found`` has; types that are pinned stay."""
    if isinstance(pinned, T.StructType) and isinstance(found, T.StructType):
        own = {f.name: f.dataType for f in pinned.fields}
        new = {f.name: f.dataType for f in found.fields}
        kept = [T.StructField(n, merged_schema(k, new[n]) if n in new else k) for n, k in own.items()]
        return T.StructType([*kept, *[T.StructField(n, k) for n, k in new.items() if n not in own]])
    if isinstance(pinned, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(merged_schema(pinned.elementType, found.elementType))
    return pinned


def _path(name: str) -> str:
    if '"' in name and "'" in name:
        raise ValueError(f"a column name with both kinds of quotes cannot be read: {name}")
    return f"$['{name}']" if '"' in name else f'$["{name}"]'


def _fits(value: Column, typed: Column, kind: T.DataType) -> Column:
    """Whether nothing of a value is lost in its column; a value that is missing or null fits."""
    if isinstance(kind, T.StringType):
        return F.lit(True)
    shape = F.schema_of_variant(value)
    if isinstance(kind, T.DoubleType):
        same = shape.isin("BIGINT", "DOUBLE") | shape.startswith("DECIMAL")
    elif isinstance(kind, T.DecimalType):
        same = shape.isin("BIGINT") | shape.rlike(r"^DECIMAL\(\d+,0\)")
    elif isinstance(kind, (T.StructType, T.ArrayType)):
        same = F.to_json(typed) == F.to_json(value)
    else:
        same = shape == F.lit(kind.simpleString().upper())
    return value.isNull() | F.is_variant_null(value) | (typed.isNotNull() & F.coalesce(same, F.lit(False)))


def typed_rows(variants: DataFrame, schema: T.StructType, rescued: str = RESCUED, line: str = "value", column: str = "v") -> DataFrame:
    """The columns of ``schema`` and ``rescued``: a JSON object of all that has no column or does not fit it.

    A value that does not fit is NULL in its column (a nested one keeps the parts that do). A line that is no JSON object is rescued whole.
    """
    value = {f.name: F.try_variant_get(column, _path(f.name), "variant") for f in schema.fields}
    typed = {f.name: F.try_variant_get(column, _path(f.name), f.dataType.simpleString()) for f in schema.fields}
    fits = {f.name: _fits(value[f.name], typed[f.name], f.dataType) for f in schema.fields}
    out = []
    for f in schema.fields:
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType))
        out.append((typed[f.name] if nested else F.when(fits[f.name], typed[f.name])).alias(f.name))
    every = F.try_variant_get(column, "$", "map<string,variant>")
    unfit = F.array_compact(F.array(*[F.when(~ok, F.lit(n)) for n, ok in fits.items()])) if fits else F.array().cast("array<string>")
    known = F.array(*[F.lit(n) for n in schema.names]).cast("array<string>")
    # A key without a column that is only ever null says nothing.
    stray = F.map_filter(every, lambda k, x: F.array_contains(unfit, k) | (~F.array_contains(known, k) & ~F.is_variant_null(x)))
    kept = F.when(every.isNull(), F.col(line)).when(F.size(stray) > 0, F.to_json(stray))
    return variants.select(*out, kept.alias(rescued))


def parsed(lines: DataFrame, line: str = "value", column: str = "v") -> DataFrame:
    """The lines that are not blank, with their VARIANT (NULL where they are no JSON)."""
    return lines.where(F.trim(line) != "").withColumn(column, F.try_parse_json(line))


def pinned_schema(spark: SparkSession, location: str, before: int | None = None) -> T.StructType:
    """The schema as of the last batch, or as it was before a batch; empty where there is none."""
    found = [int(n.split("=")[1]) for n in names(spark, location) if n.startswith("batch_id=")]
    found = sorted(n for n in found if before is None or n < before)
    if not found:
        return T.StructType([])
    text = spark.read.text(f"{location.rstrip('/')}/batch_id={found[-1]}", wholetext=True).first()[0]
    return T.StructType.fromJson(json.loads(text))


def add_json_batch(lines: DataFrame, batch_id: int, folder: str, schema_location: str, evolve: bool = True) -> T.StructType:
    """Write one batch of JSON lines in the schema that it and all batches before it have; a replay gives the same.

    Without ``evolve`` the first batch decides and later columns are rescued.
    """
    spark = lines.sparkSession
    variants = parsed(lines)
    objects = variants.where(F.schema_of_variant("v").startswith("OBJECT"))
    pinned = pinned_schema(spark, schema_location, batch_id)
    schema = merged_schema(pinned, batch_schema(objects)) if evolve or not pinned.fields else pinned
    write_batch(typed_rows(variants, schema), folder, batch_id)
    text = spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
    text.write.mode("overwrite").text(f"{schema_location.rstrip('/')}/batch_id={batch_id}")
    return schema


def ingest_json_evolving(
    spark: SparkSession,
    path: str,
    folder: str,
    schema_location: str,
    checkpoint: str,
    evolve: bool = True,
    max_files_per_batch: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """A stream of JSON lines into ``folder``, each batch inferred from its own files."""
    reader = spark.readStream.option("maxFilesPerTrigger", str(max_files_per_batch)) if max_files_per_batch else spark.readStream
    return each_batch(reader.text(path), lambda b, i: add_json_batch(b.select("value"), i, folder, schema_location, evolve) and None, checkpoint, every)


def evolving_table(spark: SparkSession, folder: str, schema_location: str, rescued: str = RESCUED) -> DataFrame:
    """All batches in the newest schema; a column is NULL in batches older than it."""
    schema = pinned_schema(spark, schema_location)
    whole = T.StructType([*schema.fields, T.StructField(rescued, T.StringType()), T.StructField("batch_id", T.IntegerType())])
    return spark.read.schema(whole).parquet(folder)
