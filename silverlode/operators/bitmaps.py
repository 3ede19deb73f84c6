"""Exact distinct ids as mergeable bitmaps: counts and missing ids of layers without reading the layers again.

Ids fall into buckets of 32768, each a bitmap of 4 KiB, built and merged by Spark's own bitmap aggregates. A batch's bitmaps are stored once;
layers are compared bucket by bucket, and only buckets that differ are opened. NULL ids take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32768
BUCKET, BITMAP = "bitmap_bucket", "bitmap"


def bitmaps(rows: DataFrame, id_column: str, *by: str) -> DataFrame:
    """(by, bitmap_bucket, bitmap) of the ids of each group; only bitmaps are shuffled."""
    known = rows.where(F.col(id_column).isNotNull())
    bucket = F.bitmap_bucket_number(id_column).alias(BUCKET)
    return known.groupBy(*by, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_column)).alias(BITMAP))


def merged(stored: DataFrame, *by: str) -> DataFrame:
    """The bitmaps of several batches as one set for each group."""
    return stored.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def distinct_ids(stored: DataFrame, *by: str, name: str = "id_count") -> DataFrame:
    """How many different ids each group has, from bitmaps of any number of batches."""
    return merged(stored, *by).groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count(BITMAP)), F.lit(0)).alias(name))


def _sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each bucket of ``left`` with the bitmap of ``right`` and how many ids both have."""
    both = merged(left).unionByName(merged(right)).groupBy(BUCKET).agg(F.bitmap_and_agg(BITMAP).alias("_both"), F.count("*").alias("_sides"))
    other = merged(right).withColumnRenamed(BITMAP, "_other")
    joined = merged(left).join(both, BUCKET).join(other, BUCKET, "left")
    common = F.when(F.col("_sides") == 2, F.bitmap_count("_both")).otherwise(0)
    return joined.withColumn("_missing", F.bitmap_count(BITMAP) - common)


def missing_count(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row, ``missing``: how many ids of ``left`` are not in ``right``."""
    return _sides(left, right).agg(F.coalesce(F.sum("_missing"), F.lit(0)).alias("missing"))


def _byte(bitmap: str, at: Column) -> Column:
    return F.coalesce(F.conv(F.hex(F.substring(F.col(bitmap), at + 1, F.lit(1))), 16, 10).cast("int"), F.lit(0))


def missing_ids(left: DataFrame, right: DataFrame, name: str = "id") -> DataFrame:
    """The ids of ``left`` that are not in ``right``; bits are looked at only in buckets with a missing one."""
    differing = _sides(left, right).where("_missing > 0").select(BUCKET, BITMAP, "_other")
    opened = differing.select(BUCKET, BITMAP, "_other", F.explode(F.sequence(F.lit(0), F.lit(BITS // 8 - 1))).alias("_at"))
    alone = _byte(BITMAP, F.col("_at")).bitwiseAND(F.bitwise_not(_byte("_other", F.col("_at"))))
    bytes_ = opened.select(BUCKET, "_at", alone.alias("_byte")).where("_byte <> 0")
    bits = bytes_.select(BUCKET, "_at", "_byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("_bit"))
    place = F.col("_at") * 8 + F.col("_bit")
    # Buckets from 1 on hold the ids above 0, the others those up to 0, downwards.
    number = F.when(F.col(BUCKET) > 0, (F.col(BUCKET) - 1) * BITS + place + 1).otherwise(F.col(BUCKET) * BITS - place)
    return bits.where(F.expr("(_byte & shiftleft(1, _bit)) <> 0")).select(number.alias(name))
