"""SCD2 histories kept by a stream: a batch reads the last change of the keys in its buckets, not the log.

``log`` has every usable change, in hash buckets, each file sorted by key hash with a Bloom filter of it; rows without key or sequence are the
quarantine side of the same write. ``open`` is a bucketed table (``streaming.buckets``) with the last change of every key, deletes
included: the open versions. ``closed`` has the versions that a batch has closed. A key whose changes are all later than its last
one needs nothing else. Only a key with a late change (or one as old as its last) is worked out anew from the log, which is then read in that
key's buckets and, by the filters, in the files that hold it; ``touched`` notes it, and readers take such a key's closed versions from that batch on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from silverlode.operators import cdc
from silverlode.sources.storage import names
from silverlode.streaming import journal
from silverlode.streaming.buckets import BUCKET, Buckets, bucket_of
from silverlode.streaming.writers import SIDE, each_batch, write_batch

BATCH, HASH = "batch_id", "_hash"
LISTED = 1000
OPERATION = "APPLY CHANGES (SCD 2)"


def _logged(spark: SparkSession, folder: str, columns: T.StructType) -> DataFrame:
    """The usable changes of all batches with hash, bucket and batch."""
    extra = [T.StructField(HASH, T.LongType()), T.StructField(BATCH, T.IntegerType()), T.StructField(SIDE, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
    return spark.read.schema(T.StructType([*columns.fields, *extra])).parquet(f"{folder}/log").where(F.col(SIDE) == "good")


def _write_log(batch: DataFrame, batch_id: int, folder: str, keys: Sequence[str], seq: str, buckets: int) -> None:
    good = cdc.is_usable(keys, seq)
    sides = {
        HASH: F.when(good, F.xxhash64(*keys)),
        BUCKET: F.when(good, bucket_of(keys, buckets)).otherwise(-1),
        SIDE: F.when(good, "good").otherwise("quarantine"),
    }
    rows = batch.withColumns(sides).sortWithinPartitions(SIDE, BUCKET, HASH)
    writer = rows.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{HASH}", "true")
    writer.partitionBy(SIDE, BUCKET).parquet(f"{folder}/log/{BATCH}={batch_id}")


def _changes_of(log: DataFrame, late: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The log's rows of the late keys. Up to ``LISTED`` keys are looked up by their hash in the files' filters, then all are joined."""
    hashes = [r[0] for r in late.select(F.xxhash64(*keys)).limit(LISTED + 1).collect()]
    if len(hashes) <= LISTED:
        log = log.where(F.col(HASH).isin(hashes))
    return log.join(late.select(*keys), list(keys), "left_semi")


def add_scd2_batch(
    batch: DataFrame,
    batch_id: int,
    folder: str,
    keys: Sequence[str],
    seq: str,
    delete_when: str | None = None,
    tiebreak: Sequence[str] = (),
    buckets: int = 64,
) -> None:
    """Bring the history in ``folder`` up to date with one batch of changes; a replay of the batch changes nothing."""
    keys = list(keys)
    spark, columns = batch.sparkSession, batch.columns
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in batch.schema.fields])
    _write_log(batch, batch_id, folder, keys, seq, buckets)
    log = _logged(spark, folder, plain).where(F.col(BATCH) <= batch_id)
    own = log.where(F.col(BATCH) == batch_id).select(*columns)
    open_ = Buckets(spark, f"{folder}/open", tuple(keys), buckets)
    # The log and the open versions stand in the same buckets.
    touched = sorted(int(n.split("=")[1]) for n in names(spark, f"{folder}/log/{BATCH}={batch_id}/{SIDE}=good") if n.startswith(f"{BUCKET}="))
    state = open_.read(_state_schema(plain, plain[seq].dataType), batch_id - 1, touched).select(*columns)
    first = own.groupBy(*keys).agg(F.min(seq).alias("_first"))
    judged = first.join(state.select(*keys, F.col(seq).alias("_last")), keys, "left")
    write_batch(judged.select(*keys, F.coalesce(F.col("_first") <= F.col("_last"), F.lit(False)).alias("late")), f"{folder}/touched", batch_id)
    noted = _touched(spark, folder, plain, keys).where(F.col(BATCH) == batch_id)
    late, in_time = (noted.where(F.col("late") == flag).select(*keys) for flag in (True, False))
    counts = noted.agg(F.count("*").alias("keys"), F.count_if("late").alias("late_keys")).first().asDict()
    if counts["late_keys"]:
        found = [r[0] for r in late.select(bucket_of(keys, buckets)).distinct().collect()]  # at most ``buckets`` numbers
        rows = _changes_of(log.where(F.col(BUCKET).isin(found)), late, keys).select(*columns)
        if counts["late_keys"] < counts["keys"]:
            rows = rows.unionByName(state.unionByName(own).join(in_time, keys, "left_semi"))
    else:
        rows = state.join(in_time, keys, "left_semi").unionByName(own)
    versions = cdc.apply_changes_scd2(rows, keys, seq, delete_when, tiebreak)
    write_batch(versions.where("end_at IS NOT NULL"), f"{folder}/closed", batch_id)
    if touched:
        last = cdc.latest_per_key(state.unionByName(own), keys, seq, tiebreak)
        deleted = F.coalesce(F.expr(delete_when), F.lit(False)) if delete_when else F.lit(False)
        open_.write(last.withColumns({"start_at": F.col(seq), "_deleted": deleted}), batch_id, touched)
    journal.commit(spark, folder, batch_id, OPERATION, counts | {"buckets": buckets})


def _touched(spark: SparkSession, folder: str, columns: T.StructType, keys: Sequence[str]) -> DataFrame:
    fields = [*[columns[k] for k in keys], T.StructField("late", T.BooleanType()), T.StructField(BATCH, T.IntegerType())]
    return spark.read.schema(T.StructType(fields)).parquet(f"{folder}/touched")


def scd2_stream(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    folder: str,
    checkpoint: str,
    delete_when: str | None = None,
    tiebreak: Sequence[str] = (),
    buckets: int = 64,
    every: str | None = None,
) -> StreamingQuery:
    """Apply-changes (SCD 2) of a stream into ``folder``; no streaming state is kept."""

    def add(batch: DataFrame, batch_id: int) -> None:
        add_scd2_batch(batch, batch_id, folder, keys, seq, delete_when, tiebreak, buckets)

    return each_batch(changes, add, checkpoint, every)


def scd2_table(spark: SparkSession, folder: str, keys: Sequence[str], batch_id: int | None = None) -> DataFrame:
    """The history now, or as of a batch (``journal.batch_at`` finds the batch of a time); the batch in the making is not seen."""
    keys = list(keys)
    last = journal.last_batch(spark, folder, 1 << 30 if batch_id is None else batch_id + 1)
    if last is None:
        raise ValueError(f"{folder} has no history yet")
    until = last["batch_id"]
    versions = spark.read.parquet(f"{folder}/closed").where(F.col(BATCH) <= until)
    columns = T.StructType([f for f in versions.schema.fields if f.name not in (BATCH, "start_at", "end_at")])
    anew = _touched(spark, folder, columns, keys).where(F.col("late") & (F.col(BATCH) <= until)).groupBy(*keys).agg(F.max(BATCH).alias("_since"))
    closed = versions.join(anew, keys, "left").where(F.col("_since").isNull() | (F.col(BATCH) >= F.col("_since"))).drop(BATCH, "_since")
    end = versions.schema["end_at"].dataType
    open_ = Buckets(spark, f"{folder}/open", tuple(keys), last["counts"]["buckets"])
    state = open_.read(_state_schema(columns, end), until).where(~F.col("_deleted"))
    now = state.select(*columns.names, "start_at", F.lit(None).cast(end).alias("end_at"))
    return closed.select(*columns.names, "start_at", "end_at").unionByName(now)


def _state_schema(columns: T.StructType, kind: T.DataType) -> T.StructType:
    return T.StructType([*columns.fields, T.StructField("start_at", kind), T.StructField("_deleted", T.BooleanType())])


def scd2_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all batches without key or sequence."""
    return spark.read.parquet(f"{folder}/log").where(F.col(SIDE) == "quarantine").drop(HASH, SIDE, BUCKET)


def compact_scd2(spark: SparkSession, folder: str, target: str, keys: Sequence[str], batch_id: int) -> None:
    """The history as of a batch as one batch of a new folder, which a stream that goes on from there may use."""
    last = journal.last_batch(spark, folder, batch_id + 1)
    buckets, keys = last["counts"]["buckets"], list(keys)
    log = spark.read.option("basePath", f"{folder}/log").parquet(f"{folder}/log").where(F.col(BATCH) <= batch_id).drop(BATCH)
    writer = log.sortWithinPartitions(SIDE, BUCKET, HASH).write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{HASH}", "true")
    writer.partitionBy(SIDE, BUCKET).parquet(f"{target}/log/{BATCH}={batch_id}")
    write_batch(scd2_table(spark, folder, keys, batch_id).where("end_at IS NOT NULL"), f"{target}/closed", batch_id)
    columns = T.StructType([f for f in log.schema.fields if f.name not in (HASH, SIDE, BUCKET)])
    write_batch(_touched(spark, folder, columns, keys).drop(BATCH).limit(0), f"{target}/touched", batch_id)
    kind = spark.read.parquet(f"{folder}/closed").schema["end_at"].dataType
    state = Buckets(spark, f"{folder}/open", tuple(keys), buckets).read(_state_schema(columns, kind), batch_id)
    Buckets(spark, f"{target}/open", tuple(keys), buckets).write(state, batch_id, range(buckets))
    journal.commit(spark, target, batch_id, "COMPACT", {"buckets": buckets})
