"""A keyed table in hash buckets of which a batch rewrites only those it touches.

A batch writes each touched bucket anew under its own batch id, by dynamic partition overwrite; a reader takes every bucket from its newest batch.
Neighbouring buckets share a folder, of which there are at most ``PARTS``: what is listed, opened and renamed does not grow with the number of
buckets. A batch's files in a folder hold the buckets that it touched there and a marker row for each.
So a replay overwrites its own files, older batches can still be read until they are pruned, and nothing of the other buckets is
read or written. When buckets have grown past ``rows_per_bucket`` on average, the number of buckets doubles: every bucket is split in two in one
rewrite, whose cost is paid back by the batches that filled them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from silverlode.operators import cdc
from silverlode.sources.storage import names, remove
from silverlode.streaming import journal
from silverlode.streaming.writers import each_batch, read_side, write_sides

BUCKET, PART, BATCH, MARK = "_bucket", "_part", "batch_id", "_mark"
PARTS, BLOCKS = 64, 1024
OPERATION = "MERGE"


def bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Buckets:
    """The folder ``folder/buckets=N/_part=p/batch_id=i`` of a keyed table; a part is a bucket while there are at most ``PARTS`` of them."""

    spark: SparkSession
    folder: str
    keys: tuple[str, ...]
    count: int

    @property
    def path(self) -> str:
        return f"{self.folder.rstrip('/')}/buckets={self.count}"

    def placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, bucket_of(self.keys, self.count))

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that the keys of a batch fall into: at most ``count`` numbers."""
        return sorted(r[0] for r in self.placed(rows.select(*self.keys)).select(BUCKET).distinct().collect())

    def part_of(self, bucket: int) -> int:
        return bucket * min(self.count, PARTS) // self.count

    def batches(self, until: int | None = None, parts: set[int] | None = None) -> list[tuple[int, int]]:
        """(part, batch) of the folders there are, not later than ``until``."""
        found = []
        for name in names(self.spark, self.path):
            if not name.startswith(f"{PART}="):
                continue
            part = int(name.split("=")[1])
            if parts is None or part in parts:
                batches = [int(n.split("=")[1]) for n in names(self.spark, f"{self.path}/{name}") if n.startswith(f"{BATCH}=")]
                found += [(part, b) for b in batches if until is None or b <= until]
        return found

    def _rows(self, schema: T.StructType, folders: Sequence[tuple[int, int]]) -> DataFrame:
        extra = [T.StructField(MARK, T.BooleanType()), T.StructField(BUCKET, T.IntegerType()), T.StructField(BATCH, T.IntegerType())]
        reader = self.spark.read.schema(T.StructType([*schema.fields, *extra])).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{PART}={p}/{BATCH}={b}" for p, b in folders])

    def newest(self, folders: Sequence[tuple[int, int]], only: Sequence[int] | None = None) -> DataFrame:
        """(_bucket, batch_id): for each bucket its newest batch among the folders, by the marker rows."""
        found = self._rows(T.StructType([]), folders).where(MARK).groupBy(BUCKET).agg(F.max(BATCH).alias(BATCH))
        if only is None or len(only) == self.count:
            return found
        return found.join(self._numbers(only), BUCKET, "left_semi")

    def _numbers(self, buckets: Sequence[int]) -> DataFrame:
        if isinstance(buckets, range):
            return self.spark.range(buckets.start, buckets.stop).select(F.col("id").cast("int").alias(BUCKET))
        return self.spark.createDataFrame([(int(b),) for b in buckets], f"{BUCKET} int")

    def read(self, schema: T.StructType, until: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of all buckets, or of some, as of a batch."""
        folders = self.batches(until, None if only is None else {self.part_of(b) for b in only})
        if self.count <= PARTS:  # a folder is a bucket: its newest batch has all of it
            rows = self._rows(schema, list(dict(sorted(folders)).items())) if folders else None
        else:
            rows = self._live(schema, folders, only) if folders else None
        if rows is None:
            return self.spark.createDataFrame([], schema)
        return rows.where(f"{MARK} IS NULL").select(*[F.col(f"`{f.name}`") for f in schema.fields])

    def _live(self, schema: T.StructType, folders: Sequence[tuple[int, int]], only: Sequence[int] | None) -> DataFrame | None:
        newest = self.newest(folders, only)
        live = self._live_folders(newest)
        return self._rows(schema, live).join(newest, [BUCKET, BATCH], "left_semi") if live else None

    def _live_folders(self, newest: DataFrame) -> list[tuple[int, int]]:
        """(part, batch) of the folders that are the newest for one of their buckets."""
        part = F.expr(f"cast({BUCKET} * {min(self.count, PARTS)}L div {self.count} as int)")
        return sorted(tuple(r) for r in newest.select(part, BATCH).distinct().collect())

    def write(self, rows: DataFrame, batch_id: int, touched: Sequence[int]) -> None:
        """Write the touched buckets; each gets a marker row, so that one that lost all its rows is new too."""
        marks = self._numbers(touched).withColumn(MARK, F.lit(True))
        marked = self.placed(rows).withColumn(MARK, F.lit(None).cast("boolean")).unionByName(marks, allowMissingColumns=True)
        part = F.expr(f"cast({BUCKET} * {min(self.count, PARTS)}L div {self.count} as int)")
        # Blocks of neighbouring buckets, so that a task writes into few folders, and a folder's files have narrow ranges of buckets.
        block = F.expr(f"{BUCKET} * {min(self.count, BLOCKS)}L div {self.count}")
        dealt = marked.repartition(block).withColumns({PART: part, BATCH: F.lit(batch_id)}).sortWithinPartitions(PART, BATCH, BUCKET)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART, BATCH).parquet(self.path)

    def prune(self, until: int) -> None:
        """Delete the folders of which no reader of batch ``until`` or later takes a bucket."""
        folders = self.batches(until)
        if self.count <= PARTS:
            live = list(dict(sorted(folders)).items())
        else:
            live = self._live_folders(self.newest(folders)) if folders else []
        for part, batch in set(folders) - set(live):
            remove(self.spark, f"{self.path}/{PART}={part}/{BATCH}={batch}")


def merge_batch(
    batch: DataFrame,
    batch_id: int,
    folder: str,
    keys: Sequence[str],
    seq: str,
    delete_when: str,
    tiebreak: Sequence[str] = (),
    buckets: int = 16,
    rows_per_bucket: int = 1_000_000,
    keep_batches: int | None = None,
) -> None:
    """MERGE one batch into the bucketed table in ``folder``; a replay changes nothing.

    The newest change of each key is staged together with the rows that have no key or sequence, as two sides of one write. Only
    buckets with a staged key are read and written. A change whose delete condition is NULL does nothing. The journal row, written last, is the
    commit: its counts hold the rows in, quarantined, staged keys, deletes, rows and buckets written, and the number of buckets from then on.
    """
    keys = list(keys)
    spark = batch.sparkSession
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in batch.schema.fields])
    newest = cdc.latest_per_key(batch, keys, seq, tiebreak).withColumn("_delete", F.expr(delete_when))
    write_sides(newest, cdc.unusable(batch, keys, seq), f"{folder}/staged", batch_id)
    staged = read_staged(spark, folder, schema, batch_id)
    good = staged.where("_side = 'good' AND _delete IS NOT NULL").drop("_side")
    last = journal.last_batch(spark, folder, batch_id)
    target = Buckets(spark, f"{folder}/table", tuple(keys), last["counts"]["buckets"] if last else buckets)
    touched = target.touched(good)
    before = target.read(schema, batch_id - 1, touched)
    merged = before.join(good.select(*keys), keys, "left_anti").unionByName(good.where(~F.col("_delete")).drop("_delete"))
    if touched:
        target.write(merged, batch_id, touched)
    written = target.read(schema, batch_id, touched).count() if touched else 0
    before_rows = last["counts"]["rows"] if last else 0
    rows = before_rows - before.count() + written
    sides = staged.agg(
        F.count_if(F.col("_side") == "quarantine").alias("quarantined"),
        F.count_if(F.col("_side") == "good").alias("keys"),
        F.count_if(F.col("_delete")).alias("deletes"),
    ).first()
    number = target.count
    while rows > number * rows_per_bucket:
        number *= 2
    if number != target.count:
        larger = Buckets(spark, target.folder, target.keys, number)
        larger.write(target.read(schema, batch_id), batch_id, range(number))
    counts = sides.asDict() | {"rows": rows, "rows_written": written, "buckets_written": len(touched), "buckets": number}
    journal.commit(spark, folder, batch_id, OPERATION, counts)
    if keep_batches is not None:
        target.prune(batch_id - keep_batches)


def read_staged(spark: SparkSession, folder: str, schema: T.StructType, batch_id: int) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("_delete", T.BooleanType()), T.StructField("_side", T.StringType())])
    return spark.read.schema(whole).parquet(f"{folder}/staged/batch_id={batch_id}")


def merge_bucketed_stream(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    delete_when: str,
    folder: str,
    checkpoint: str,
    tiebreak: Sequence[str] = (),
    buckets: int = 16,
    rows_per_bucket: int = 1_000_000,
    keep_batches: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """MERGE a stream into a large table: the cost of a batch follows the buckets that it touches."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, folder, keys, seq, delete_when, tiebreak, buckets, rows_per_bucket, keep_batches)

    return each_batch(changes, merge, checkpoint, every)


def bucketed_table(spark: SparkSession, folder: str, keys: Sequence[str], schema: T.StructType, batch_id: int | None = None) -> DataFrame:
    """The merged rows now, or as of a batch that has not been pruned; batches in the making are not seen."""
    last = journal.last_batch(spark, folder, 1 << 30 if batch_id is None else batch_id + 1)
    if last is None:
        return spark.createDataFrame([], schema)
    # Before a doubling the table stood in fewer buckets.
    return Buckets(spark, f"{folder}/table", tuple(keys), last["counts"]["buckets"]).read(schema, last["batch_id"])


def quarantined(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all batches without key or sequence."""
    return read_side(spark, f"{folder}/staged", "quarantine").drop("_delete", BATCH)
