"""Gold aggregates kept by signed changes instead of being computed anew.

A batch of a change feed is reduced map-side to one row a group: what it adds less what it takes away. Counts and sums are added to the
stored ones. A stored maximum stays or grows by what was added; only a group from which a row as great as its maximum was taken
is read again from the table. Groups live in a bucketed table, so a batch reads and writes the buckets of its own groups.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from silverlode.operators.cdc import CHANGE_TYPE
from silverlode.streaming import journal
from silverlode.streaming.buckets import Buckets
from silverlode.streaming.writers import each_batch

COUNT = "row_count"
OPERATION = "ADD CHANGES"


def deltas(feed: DataFrame, group: Sequence[str], sums: Mapping[str, str], maxima: Mapping[str, str]) -> DataFrame:
    """One row for each group of a change feed: signed count and sums, and the greatest values added and taken away.

    Inserts and post-images add, deletes and pre-images take away.
    """
    added = F.col(CHANGE_TYPE).isin("insert", "update_postimage")
    sign = F.when(added, 1).otherwise(-1)
    found = [F.sum(sign).cast("bigint").alias(COUNT)]
    found += [F.coalesce(F.sum(F.expr(text) * sign), F.lit(0)).alias(name) for name, text in sums.items()]
    for name, text in maxima.items():
        found += [F.max(F.when(side, F.expr(text))).alias(f"{name}{label}") for side, label in ((added, "_added"), (~added, "_taken"))]
    return feed.groupBy(*group).agg(*found)


def _same(left: DataFrame, right: DataFrame, group: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[g].eqNullSafe(right[g]) for g in group])


def add_changes(
    feed: DataFrame,
    batch_id: int,
    folder: str,
    group: Sequence[str],
    sums: Mapping[str, str],
    maxima: Mapping[str, str],
    source: Callable[[], DataFrame] | None = None,
    buckets: int = 8,
) -> None:
    """Add one batch of changes to the totals in ``folder``; a replay changes nothing.

    ``sums`` and ``maxima`` go from name to SQL over the feed's columns; sums should be whole or decimal numbers, which subtract exactly.
    ``source`` returns the table as it is after the batch, for groups that lose their maximum.
    """
    spark, group = feed.sparkSession, list(group)
    delta = deltas(feed, group, sums, maxima)
    kinds = {f.name: f.dataType for f in delta.schema.fields}
    fields = [*[T.StructField(g, kinds[g]) for g in group], T.StructField(COUNT, T.LongType())]
    fields += [T.StructField(n, kinds[n]) for n in sums] + [T.StructField(n, kinds[f"{n}_added"]) for n in maxima]
    table = Buckets(spark, f"{folder}/table", tuple(group), buckets)
    touched = table.touched(feed)
    before = table.read(T.StructType(fields), batch_id - 1, touched)
    old = before.select(*[F.col(c).alias(f"_old_{c}") for c in before.columns], F.lit(True).alias("_known"))
    match = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_old_{g}")) for g in group])
    joined = old.join(delta.withColumn("_changed", F.lit(True)), match, "full_outer")
    values = [F.when(F.col("_changed"), F.col(g)).otherwise(F.col(f"_old_{g}")).alias(g) for g in group]
    for name in (COUNT, *sums):
        total = F.coalesce(F.col(f"_old_{name}"), F.lit(0)) + F.coalesce(F.col(name), F.lit(0))
        values.append(total.cast(kinds[name]).alias(name))
    values += [F.greatest(f"_old_{n}", f"{n}_added").alias(n) for n in maxima]
    lost = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"{n}_taken") >= F.col(f"_old_{n}"), F.col(f"{n}_taken").isNotNull()) for n in maxima], F.lit(False))
    rows = joined.select(*values, lost.alias("_lost")).where(F.col(COUNT) != 0)
    recomputed = 0
    if maxima:
        losers = rows.where("_lost").select(*group)
        recomputed = losers.count()
    if recomputed:
        if source is None:
            raise ValueError("a group lost its maximum: the table to read it from is needed")
        own = source()
        own = own.join(losers, _same(own, losers, group), "left_semi").groupBy(*group).agg(*[F.max(F.expr(t)).alias(f"_new_{n}") for n, t in maxima.items()])
        again = own.select(*[F.col(g).alias(f"_g_{g}") for g in group], *[f"_new_{n}" for n in maxima])
        match = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group])
        rows = rows.join(again, match, "left").withColumns({n: F.when(F.col("_lost"), F.col(f"_new_{n}")).otherwise(F.col(n)) for n in maxima})
    if touched:
        table.write(rows.select(*[f.name for f in fields]), batch_id, touched)
    journal.commit(spark, folder, batch_id, OPERATION, {"buckets": buckets, "buckets_written": len(touched), "recomputed": recomputed})


def totals_stream(
    feed: DataFrame,
    folder: str,
    checkpoint: str,
    group: Sequence[str],
    sums: Mapping[str, str],
    maxima: Mapping[str, str],
    source: Callable[[int], DataFrame] | None = None,
    buckets: int = 8,
    every: str | None = None,
) -> StreamingQuery:
    """Keep totals of a streamed change feed; ``source`` gives the table as it is after a batch."""

    def add(batch: DataFrame, batch_id: int) -> None:
        add_changes(batch, batch_id, folder, group, sums, maxima, (lambda: source(batch_id)) if source else None, buckets)

    return each_batch(feed, add, checkpoint, every)


def totals(spark: SparkSession, folder: str, schema: str | T.StructType, group: Sequence[str], batch_id: int | None = None) -> DataFrame:
    """The groups with rows, now or as of a batch: the group's columns, ``row_count``, sums and maxima."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    last = journal.last_batch(spark, folder, 1 << 30 if batch_id is None else batch_id + 1)
    if last is None:
        return spark.createDataFrame([], kind)
    return Buckets(spark, f"{folder}/table", tuple(group), last["counts"]["buckets"]).read(kind, last["batch_id"])
