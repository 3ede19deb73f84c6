"""Change data capture on plain tables: latest rows, merge, SCD 1 and 2, change feeds.

Shared rules: rows with a NULL key or NULL sequence never take part (``unusable`` returns
them); rows with equal (key, sequence) collapse to the greatest by tie-break and then by
their other columns; a delete condition that is NULL is not a delete.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators.skew import KEY_HASH, SHARE, SLICE, Slices, add_slices

CHANGE_TYPE = "change_type"
COMMIT_VERSION = "commit_version"


def _all_present(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _is_true(condition: str | None) -> Column:
    return F.coalesce(F.expr(condition), F.lit(False)) if condition else F.lit(False)


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _rank_columns(df: DataFrame, keys: Sequence[str], seq: str, tiebreak: Sequence[str]) -> list[str]:
    first = [seq, *[t for t in tiebreak if t != seq]]
    rest = [c for c in df.columns if c not in {*keys, *first} and _orderable(df.schema[c].dataType)]
    return [*first, *rest]


def is_usable(keys: Sequence[str], seq: str) -> Column:
    return _all_present([*keys, seq])


def usable(changes: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return changes.where(is_usable(keys, seq))


def unusable(changes: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Rows that cannot be ordered or matched; meant for quarantine."""
    return changes.where(~is_usable(keys, seq))


def latest_per_key(
    changes: DataFrame, keys: Sequence[str], seq: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key, batch or streaming.

    One aggregate of the largest row struct: every map task first reduces its rows to one
    per key, so a key with a third of all rows costs one row per task in the shuffle.
    """
    return _greatest_row(usable(changes, keys, seq), keys, _rank_columns(changes, keys, seq, tiebreak))


def _greatest_row(df: DataFrame, keys: Sequence[str], ranked: Sequence[str]) -> DataFrame:
    unordered = [c for c in df.columns if c not in {*keys, *ranked}]
    row = F.struct(*ranked)
    greatest = F.max_by(F.struct(*ranked, *unordered), row) if unordered else F.max(row)
    picked = df.groupBy(*keys).agg(greatest.alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def apply_changes_scd1(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    delete_when: str | None = None,
    tiebreak: Sequence[str] = (),
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """Current rows by sequence, deleted keys left out. A late, older row never wins.

    On a stream the state holds one row per key seen; the tombstone of a deleted key stays
    there, so an older upsert that arrives afterwards cannot bring the key back.
    """
    latest = latest_per_key(changes, keys, seq, tiebreak)
    return latest.where(~_is_true(delete_when)).drop(*except_columns)


def apply_changes_scd2(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    delete_when: str | None = None,
    tiebreak: Sequence[str] = (),
    except_columns: Sequence[str] = (),
    hot_keys: bool = False,
    share: float = SHARE,
) -> DataFrame:
    """One row per version with ``start_at`` (inclusive) and ``end_at`` (exclusive, NULL = open).

    A delete closes the version before it and makes no row. The whole history is one
    shuffle and one sort by key. With ``hot_keys``, at any size, keys with more than ``share`` of all
    rows are combined map-side and cut into ranges of the sequence first, which takes two more
    passes: the caller's choice for a log in which single keys may hold much of it.
    """
    keys = list(keys)
    rows = usable(changes, keys, seq)
    slices = add_slices(rows, keys, seq, share) if hot_keys else Slices(rows.withColumn(SLICE, F.lit(0)))
    ranked = _rank_columns(changes, keys, seq, tiebreak)
    rows = _combine_copies(slices, keys, ranked) if slices.copies else slices.rows
    in_order = Window.partitionBy(*keys, SLICE).orderBy(*ranked)
    following = F.lead(seq).over(in_order)
    # Copies with the same (key, sequence) are neighbours; only the last of them has a
    # different successor. Equal pairs always share a slice.
    versions = rows.withColumn("_next", following).where(F.col("_next").isNull() | (F.col("_next") != F.col(seq)))
    if slices.heavy:
        versions = _next_across_slices(slices, versions, keys, seq)
    return versions.where(~_is_true(delete_when)).select(
        *[c for c in changes.columns if c not in except_columns],
        F.col(seq).alias("start_at"),
        F.col("_next").alias("end_at"),
    )


def _combine_copies(slices: Slices, keys: Sequence[str], ranked: Sequence[str]) -> DataFrame:
    """Collapse equal (key, sequence) rows of heavy keys by a map-side combined aggregate.

    Without it a re-delivered file with a third of all rows could meet in one slice.
    """
    same = [*keys, ranked[0], SLICE, KEY_HASH]
    combined = _greatest_row(slices.rows.where(slices.is_heavy()), same, [*ranked[1:]] or [ranked[0]])
    return slices.rows.where(~slices.is_heavy()).unionByName(combined)


def _next_across_slices(slices: Slices, versions: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The last row of a slice is followed by the first row of the key's next slice."""
    starts = slices.rows.where(slices.is_heavy()).groupBy(*keys, SLICE).agg(F.min(seq).alias("_first"))
    by_slice = Window.partitionBy(*keys).orderBy(SLICE)
    # One row per slice of a heavy key: at most 2 / share rows, so the broadcast is bounded.
    stitched = starts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(SLICE).alias("_k_slice"),
        F.lead("_first").over(by_slice).alias("_then"),
    )
    match = reduce(
        lambda a, b: a & b,
        [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)],
        F.col(SLICE) == F.col("_k_slice"),
    )
    return versions.join(F.broadcast(stitched), match, "left").withColumn("_next", F.coalesce("_next", "_then"))


def refresh_scd2(
    history: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    seq: str,
    delete_when: str | None = None,
    tiebreak: Sequence[str] = (),
    except_columns: Sequence[str] = (),
    hot_keys: bool = False,
) -> DataFrame:
    """Bring an SCD2 history up to date after ``batch`` was appended to ``log``.

    Only keys of the batch are recomputed; the other versions pass through.
    """
    keys = list(keys)
    touched = usable(batch, keys, seq).select(*keys).distinct()
    again = log.join(touched, keys, "left_semi")
    fresh = apply_changes_scd2(again, keys, seq, delete_when, tiebreak, except_columns, hot_keys)
    return history.join(touched, keys, "left_anti").unionByName(fresh)


def merge_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    delete_when: str,
    seq: str | None = None,
    tiebreak: Sequence[str] = (),
    null_operation: str = "skip",
) -> DataFrame:
    """MERGE of a change batch into a keyed target.

    Matched and delete -> gone; matched and not delete -> replaced; unmatched and not
    delete -> inserted. Where the delete condition is NULL the change does nothing
    (``null_operation="skip"``) or counts as an upsert (``"upsert"``). With ``seq`` the newest
    change of each key is applied; without it a key that occurs twice raises.

    The target is anti-joined and never re-aggregated: a small batch is broadcast by Spark
    and the target does not move. Unlike the sequence-ordered forms, no sequence is compared
    with the target's rows: give batches in order.
    """
    source = latest_per_key(changes, keys, seq, tiebreak) if seq else require_unique(changes, keys)
    return _merge_unique(target, source, keys, delete_when, null_operation)


def _merge_unique(
    target: DataFrame, source: DataFrame, keys: Sequence[str], delete_when: str, null_operation: str = "skip"
) -> DataFrame:
    keys = list(keys)
    acting = source.withColumn("_delete", F.expr(delete_when))
    if null_operation == "skip":
        acting = acting.where(F.col("_delete").isNotNull())
    else:
        acting = acting.withColumn("_delete", F.coalesce("_delete", F.lit(False)))
    untouched = target.join(acting.select(*keys), keys, "left_anti").select(*target.columns)
    written = acting.where(~F.col("_delete")).select(*target.columns)
    return untouched.unionByName(written)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, one per key; a repeated key makes the query fail when it runs."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    grouped = df.where(_all_present(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"),
        *([F.first(F.struct(*others)).alias("_row")] if others else []),
    )
    # The check sits in a filter, so that no column pruning can remove it.
    message = F.concat(F.lit(f"more than one source row for key ({', '.join(keys)}) = "), F.to_json(F.struct(*keys)))
    single = F.when(F.col("_copies") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return grouped.where(single).select(
        *[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    )


def upsert_columns(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, str],
    insert: Mapping[str, str],
) -> DataFrame:
    """Partial MERGE: set some columns of matched rows, insert some columns of new ones.

    Both maps go from target column to source column; columns not inserted are NULL. Repeated
    source keys raise.
    """
    keys = list(keys)
    wanted = sorted({*update.values(), *insert.values()} - set(keys))
    unique = require_unique(source.select(*keys, *wanted), keys)
    incoming = unique.select(*keys, F.lit(True).alias("_found"), *[F.col(c).alias(f"_s_{c}") for c in wanted])

    def from_source(column: str) -> Column:
        return F.col(column) if column in keys else F.col(f"_s_{column}")

    matched = target.join(incoming, keys, "left").select(
        *[
            F.when(F.col("_found"), from_source(update[c])).otherwise(F.col(c)).alias(c)
            if c in update
            else F.col(c)
            for c in target.columns
        ]
    )
    new = incoming.join(target.select(*keys), keys, "left_anti").select(
        *[
            (from_source(insert[c]) if c in insert else F.col(c) if c in keys else F.lit(None))
            .cast(target.schema[c].dataType)
            .alias(c)
            for c in target.columns
        ]
    )
    return matched.unionByName(new)


def snapshot_diff(
    before: DataFrame, after: DataFrame, keys: Sequence[str], commit_version: int | None = None
) -> DataFrame:
    """Change feed between two snapshots with unique keys.

    Rows of ``after``'s columns plus ``change_type``: insert, delete, and update_preimage with
    update_postimage for a row whose columns differ (NULL-safe). One full outer join.
    """
    keys = list(keys)
    old = before.select(*keys, F.struct(*after.columns).alias("_old"))
    new = after.select(*keys, F.struct(*after.columns).alias("_new"))
    joined = old.join(new, keys, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))

    def change(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))

    pair = F.array(change("update_preimage", "_old"), change("update_postimage", "_new"))
    feed = (
        F.when(F.col("_old").isNull(), F.array(change("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(change("delete", "_old")))
        .otherwise(pair)
    )
    out = joined.select(F.explode(feed).alias("_c")).select("_c.row.*", F.col("_c.kind").alias(CHANGE_TYPE))
    return out if commit_version is None else out.withColumn(COMMIT_VERSION, F.lit(commit_version).cast("long"))


def latest_feed_rows(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest change of each key in a change feed, pre-images ignored.

    A key can have two rows in one version; a post-image or insert then wins over a delete.
    """
    after = feed.where(F.col(CHANGE_TYPE) != "update_preimage")
    order = after.withColumn("_upsert", (F.col(CHANGE_TYPE) != "delete").cast("int"))
    return latest_per_key(order, keys, COMMIT_VERSION, ["_upsert"]).drop("_upsert")


def propagate_changes(
    target: DataFrame, feed: DataFrame, keys: Sequence[str], clean: Mapping[str, str] | None = None
) -> DataFrame:
    """Apply a change feed to a downstream table, cleaning columns on the way (name -> SQL)."""
    latest = latest_feed_rows(feed, keys)
    for name, text in (clean or {}).items():
        latest = latest.withColumn(name, F.expr(text))
    return _merge_unique(target, latest, keys, f"{CHANGE_TYPE} = 'delete'")


def as_of(
    log: DataFrame,
    keys: Sequence[str],
    seq: str,
    at: object,
    delete_when: str | None = None,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The table as it stood at sequence ``at`` (inclusive), from the retained change log.

    The bound is a plain comparison on the sequence column, so it reaches the scan.
    """
    bound = F.lit(at).cast(log.schema[seq].dataType)
    return apply_changes_scd1(log.where(F.col(seq) <= bound), keys, seq, delete_when, tiebreak)


def versions_as_of(history: DataFrame, at: object) -> DataFrame:
    """Rows of an SCD2 history valid at ``at``."""
    bound = F.lit(at).cast(history.schema["start_at"].dataType)
    return history.where((F.col("start_at") <= bound) & (F.col("end_at").isNull() | (F.col("end_at") > bound)))


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col("end_at").isNull())


def current_counts(history: DataFrame, group: Sequence[str], changed_at: str) -> DataFrame:
    """Keys per group with the latest change, over open versions only."""
    return (
        current_rows(history)
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("current_count"), F.max(changed_at).alias("latest_change"))
    )


def erase_keys(tables: Mapping[str, DataFrame], erased: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """Every dependent table without the rows of the erased keys; rows with a NULL key stay."""
    gone = erased.select(*keys).distinct()
    return {name: table.join(gone, list(keys), "left_anti") for name, table in tables.items()}


def change_history(log: DataFrame, version: str, changed_at: str, operations: Mapping[str, str]) -> DataFrame:
    """One row per version: counts of each operation (name -> SQL condition) and its time span."""
    counts = [F.count_if(_is_true(text)).alias(name) for name, text in operations.items()]
    return log.groupBy(version).agg(
        F.count(F.lit(1)).alias("changes"),
        *counts,
        F.min(changed_at).alias("first_change"),
        F.max(changed_at).alias("last_change"),
    )
