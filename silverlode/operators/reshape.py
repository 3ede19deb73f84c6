"""Pivot, unpivot, transpose and rollup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PIVOT_VALUES = 1000


def distinct_values(df: DataFrame, column: str, limit: int = MAX_PIVOT_VALUES) -> list:
    """Values to become columns, sorted. More than ``limit`` is an error, never a silent cut."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values; a pivot would need as many columns")
    return sorted(found)


def pivot(
    df: DataFrame,
    group: Sequence[str],
    column: str,
    aggregate: Column,
    values: Sequence | None = None,
    prefix: str = "",
    limit: int = MAX_PIVOT_VALUES,
) -> DataFrame:
    """Pivot one column. Give ``values`` to save the job that lists them; absent ones become NULL.

    Without ``values`` more than ``limit`` of them are an error: raise it for a wider result.
    """
    values = list(values) if values is not None else distinct_values(df, column, limit)
    wide = df.groupBy(*group).pivot(column, values).agg(aggregate)
    return wide.select(*group, *[F.col(f"`{_label(v)}`").alias(f"{prefix}{_label(v)}") for v in values])


def _label(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def most_frequent(df: DataFrame, column: str, n: int) -> list:
    rows = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return [r[0] for r in rows.orderBy(F.desc("count"), F.asc(column)).limit(n).collect()]


def feature_pivot(
    df: DataFrame,
    group: str,
    column: str,
    value: str,
    order: Sequence[str],
    values: Sequence | None = None,
    top_n: int = 10,
    default: float = 3.0,
    prefix: str = "",
) -> DataFrame:
    """One row per group with the first value (by ``order``) of each chosen feature as double.

    Missing cells take ``default``, filled after the pivot: inside the aggregate it would
    never see a cell without rows.
    """
    values = list(values) if values is not None else most_frequent(df, column, top_n)
    first = F.min(F.struct(*order, F.col(value).cast("double").alias("_value")))["_value"]
    wide = pivot(df, [group], column, first, values, prefix)
    return wide.fillna(default, subset=[f"{prefix}{_label(v)}" for v in values])


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns back to rows; NULL cells are left out."""
    return df.unpivot(list(ids), list(columns), name, value).where(F.col(value).isNotNull())


def transpose(
    df: DataFrame,
    row_key: Sequence[str],
    name: str,
    value: str,
    names: Sequence | None = None,
    limit: int = MAX_PIVOT_VALUES,
) -> DataFrame:
    """Name / value rows to one wide row per key; where a name repeats the smallest value is taken."""
    return pivot(df, row_key, name, F.min(value), names, limit=limit)


def rollup_agg(
    df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column] | None = None, grouping_level: bool = True
) -> DataFrame:
    """Subtotals over key prefixes. ``grouping_level`` tells a subtotal's NULL from a data NULL."""
    aggregates = dict(aggregates or {})
    named = [c.alias(n) for n, c in aggregates.items()]
    if grouping_level or not named:
        named.append(F.grouping_id().alias("grouping_level"))
    rolled = df.rollup(*keys).agg(*named)
    return rolled if grouping_level else rolled.select(*keys, *aggregates)


def quarter_pivot(
    facts: DataFrame, group: str, when: str, measure: str, scale: float = 1_000_000, digits: int = 2
) -> DataFrame:
    """Scaled, rounded sums of a measure per group, one column per calendar quarter Q1..Q4."""
    labelled = facts.withColumn("_quarter", F.concat(F.lit("Q"), F.quarter(when).cast("string")))
    total = F.round(F.sum(measure) / scale, digits)
    return pivot(labelled, [group], "_quarter", total, ["Q1", "Q2", "Q3", "Q4"])
