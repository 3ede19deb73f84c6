"""Enrichment joins and joins back to a group aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.scalar import lenient_cast
from silverlode.operators.layout import has_map


def enrich(
    facts: DataFrame,
    reference: DataFrame,
    on: Mapping[str, str],
    add: Mapping[str, str],
    how: str = "left",
    compare_as: str | None = None,
    salt: int = 1,
) -> DataFrame:
    """Look up attributes of a reference table; works for a streaming or batch ``facts``.

    ``on`` maps fact column to reference column, ``add`` maps new name to reference column.
    ``compare_as`` casts both key sides (a code kept as text against a numeric id): text that
    does not parse matches nothing. No hint is given: Spark broadcasts the reference where
    its size is under the session's threshold and shuffles otherwise. ``salt`` > 1 spreads
    a hot key of a large shuffled join (a stream has no AQE) over that many tasks, and copies
    the reference as often.
    """
    left_keys = [F.col(k) for k in on]
    right_keys = [F.col(v) for v in on.values()]
    if compare_as:
        left_keys = [lenient_cast(F.col(k), facts.schema[k].dataType, compare_as) for k in on]
        right_keys = [lenient_cast(F.col(v), reference.schema[v].dataType, compare_as) for v in on.values()]
    names = [f"_key{i}" for i in range(len(on))]
    left = facts.withColumns(dict(zip(names, left_keys)))
    right = reference.select(
        *[k.alias(f"_ref{i}") for i, k in enumerate(right_keys)],
        *[F.col(column).alias(f"_add{i}") for i, column in enumerate(add.values())],
    )
    condition = _all_equal(names, [f"_ref{i}" for i in range(len(on))])
    if salt > 1:
        spread = [f"`{f.name}`" for f in facts.schema.fields if not has_map(f.dataType)]
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salt)))
        right = right.withColumn("_ref_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        condition = condition & (F.col("_salt") == F.col("_ref_salt"))
    return left.join(right, condition, how).select(
        *[F.col(c) for c in facts.columns if c not in add],
        *[F.col(f"_add{i}").alias(name) for i, name in enumerate(add)],
    )


def _all_equal(left: Sequence[str], right: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & (F.col(a) == F.col(b))
    return condition


def star(facts: DataFrame, dimensions: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Inner join of a fact table to dimensions, each given as (frame, fact key, dimension key)."""
    for frame, fact_key, dimension_key in dimensions:
        facts = facts.join(frame, facts[fact_key] == frame[dimension_key])
    return facts


def rows_at_group_max(df: DataFrame, group: Sequence[str], measure: str) -> DataFrame:
    """All rows that equal their group's maximum; ties are kept, NULL groups never match.

    The maxima come from a partially aggregated pass and are joined back by (group, measure). A
    window would leave one task per group; here Spark decides at run time whether the maxima are
    broadcast, so that the facts are not moved.
    """
    top = df.groupBy(*group).agg(F.max(measure).alias("_top"))
    top = top.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_top")
    condition = _all_equal(list(group), [f"_g{i}" for i in range(len(group))]) & (F.col(measure) == F.col("_top"))
    return df.join(top, condition).select(*df.columns)


def top_k(df: DataFrame, k: int, measure: str, tiebreak: Sequence[str]) -> DataFrame:
    """The k largest rows; the tie-break makes the choice unique. Sorted inside each task first."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(t).asc() for t in tiebreak]).limit(k)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """UNION: equal rows, also from different inputs, collapse."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first.distinct()
