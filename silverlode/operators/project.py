"""Row-wise projections: typing, audit columns, defaults, comments, ranges."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.scalar import lenient_cast, moment


def type_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast the named columns; text that does not parse becomes NULL unless ``strict``."""
    cast = {
        name: F.col(name).cast(kind) if strict else lenient_cast(F.col(name), df.schema[name].dataType, kind)
        for name, kind in types.items()
    }
    return df.withColumns(cast)


def select_as(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Project SQL expressions under new names: ``{"new": "expr"}``."""
    return df.select(*[F.expr(text).alias(name) for name, text in mapping.items()])


def except_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def with_audit(df: DataFrame, procedure: str, at: datetime | None = None, principal: str | None = None) -> DataFrame:
    """Ingest time, procedure name and principal; pass ``at`` to get the same rows on each run."""
    return df.withColumns(
        {
            "ingest_dt": moment(at),
            "ingest_procedure": F.lit(procedure),
            "ingest_principal": F.lit(principal) if principal is not None else F.current_user(),
        }
    )


def with_defaults(df: DataFrame, defaults: Mapping[str, Column | object]) -> DataFrame:
    """Fill omitted (missing or NULL) columns, like generated / default columns on insert."""
    filled = {}
    for name, value in defaults.items():
        default = value if isinstance(value, Column) else F.lit(value)
        filled[name] = F.coalesce(F.col(name), default) if name in df.columns else default
    return df.withColumns(filled)


def between_dates(df: DataFrame, column: str, date_from: str | date, date_to: str | date) -> DataFrame:
    """Inclusive date range passed as arguments, never spliced into SQL text.

    The bounds are put on the bare column, so that the range reaches the scan (partition
    pruning, row-group statistics).
    """
    kind = df.schema[column].dataType
    low, high = F.lit(str(date_from)).cast("date"), F.lit(str(date_to)).cast("date")
    if isinstance(kind, T.DateType):
        return df.where(F.col(column).between(low, high))
    return df.where((F.col(column) >= low.cast(kind)) & (F.col(column) < F.date_add(high, 1).cast(kind)))


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    for name, text in comments.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "comment": text})
    return df


def delete_where(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which the condition is TRUE go; FALSE and NULL stay."""
    return df.where(~F.coalesce(F.expr(condition), F.lit(False)))


def update_where(df: DataFrame, condition: str, assignments: Mapping[str, str]) -> DataFrame:
    hit = F.coalesce(F.expr(condition), F.lit(False))
    return df.select(
        *[
            F.when(hit, F.expr(assignments[name]).cast(df.schema[name].dataType)).otherwise(F.col(name)).alias(name)
            if name in assignments
            else F.col(name)
            for name in df.columns
        ]
    )
