"""Scalar helpers: time zones, strings, ordered firsts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Text outside these patterns cannot be a number of the kind.
_MAY_PARSE = {
    "int": "^[^0-9]*[0-9]+[^0-9]*$",
    "decimal": "[0-9]",
    "double": "(?i)[0-9]|nan|inf",
}
_KINDS = {
    **dict.fromkeys(("tinyint", "smallint", "int", "integer", "bigint", "long", "short", "byte"), "int"),
    **dict.fromkeys(("decimal", "dec", "numeric"), "decimal"),
    **dict.fromkeys(("float", "real", "double"), "double"),
}


def lenient_cast(value: Column, source: T.DataType, kind: str) -> Column:
    """``try_cast``: NULL where the value does not parse.

    Spark raises and catches an exception for each text that is no number, which makes dirty
    columns some 15 times slower than clean ones. A pattern sorts most of those out first.
    """
    family = _KINDS.get(kind.lower().split("(")[0].strip())
    if isinstance(source, T.StringType) and family:
        value = F.when(value.rlike(_MAY_PARSE[family]), value)
    return value.try_cast(kind)


def from_utc(utc_clock: Column | str, zone: str) -> Column:
    """Wall clock of ``zone`` for a UTC clock time, with the zone's historic daylight rules.

    Both are timestamps without zone, so the session's own zone plays no part.
    """
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_clock)


def to_utc(wall_clock: Column | str, zone: str) -> Column:
    """UTC clock time for a wall clock of ``zone``."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall_clock)


def moment(at: datetime | None) -> Column:
    """A fixed time read in the session's zone, or the current time."""
    return F.lit(at.isoformat(" ")).cast("timestamp") if at is not None else F.current_timestamp()


def strip_quotes(text: Column | str) -> Column:
    return F.regexp_replace(text, '"', "")


def full_name(first: Column | str, last: Column | str) -> Column:
    """Both names with a blank between; NULL where either is missing."""
    return F.concat(first, F.lit(" "), last)


def ordered_first(value: Column | str, *order: Column | str) -> Column:
    """The value of the first row by ``order``: an aggregate that does not depend on arrival."""
    return F.min_by(value, F.struct(*order))


def scaled_sum(value: Column | str, scale: float, digits: int = 2) -> Column:
    return F.round(F.sum(value) / scale, digits)
