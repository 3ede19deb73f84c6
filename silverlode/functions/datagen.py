"""Synthetic records from a JSON Schema document, generated inside Spark.

Each value is a hash of (row id, seed, field), so the rows do not depend on partitioning and a
lost task regenerates the same ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions.scalar import moment

# The ranges used where the schema names none.
DEFAULT_MINIMUM, DEFAULT_MAXIMUM = -10000, 100000
NUMBER_CENTS = 500
ACCOUNTING_CODES = 9
CODES = ("currency_code", "country_code")
TEXT_LENGTHS = {"isin_code": 12, "reporting_id": 20}
YEARS_BACK, YEARS_AHEAD = 10, 30
WORDS = ("amber", "birch", "cedar", "delta", "ember", "fjord", "grove", "heath", "islet", "juniper")

# The accounting treatments that reference data knows.
TREATMENTS = (
    (0, "held_to_maturity"),
    (1, "available_for_sale"),
    (2, "amortised_cost"),
    (3, "loans_and_recs"),
    (4, "held_for_hedge"),
    (5, "fv_designated"),
)


def country_codes(spark: SparkSession) -> list[str]:
    """All ISO 3166 codes of two letters, as the JVM knows them."""
    return sorted(spark._jvm.java.util.Locale.getISOCountries())


def currency_codes(spark: SparkSession) -> list[str]:
    """All ISO 4217 codes, as the JVM knows them."""
    return sorted(c.getCurrencyCode() for c in spark._jvm.java.util.Currency.getAvailableCurrencies())


def resolved(schema: Mapping, documents: Mapping[str, Mapping] | None = None, within: Mapping | None = None, seen: tuple[str, ...] = ()) -> dict:
    """The schema with what it refers to and inherits put in its place.

    ``$ref`` is a path into the document ("#/definitions/x") or the name of one of ``documents``, with a path or without. The
    properties and required names of every member of ``allOf`` come first, in order, then the schema's own, which win. A
    reference that leads back to itself is an error.
    """
    documents = documents or {}
    within = schema if within is None else within
    if "$ref" in schema:
        name, _, path = schema["$ref"].partition("#")
        document, label = (documents[name], name) if name else (within, f"{id(within)}")
        if f"{label}#{path}" in seen:
            raise ValueError(f"the reference {schema['$ref']} leads back to itself")
        target = document
        for part in filter(None, path.split("/")):
            target = target[part.replace("~1", "/").replace("~0", "~")]
        found = resolved(target, documents, document, (*seen, f"{label}#{path}"))
        rest = {k: v for k, v in schema.items() if k != "$ref"}
        return found | (resolved(rest, documents, within, seen) if rest else {})
    whole: dict = {}
    properties: dict = {}
    required: list[str] = []
    for member in schema.get("allOf", ()):
        part = resolved(member, documents, within, seen)
        whole |= part
        properties |= part.get("properties", {})
        required += [n for n in part.get("required", ()) if n not in required]
    whole |= {k: v for k, v in schema.items() if k != "allOf"}
    properties |= {n: resolved(spec, documents, within, seen) for n, spec in schema.get("properties", {}).items()}
    required += [n for n in schema.get("required", ()) if n not in required]
    return whole | ({"properties": properties} if properties else {}) | ({"required": required} if required else {})


def _draw(field: str, seed: int, size: int) -> Column:
    """A whole number in [0, size)."""
    return F.pmod(F.xxhash64(F.col("_id"), F.lit(seed), F.lit(field)), F.lit(int(size)))


def _choice(field: str, seed: int, options: Sequence) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (_draw(field, seed, len(options)) + 1).cast("int"))


def _text(field: str, seed: int, length: int) -> Column:
    words = [_choice(f"{field}/{i}", seed, WORDS) for i in range(length // 5 + 1)]
    return F.rtrim(F.substring(F.concat_ws(" ", *words), 1, length))


def _iso(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _field(name: str, spec: Mapping, seed: int, at: datetime, choices: Mapping[str, Sequence]) -> Column | None:
    if name == "id":
        return F.col("_id").cast("string")
    if name in choices:
        return _choice(name, seed, choices[name])
    if name == "date":
        return _iso(moment(at))
    for suffix in CODES:
        if name.endswith(suffix):
            return _choice(name, seed, choices[suffix])
    if name == "accounting_treatment_id":
        return _draw(name, seed, ACCOUNTING_CODES).cast("int")
    if name in TEXT_LENGTHS:
        return _text(name, seed, TEXT_LENGTHS[name])
    kind = spec.get("type")
    if kind == "number":
        return _draw(name, seed, NUMBER_CENTS) / F.lit(100.0)
    if kind == "integer":
        low, high = spec.get("minimum", DEFAULT_MINIMUM), spec.get("maximum", DEFAULT_MAXIMUM)
        return _draw(name, seed, max(1, high - low)) + F.lit(low).cast("long")
    if kind == "boolean":
        return _draw(name, seed, 2) == 0
    if kind == "string":
        if "enum" in spec:
            return _choice(name, seed, spec["enum"])
        if spec.get("format") == "date-time":
            start = at - timedelta(days=365 * YEARS_BACK)
            seconds = (YEARS_BACK + YEARS_AHEAD) * 365 * 86400
            return _iso(F.timestamp_seconds(F.unix_seconds(moment(start)) + _draw(name, seed, seconds)))
        return _choice(name, seed, WORDS)
    return None  # arrays and references are not generated


def generate(
    spark: SparkSession,
    schema: Mapping,
    n: int,
    seed: int = 0,
    at: datetime | None = None,
    offset: int = 0,
    choices: Mapping[str, Sequence] | None = None,
    documents: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """``n`` records with global ids from ``offset``; one typed column per generated property."""
    return generate_for(spark.range(offset, offset + n), "id", schema, seed, at, choices, documents)


def generate_for(
    ids: DataFrame,
    key: str,
    schema: Mapping,
    seed: int = 0,
    at: datetime | None = None,
    choices: Mapping[str, Sequence] | None = None,
    documents: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """Records for the given ids (a long column), for example one per row of a large table.

    ``choices`` gives the values of named properties, or of all that end in currency_code or country_code (all ISO codes
    otherwise). ``documents`` are the schemas that this one refers to, by name.
    """
    at = at or datetime(2024, 1, 1)
    spark = ids.sparkSession
    choices = {"currency_code": currency_codes(spark), "country_code": country_codes(spark)} | dict(choices or {})
    whole = resolved(schema, documents)
    columns = {name: _field(name, spec, seed, at, choices) for name, spec in whole["properties"].items()}
    rows = ids.select(F.col(key).cast("long").alias("_id"))
    return rows.select(*[c.alias(name) for name, c in columns.items() if c is not None])


def accounting_treatments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TREATMENTS), "id long, accounting_treatment string")
