"""Datasets from a template or from a registry row."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from silverlode.operators.quality import expect_all
from silverlode.sources.files import read_registered, registered_source


def from_template(names: Iterable[str], define: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """The same definition for each name, in the order given."""
    return {name: define(name) for name in names}


def ingest_registered(spark: SparkSession, registry: DataFrame, entity: str, base: str) -> DataFrame:
    """Read an entity by its registered options and mark the rules it violates."""
    _, expectations = registered_source(spark, registry, entity)
    return expect_all(read_registered(spark, registry, entity, base), expectations)
