"""Country cases: daily counts to the country with the largest count of each continent, as CSV."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.operators.joins import enrich, rows_at_group_max
from silverlode.operators.project import between_dates, with_audit
from silverlode.operators.quality import DROP, Rule, expect, split
from silverlode.sources.files import read_csv, with_file_lineage
from silverlode.sources.sinks import publish_csv

# Schemas, rule name and condition of the country feed.
REFERENCE_SCHEMA = "Continent string, Country string"
DAILY_SCHEMA = "Date date, Country string, Confirmed int, Recovered int, Deaths int"
RULES = (Rule("valid_continent", "Continent IS NOT NULL", DROP),)


def with_continent(daily: DataFrame, countries: DataFrame) -> DataFrame:
    return enrich(daily, countries, {"Country": "Country"}, {"Continent": "Continent"})


def silver(daily: DataFrame, countries: DataFrame, at: datetime | None = None) -> DataFrame:
    """Daily rows with a known continent, with audit columns. Batch or stream."""
    return with_audit(expect(with_continent(daily, countries), RULES), "country_cases", at)


def quarantine(daily: DataFrame, countries: DataFrame) -> DataFrame:
    return split(with_continent(daily, countries), RULES)[1]


def continent_maximum(
    cases: DataFrame, as_of: date | None = None, date_from: str | None = None, date_to: str | None = None
) -> DataFrame:
    """Gold: every row at its continent's largest Deaths inside the date window, ties kept."""
    if date_from or date_to:
        cases = between_dates(cases, "Date", date_from or "0001-01-01", date_to or "9999-12-31")
    return rows_at_group_max(cases, ["Continent"], "Deaths").select(
        (F.lit(as_of) if as_of else F.current_date()).alias("AsOfDate"),
        "Continent",
        F.col("Country").alias("CountryWithMax"),
        F.col("Deaths").alias("ContinentMaxDeaths"),
    )


def run(
    spark: SparkSession,
    countries_path: str,
    daily_path: str,
    out_dir: str,
    out_file: str,
    date_from: str,
    date_to: str,
    as_of: date | None = None,
) -> list[str]:
    """Batch job: CSV in (paths or globs), published CSV out."""
    countries = with_file_lineage(read_csv(spark, countries_path, REFERENCE_SCHEMA))
    daily = with_file_lineage(read_csv(spark, daily_path, DAILY_SCHEMA))
    gold = continent_maximum(silver(daily, countries), as_of, date_from, date_to)
    return publish_csv(gold, out_dir, out_file)
