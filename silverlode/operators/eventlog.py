"""Analytics over a pipeline event log whose ``details`` column is JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.operators.joins import rows_at_group_max
from silverlode.operators.quality import Rule, count_rules

# The field names of the event log's JSON details.
FLOW_DEFINITION = """flow_definition STRUCT<
    output_dataset: STRING, input_datasets: ARRAY<STRING>, flow_type: STRING,
    schema: STRING, explain_text: STRING>"""
FLOW_PROGRESS = """flow_progress STRUCT<
    metrics: STRUCT<num_output_rows: BIGINT>,
    data_quality: STRUCT<
        dropped_records: BIGINT,
        expectations: ARRAY<STRUCT<
            name: STRING, dataset: STRING, passed_records: BIGINT, failed_records: BIGINT>>>>"""


def _parsed(log: DataFrame, event_type: str, schema: str) -> DataFrame:
    """Events of one type with the fields of their JSON object as columns.

    The filter on the type reaches the scan. The object is unpacked by a generator, which later
    filters and projections are not merged into, so every text is parsed once; events
    without the object give no row.
    """
    rows = log.where(F.col("event_type") == event_type)
    found = F.from_json("details", schema)[event_type]
    return rows.select("id", "timestamp", F.inline(F.array_compact(F.array(found))))


def path(column: str, fields: str) -> Column:
    """A field of JSON text by dotted path; objects and arrays come back as JSON text."""
    return F.get_json_object(column, f"$.{fields}")


def raw_events(log: DataFrame) -> DataFrame:
    return log.orderBy("timestamp", "id")


def definitions(log: DataFrame) -> DataFrame:
    """One row per definition of an output dataset."""
    return _parsed(log, "flow_definition", FLOW_DEFINITION)


def datasets(log: DataFrame) -> DataFrame:
    """Output datasets by flow type and schema with the time of their latest definition."""
    by_schema = definitions(log).groupBy("output_dataset", "flow_type", "schema")
    return by_schema.agg(F.max("timestamp").alias("latest_change"))


def lineage(log: DataFrame) -> DataFrame:
    """One row per (definition, input dataset); a definition without inputs gives a NULL input."""
    return definitions(log).select(
        "timestamp",
        "output_dataset",
        F.explode_outer("input_datasets").alias("input_dataset"),
        "flow_type",
        "schema",
        "explain_text",
    )


def latest_lineage(log: DataFrame) -> DataFrame:
    """Definitions at each output dataset's latest time, ties kept.

    The latest ones are found by the dataset name alone; only they are parsed in full.
    """
    named = log.where(F.col("event_type") == "flow_definition").withColumn(
        "_dataset", path("details", "flow_definition.output_dataset")
    )
    return definitions(rows_at_group_max(named, ["_dataset"], "timestamp"))


def expectation_metrics(log: DataFrame) -> DataFrame:
    """One row per (event, expectation)."""
    progress = _parsed(log, "flow_progress", FLOW_PROGRESS)
    return progress.select("id", "timestamp", F.inline("data_quality.expectations"))


def flow_progress(log: DataFrame) -> DataFrame:
    """Output and dropped row counts; events without metrics are left out."""
    progress = _parsed(log, "flow_progress", FLOW_PROGRESS)
    return progress.where(F.col("metrics").isNotNull()).select(
        "id", "timestamp", "metrics.num_output_rows", "data_quality.dropped_records"
    )


def progress_event(df: DataFrame, rules: Sequence[Rule], dataset: str, at: Column) -> DataFrame:
    """The rule counts of a dataset as one progress event of the log."""
    details = F.struct(
        F.struct(
            F.struct((F.col("row_count") - F.col("dropped_records")).alias("num_output_rows")).alias("metrics"),
            F.struct("dropped_records", "expectations").alias("data_quality"),
        ).alias("flow_progress")
    )
    return count_rules(df, rules, dataset).select(
        F.lit(f"{dataset}-progress").alias("id"),
        at.alias("timestamp"),
        F.lit("flow_progress").alias("event_type"),
        F.lit(f"progress of {dataset}").alias("message"),
        F.lit("METRICS").alias("level"),
        F.to_json(details).alias("details"),
    )
