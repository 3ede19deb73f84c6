"""Event-log analytics over a log with one entry per row of the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.checks.registry import check, table
from silverlode.operators import eventlog, quality
from silverlode.operators.eventlog import path
from silverlode.operators.project import select_as
from silverlode.operators.quality import Rule

# The same text builds the log in Spark and in the stating SQL. Views become definitions,
# clicks become progress with two expectations, purchases progress without any, sign-ups
# progress without metrics, errors user actions. Days repeat timestamps, so ties occur.
COLUMNS = {
    "id": "concat('e', CAST(event_id AS STRING))",
    "day": "CAST(CAST(ts AS DATE) AS TIMESTAMP)",
    "event_type": """CASE event_type WHEN 'view' THEN 'flow_definition' WHEN 'error' THEN 'user_action'
        ELSE 'flow_progress' END""",
    "details": """CASE event_type
        WHEN 'view' THEN concat('{"flow_definition":{"output_dataset":"t', CAST(user_id AS STRING),
            '","input_datasets":["raw', CAST(user_id AS STRING), '","ref"],"flow_type":"',
            CASE WHEN value > 50 THEN 'INCREMENTAL' ELSE 'COMPLETE' END,
            '","schema":"s', CAST(length(props) AS STRING), '","explain_text":"plan ',
            CAST(event_id AS STRING), '"}}')
        WHEN 'click' THEN concat('{"flow_progress":{"metrics":{"num_output_rows":', CAST(event_id AS STRING),
            '},"data_quality":{"dropped_records":', CAST(length(props) AS STRING),
            ',"expectations":[{"name":"valid_id","dataset":"t', CAST(user_id AS STRING),
            '","passed_records":', CAST(event_id AS STRING), ',"failed_records":', CAST(user_id AS STRING),
            '},{"name":"valid_k","dataset":"t', CAST(user_id AS STRING),
            '","passed_records":', CAST(user_id AS STRING), ',"failed_records":0}]}}}')
        WHEN 'purchase' THEN concat('{"flow_progress":{"metrics":{"num_output_rows":', CAST(event_id AS STRING),
            '},"data_quality":{"dropped_records":0,"expectations":[]}}}')
        WHEN 'signup' THEN '{"flow_progress":{"status":"QUEUED"}}'
        ELSE '{"user_action":{"action":"RETRY"}}' END""",
}
LOG = "SELECT " + ", ".join(f"{text} AS {name}" for name, text in COLUMNS.items()) + " FROM events"


def _log(spark: SparkSession, folder: str) -> DataFrame:
    log = select_as(table(spark, folder, "events"), COLUMNS)
    return log.select("id", F.col("day").cast("timestamp_ntz").alias("timestamp"), "event_type", "details")


DEFINITIONS = f"""
    SELECT id, day, json_extract_string(details, '$.flow_definition.output_dataset') AS output_dataset,
           json_extract_string(details, '$.flow_definition.flow_type') AS flow_type,
           json_extract_string(details, '$.flow_definition.schema') AS "schema",
           json_extract_string(details, '$.flow_definition.explain_text') AS explain_text,
           json_extract(details, '$.flow_definition.input_datasets') AS inputs
    FROM ({LOG}) l WHERE event_type = 'flow_definition'"""


@check(f"SELECT id, day AS \"timestamp\", event_type, details FROM ({LOG}) l ORDER BY day, id")
def ev_raw(spark: SparkSession, folder: str) -> DataFrame:
    return eventlog.raw_events(_log(spark, folder))


@check(
    f"""SELECT output_dataset, flow_type, "schema", max(day) AS latest_change
    FROM ({DEFINITIONS}) d GROUP BY 1, 2, 3"""
)
def ev_datasets(spark: SparkSession, folder: str) -> DataFrame:
    return eventlog.datasets(_log(spark, folder))


@check(
    f"""SELECT day AS "timestamp", output_dataset, json_extract_string(i.e, '$') AS input_dataset,
           flow_type, "schema", explain_text
    FROM ({DEFINITIONS}) d, unnest(CAST(d.inputs AS JSON[])) AS i(e)"""
)
def ev_lineage(spark: SparkSession, folder: str) -> DataFrame:
    return eventlog.lineage(_log(spark, folder))


@check(
    f"""WITH d AS ({DEFINITIONS}), m AS (SELECT output_dataset AS o, max(day) AS top FROM d GROUP BY 1)
    SELECT id, day AS "timestamp", output_dataset, flow_type, "schema", explain_text,
           'raw' || substr(output_dataset, 2) || ',ref' AS inputs
    FROM d JOIN m ON o = output_dataset AND top = day"""
)
def ev_latest_lineage(spark: SparkSession, folder: str) -> DataFrame:
    latest = eventlog.latest_lineage(_log(spark, folder))
    return latest.withColumn("inputs", F.concat_ws(",", "input_datasets")).drop("input_datasets")


@check(
    f"""SELECT id, day AS "timestamp", json_extract_string(i.e, '$.name') AS name,
           json_extract_string(i.e, '$.dataset') AS dataset,
           CAST(json_extract_string(i.e, '$.passed_records') AS BIGINT) AS passed_records,
           CAST(json_extract_string(i.e, '$.failed_records') AS BIGINT) AS failed_records
    FROM ({LOG}) l, unnest(CAST(json_extract(details, '$.flow_progress.data_quality.expectations') AS JSON[])) AS i(e)
    WHERE event_type = 'flow_progress'"""
)
def ev_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return eventlog.expectation_metrics(_log(spark, folder))


@check(
    f"""SELECT id, day AS "timestamp",
           CAST(json_extract_string(details, '$.flow_progress.metrics.num_output_rows') AS BIGINT) AS num_output_rows,
           CAST(json_extract_string(details, '$.flow_progress.data_quality.dropped_records') AS BIGINT)
               AS dropped_records
    FROM ({LOG}) l WHERE json_extract_string(details, '$.flow_progress.metrics.num_output_rows') IS NOT NULL"""
)
def ev_progress(spark: SparkSession, folder: str) -> DataFrame:
    return eventlog.flow_progress(_log(spark, folder))


@check(
    """SELECT 'events-progress' AS id, 'high_value' AS name, 'events' AS dataset,
           count(*) FILTER (WHERE value > 50) AS passed_records,
           count(*) FILTER (WHERE value IS NULL OR value <= 50) AS failed_records FROM events
    UNION ALL
    SELECT 'events-progress', 'no_error', 'events', count(*) FILTER (WHERE event_type <> 'error'),
           count(*) FILTER (WHERE event_type IS NULL OR event_type = 'error') FROM events"""
)
def ev_written_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of the events table written as a log entry and read back from it."""
    rules = [Rule("high_value", "value > 50"), Rule("no_error", "event_type <> 'error'", quality.DROP)]
    log = eventlog.progress_event(table(spark, folder, "events"), rules, "events", F.lit("2024-02-01").cast("timestamp_ntz"))
    return eventlog.expectation_metrics(log).drop("timestamp")


@check("SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1")
def json_group(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").groupBy(path("props", "k").alias("k")).agg(F.count(F.lit(1)).alias("n"))
