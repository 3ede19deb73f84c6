"""Customers: change files to a history with quarantine and counts per sales channel."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from silverlode.operators import cdc, quality
from silverlode.operators.joins import enrich
from silverlode.operators.project import type_columns, with_audit
from silverlode.operators.quality import DROP, FAIL, WARN, Rule
from silverlode.sources.files import ingest_files, stream_table
from silverlode.streaming.history import add_scd2_batch, scd2_table
from silverlode.streaming.writers import append_stream, each_batch, write_batch

# Column types, rules and names of the customer and channel feeds.
TYPES = {"id": "int", "active": "int", "active_end_date": "date", "update_dt": "timestamp"}
LANDING_SCHEMA = (
    "id string, first_name string, last_name string, email string, channel string, "
    "active string, active_end_date string, update_dt string, update_user string"
)
RULES = (
    Rule("valid_id", "id IS NOT NULL", DROP),
    Rule("valid_active", "active BETWEEN 0 AND 1", DROP),
    Rule("valid_channel", "sales_channel IS NOT NULL", WARN),
    Rule("valid_first_name", "first_name IS NOT NULL", WARN),
    Rule("valid_last_name", "last_name IS NOT NULL", WARN),
)
# Ours: a change without a sequence cannot be ordered, so it goes to quarantine and not to the history.
ORDERED = Rule("valid_update_dt", "update_dt IS NOT NULL", DROP)
JUDGED = (*RULES, ORDERED)
KEYS, SEQUENCE, DELETED = ["id"], "update_dt", "active = 0"

REFERENCE_SCHEMA = "channelId string, channelName string, description string"
REFERENCE_RULES = (
    Rule("valid_channel_id", "channelId IS NOT NULL", FAIL),
    Rule("valid_channel_name", "channelName IS NOT NULL", FAIL),
)


def bronze(raw: DataFrame) -> DataFrame:
    return type_columns(raw, TYPES)


def cleansed(typed: DataFrame, channels: DataFrame, at: datetime | None = None) -> DataFrame:
    """Names in upper case, the channel looked up, audit columns added; not judged yet."""
    looked_up = enrich(typed, channels, {"channel": "channelId"}, {"sales_channel": "channelName"}, compare_as="int")
    upper = looked_up.withColumns({c: F.upper(c) for c in ("first_name", "last_name")})
    return with_audit(upper, "customers", at)


def silver_changes(clean: DataFrame) -> DataFrame:
    return quality.expect(clean, JUDGED).drop("channel")


def quarantine(clean: DataFrame) -> DataFrame:
    return quality.split(clean, JUDGED)[1]


def history(changes: DataFrame, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    return cdc.apply_changes_scd2(changes, KEYS, SEQUENCE, DELETED, tiebreak)


def channel_counts(versions: DataFrame) -> DataFrame:
    """Gold: current customers per channel. Closed versions do not count."""
    counted = cdc.current_counts(versions, ["sales_channel"], SEQUENCE)
    return counted.select(
        "sales_channel",
        F.col("current_count").alias("customer_count"),
        F.col("latest_change").alias("most_recent_customer_update_dt"),
    )


def reference(raw: DataFrame, at: datetime | None = None) -> DataFrame:
    """Channel reference rows: a row without id or name stops the load."""
    typed = type_columns(raw, {"channelId": "int"})
    return with_audit(quality.expect(typed, REFERENCE_RULES), "reference", at)


@dataclass(frozen=True)
class Layers:
    """Folders of one customer run."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver_changes"

    @property
    def history(self) -> str:
        return f"{self.root}/silver_history"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


def load_new_files(spark: SparkSession, landing: str, channels: DataFrame, root: str) -> Layers:
    """One triggered update: new landing files go through bronze into silver and quarantine.

    Each silver batch writes its rows, its quarantine and its rule counts under its batch id, so
    that a replay replaces all three. The rules are counted while the rows are written.
    """
    layers = Layers(root)
    append_stream(
        bronze(ingest_files(spark, landing, LANDING_SCHEMA)), layers.bronze, layers.checkpoint("bronze")
    )

    def judge(batch: DataFrame, batch_id: int) -> None:
        clean, seen = cleansed(batch, channels), Observation()
        write_batch(silver_changes(quality.observe(clean, JUDGED, seen)), layers.silver, batch_id)
        written = batch.sparkSession.read.parquet(f"{layers.silver}/batch_id={batch_id}")
        add_scd2_batch(written, batch_id, layers.history, KEYS, SEQUENCE, DELETED)
        write_batch(quarantine(clean), layers.quarantine, batch_id)
        counted = quality.observed_metrics(seen.get, JUDGED, "customers")
        write_batch(batch.sparkSession.createDataFrame(counted, quality.METRICS_SCHEMA), layers.metrics, batch_id)

    each_batch(stream_table(spark, layers.bronze), judge, layers.checkpoint("silver"))
    return layers


def silver_history(spark: SparkSession, layers: Layers) -> DataFrame:
    """The stored history: every batch has brought its own customers up to date."""
    return scd2_table(spark, layers.history, KEYS)
