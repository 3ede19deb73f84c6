"""The customer change files, landed step by step."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest

from silverlode.operators import quality
from silverlode.plans import customers

HEADER = "id,first_name,last_name,email,channel,active,active_end_date,update_dt,update_user"
T1, T2 = "2022-01-13 16:12:42.453", "2022-01-13 16:12:56.379"
T3, T4 = "2022-01-13 16:16:42.453", "2022-01-14 09:01:12"
T5, T6 = "2022-01-14 10:00:01.579", "2022-01-14 11:01:02.179"

STEPS = {
    "step-1.csv": [
        f"1001,Ada,Stone,a@x.org,1,1,9999-12-31,{T1},load",
        f"1002,Bo,Stone,b@x.org,2,1,9999-12-31,{T1},load",
    ],
    "step-2.csv": [
        f"1003,Cy,Reed,c@x.org,2,1,9999-12-31,{T2},load",
        f"1004,Di,Lane,d@x.org,3,1,9999-12-31,{T2},load",
    ],
    "step-3.csv": [f"1002,Bea,Stone,b@x.org,1,1,9999-12-31,{T3},load"],
    "step-4.csv": [f"1002,Bea,Stone,b@x.org,1,0,2022-01-14,{T4},load"],
    "step-5-bad.csv": [
        f"1007,Eve,,e@x.org,,1,9999-12-31,{T5},load",
        f"1008,Flo,Park,f@x.org,0,-1,9999-12-31,{T5},load",
    ],
    "step-6-late.csv": [
        f"1005,Gus,Hill,g@x.org,3,1,9999-12-31,{T6},load",
        f"1006,Hal,Lane,h@x.org,4,1,9999-12-31,{T6},load",
    ],
}
HISTORY = {
    (1001, "ADA", "RETAIL", T1, None),
    (1002, "BO", "WEB", T1, T3),
    (1002, "BEA", "RETAIL", T3, T4),
    (1003, "CY", "WEB", T2, None),
    (1004, "DI", "PARTNER", T2, None),
}


@pytest.fixture(scope="module")
def channels(spark):
    rows = [(1, "RETAIL", "r"), (2, "WEB", "w"), (3, "PARTNER", "p"), (9, "OTHER", "o")]
    return spark.createDataFrame(rows, "channelId int, channelName string, description string")


def land(folder: str, name: str) -> None:
    landing = Path(folder) / "in"
    landing.mkdir(exist_ok=True)
    (landing / name).write_text("\n".join([HEADER, *STEPS[name]]) + "\n")


def run(spark, folder, channels):
    return customers.load_new_files(spark, f"{folder}/in", channels, f"{folder}/out")


def moment(text):
    return datetime.fromisoformat(text) if text else None


def versions(df):
    return {(r.id, r.first_name, r.sales_channel, r.start_at, r.end_at) for r in df.collect()}


def expected(rows):
    return {(i, n, c, moment(s), moment(e)) for i, n, c, s, e in rows}


def test_steps(spark, folder, channels):
    names = list(STEPS)
    land(folder, names[0])
    layers = run(spark, folder, channels)
    assert versions(customers.silver_history(spark, layers)) == expected(
        {(1001, "ADA", "RETAIL", T1, None), (1002, "BO", "WEB", T1, None)}
    )
    for name in names[1:4]:
        land(folder, name)
        layers = run(spark, folder, channels)
    history = customers.silver_history(spark, layers)
    assert versions(history) == expected(HISTORY)
    gold = {(r.sales_channel, r.customer_count) for r in customers.channel_counts(history).collect()}
    assert gold == {("RETAIL", 1), ("WEB", 1), ("PARTNER", 1)}

    land(folder, names[4])
    layers = run(spark, folder, channels)
    silver = customers.silver_history(spark, layers)
    assert {r.id for r in silver.collect()} == {1001, 1002, 1003, 1004, 1007}
    quarantined = {r.id: r.failed_rules for r in spark.read.parquet(layers.quarantine).collect()}
    assert quarantined == {1007: ["valid_channel", "valid_last_name"], 1008: ["valid_active", "valid_channel"]}
    last = spark.read.parquet(layers.metrics).where("batch_id = 4")
    counts = {r.name: (r.passed_records, r.failed_records) for r in last.collect()}
    assert counts == {
        "valid_id": (2, 0),
        "valid_active": (1, 1),
        "valid_channel": (0, 2),
        "valid_first_name": (2, 0),
        "valid_last_name": (1, 1),
        "valid_update_dt": (2, 0),
    }
    assert {r.dropped_records for r in last.collect()} == {1}

    land(folder, names[5])
    landing = spark.read.option("header", True).csv(f"{folder}/in").selectExpr("_metadata.file_name AS input_file_name")
    bronze = spark.read.parquet(layers.bronze)
    missing = quality.not_landed(landing, bronze, "input_file_name")
    assert [r.input_file_name for r in missing.collect()] == [names[5]]

    layers = run(spark, folder, channels)
    assert quality.not_landed(landing, spark.read.parquet(layers.bronze), "input_file_name").count() == 0
    added = {r.id: r.sales_channel for r in customers.silver_history(spark, layers).where("id IN (1005, 1006)").collect()}
    assert added == {1005: "PARTNER", 1006: None}
    before = spark.read.parquet(layers.bronze).count()
    run(spark, folder, channels)
    assert spark.read.parquet(layers.bronze).count() == before == 10


@pytest.mark.parametrize("order", [[0, 1, 3, 2], [3, 2, 1, 0], [0, 1, 2, 3, 2]])
def test_order_and_repeats_do_not_matter(spark, channels, order):
    lines = [line for step in order for line in STEPS[list(STEPS)[step]]]
    rows = [tuple(v or None for v in line.split(",")) for line in lines]
    raw = spark.createDataFrame(rows, customers.LANDING_SCHEMA)
    clean = customers.cleansed(customers.bronze(raw), channels, datetime(2022, 2, 1))
    history = customers.history(customers.silver_changes(clean))
    assert versions(history) == expected(HISTORY)


def test_reference_without_id_fails(spark):
    raw = spark.createDataFrame([("1", "RETAIL", "r"), ("x", "BAD", "b")], customers.REFERENCE_SCHEMA)
    with pytest.raises(Exception, match="valid_channel_id"):
        customers.reference(raw).collect()
