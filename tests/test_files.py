from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from silverlode.operators import eventlog, layout
from silverlode.plans import country_cases, loans
from silverlode.sources import files, sinks
from silverlode.sources.storage import Snapshots
from silverlode.streaming.writers import append_stream, append_to_table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write(folder, name, text):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_country_cases_to_csv(spark, folder):
    write(folder, "in/continents.csv", "Continent,Country\nEurope,A\nEurope,B\nAsia,C\n")
    write(
        folder,
        "in/daily-cases.csv",
        "Date,Country,Confirmed,Recovered,Deaths\n2021-01-01,A,9,1,7\n2021-01-02,A,9,1,7\n2021-01-01,B,9,1,7\n"
        "2021-01-01,C,9,1,2\n2021-06-01,C,9,1,99\n2021-01-01,Nowhere,9,1,500\n",
    )
    out = country_cases.run(
        spark, f"{folder}/in/continents*", f"{folder}/in/daily*", f"{folder}/out", "maximum.csv",
        "2021-01-01", "2021-03-31", date(2021, 4, 1),
    )
    assert out == [f"{folder}/out/maximum.csv"]
    lines = Path(out[0]).read_text().splitlines()
    assert lines[0] == "AsOfDate,Continent,CountryWithMax,ContinentMaxDeaths"
    assert sorted(lines[1:]) == [
        "2021-04-01,Asia,C,2", "2021-04-01,Europe,A,7", "2021-04-01,Europe,A,7", "2021-04-01,Europe,B,7",
    ]
    daily = files.read_csv(spark, f"{folder}/in/daily-cases.csv", country_cases.DAILY_SCHEMA)
    countries = files.read_csv(spark, f"{folder}/in/continents.csv", country_cases.REFERENCE_SCHEMA)
    assert [r.Country for r in country_cases.quarantine(daily, countries).collect()] == ["Nowhere"]


def test_published_csv_parts_hold_all_rows(spark, folder):
    df = spark.range(1000).repartition(3)
    parts = sinks.publish_csv(df, folder, "big", single=False)
    assert len(parts) == 3
    assert spark.read.option("header", True).csv(parts).count() == 1000
    zipped = sinks.publish_csv(df, folder, "one.csv.gz", compression="gzip", delimiter="|")
    assert spark.read.option("header", True).csv(zipped).count() == 1000
    sinks.publish_csv(df.limit(5), folder, "one.csv.gz", compression="gzip")
    assert spark.read.option("header", True).csv(zipped).count() == 5


def test_loans(spark):
    treatments = spark.createDataFrame([(0, "a"), (1, "b")], "id long, accounting_treatment string")
    schema = (
        "accounting_treatment_id int, next_payment_date date, balance long, arrears_balance long, "
        "cost_center_code string, country_code string, count int"
    )
    day = date(2021, 5, 1)
    good = [(0, day, 10, 1, "c1", "DE", 1), (1, date(2019, 1, 1), 5, 1, "c1", "FR", 2), (8, day, 7, 1, "c2", "DE", 3)]
    drop = [(0, day, 10, 0, "c1", "DE", 4), (0, day, None, 1, "c1", "DE", 4)]
    clean = loans.cleaned_transactions(spark.createDataFrame(good + drop, schema), treatments)
    assert rows(clean.select("balance", "accounting_treatment")) == [(10, 0), (5, 1)]
    history = spark.createDataFrame([(10, "DE"), (3, "NY"), (4, "NY")], "revol_bal long, addr_state string")
    assert rows(loans.total_balances(clean, history)) == [(10, "DE"), (5, "FR"), (7, "NY")]
    assert rows(loans.balances_by_cost_center(clean)) == [("c1", 15)]
    assert rows(loans.counts_by_country(clean)) == [("DE", 1), ("FR", 2)]
    with pytest.raises(Exception, match="CostCenterSpecified"):
        bad = spark.createDataFrame([(0, day, 10, 0, None, "DE", 1)], schema)
        loans.cleaned_transactions(bad, treatments).collect()


def test_event_log(spark):
    def definition(name, inputs, text):
        return (
            '{"flow_definition":{"output_dataset":"%s","input_datasets":[%s],"flow_type":"COMPLETE",'
            '"schema":[{"name":"id"}],"explain_text":"%s"}}' % (name, inputs, text)
        )

    progress = (
        '{"flow_progress":{"metrics":{"num_output_rows":5},"data_quality":{"dropped_records":1,"expectations":'
        '[{"name":"r","dataset":"d","passed_records":4,"failed_records":1}]}}}'
    )
    log = spark.createDataFrame(
        [
            ("1", "2024-01-01 00:00:00", "flow_definition", definition("t", '"a"', "old")),
            ("2", "2024-01-02 00:00:00", "flow_definition", definition("t", '"a","b"', "new")),
            ("3", "2024-01-01 00:00:00", "flow_definition", definition("u", "", "u")),
            ("4", "2024-01-03 00:00:00", "flow_progress", progress),
            ("5", "2024-01-03 00:00:00", "flow_progress", '{"flow_progress":{"status":"RUNNING"}}'),
            ("6", "2024-01-03 00:00:00", "flow_progress", '{"flow_progress":{"data_quality":{"expectations":[]}}}'),
            ("7", "2024-01-03 00:00:00", "user_action", '{"user_action":{"action":"START"}}'),
        ],
        "id string, timestamp string, event_type string, details string",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert rows(eventlog.latest_lineage(log).select("output_dataset", "explain_text")) == [("t", "new"), ("u", "u")]
    edges = eventlog.lineage(log).select("output_dataset", "input_dataset")
    assert rows(edges) == sorted([("t", "a"), ("t", "a"), ("t", "b"), ("u", None)], key=repr)
    kinds = eventlog.datasets(log).select("output_dataset", "schema", F.dayofmonth("latest_change"))
    assert rows(kinds) == [("t", '[{"name":"id"}]', 2), ("u", '[{"name":"id"}]', 1)]
    metrics = eventlog.expectation_metrics(log).drop("timestamp")
    assert rows(metrics) == [("4", "r", "d", 4, 1)]
    assert rows(eventlog.flow_progress(log).drop("timestamp")) == [("4", 5, 1)]


def test_checked_csv(spark, folder):
    path = write(folder, "c.csv", "id,name\n1,a\nx,b\n3,c\n")
    good, rejects = files.read_csv_checked(spark, path, "id int, name string")
    assert rows(good) == [(1, "a"), (3, "c")]
    assert good.select("name").count() == 2
    assert [r[0] for r in rejects.select("_corrupt_record").collect()] == ["x,b"]
    strict, none = files.read_csv_checked(spark, path, "id int, name string", fail_fast=True)
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        strict.collect()


def test_pinned_schema(spark, folder):
    write(folder, "in/a.json", '{"a": 1, "tags": ["x"]}\n')
    first = files.infer_and_pin_schema(spark, f"{folder}/in", f"{folder}/schema")
    write(folder, "in/b.json", '{"a": 2, "b": "new"}\n')
    assert files.infer_and_pin_schema(spark, f"{folder}/in", f"{folder}/schema") == first
    grown = files.infer_and_pin_schema(spark, f"{folder}/in", f"{folder}/schema", evolve=True)
    assert grown.names == ["a", "tags", "b"]
    assert files.infer_and_pin_schema(spark, f"{folder}/in", f"{folder}/schema") == grown


def test_registry(spark, folder):
    write(folder, "base/Address/a.csv", "line1|city\nMain St|X\n|Y\n")
    registry = spark.createDataFrame(
        [("Address", '{"header":"true","sep":"|"}', '{"has_line": "line1 IS NOT NULL"}')],
        "TableName string, ReadOptions string, Expectations string",
    )
    from silverlode.plans.templates import ingest_registered

    got = ingest_registered(spark, registry, "Address", f"{folder}/base")
    assert rows(got) == [("Main St", "X", []), (None, "Y", ["has_line"])]
    with pytest.raises(KeyError):
        files.registered_source(spark, registry, "Nothing")


def test_tables(spark, folder):
    sinks.overwrite_table(spark.range(3), "gold_numbers", f"{folder}/t", comment="it's small", tier="gold")
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES gold_numbers").collect()}
    assert properties["quality"] == "gold"
    sinks.overwrite_table(spark.range(5), "gold_numbers", f"{folder}/t")
    assert spark.table("gold_numbers").count() == 5
    spark.range(4).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("id long").parquet(f"{folder}/in")
    append_stream(stream, f"{folder}/bronze", f"{folder}/c1", name="bronze")
    sinks.register_table(spark, "bronze_numbers", f"{folder}/bronze")
    assert spark.table("bronze_numbers").count() == 4
    append_to_table(stream, "managed_numbers", f"{folder}/c2")
    assert spark.table("managed_numbers").count() == 4
    query = append_stream(stream, f"{folder}/timed", f"{folder}/c3", every="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{folder}/timed").count() == 4


def test_snapshots(spark, folder):
    versions = Snapshots(spark, f"{folder}/v")
    assert versions.write(spark.range(1)) == 0 and versions.write(spark.range(2)) == 1
    (Path(folder) / "v" / "version=2").mkdir()
    assert versions.versions() == [0, 1]
    assert versions.restore(0) == 2 and versions.read().count() == 1 and versions.read(1).count() == 2
    with pytest.raises(ValueError):
        versions.read(7)


def test_copy_tables(spark, folder):
    spark.range(100).selectExpr("id", "IF(id = 3, NULL, 'x') AS v").write.parquet(f"{folder}/a")
    assert sinks.copy_tables(spark, {"a": f"{folder}/a"}, f"{folder}/backup") == {"a": 100}
    assert spark.read.parquet(f"{folder}/backup/a").count() == 100


def test_a_single_csv_is_written_from_staged_columns(spark, folder):
    df = spark.range(100000).selectExpr("id", "id % 7 AS day", "concat('n', id % 5, ', \"x\"') AS `a b`").repartition(4)
    rows = sinks._one_reader(df, f"{folder}/columns")
    assert rows.rdd.getNumPartitions() == 1
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    found = spark.read.option("header", True).csv(sinks.publish_csv(df, folder, "t.csv"))
    assert sorted(map(tuple, found.collect())) == sorted((str(r.id), str(r.day), r["a b"]) for r in df.collect())
    assert sinks.publish_csv(df.limit(0), folder, "none.csv") and Path(f"{folder}/none.csv").read_text().strip() == "id,day,a b"


def test_publishing_changes_its_form_in_both_directions(spark, folder):
    df = spark.range(100).repartition(2)
    for single, rows in ((False, 100), (True, 7), (True, 9), (False, 60), (True, 5)):
        found = sinks.publish_csv(df.limit(rows) if rows < 100 else df, folder, "t.csv", single=single)
        assert spark.read.option("header", True).csv(found).count() == rows
        assert [p.name for p in Path(folder).iterdir() if not p.name.endswith(".crc")] == ["t.csv"]


def test_compaction_keeps_the_order_of_rows(spark, folder):
    spark.range(0, 40000, 1, 16).write.parquet(f"{folder}/many")
    layout.compact(spark, f"{folder}/many", f"{folder}/few", layout.folder_bytes(spark, f"{folder}/many") // 4)
    spans = spark.read.parquet(f"{folder}/few").groupBy(F.col("_metadata.file_path")).agg(F.min("id"), F.max("id"), F.count("*")).collect()
    assert 3 <= len(spans) <= 5 and all(hi - lo + 1 == n for _, lo, hi, n in spans)


def test_compaction_bounds_the_rows_of_a_file(spark, folder):
    spark.range(0, 40000, 1, 16).write.parquet(f"{folder}/many")
    assert layout.compact(spark, f"{folder}/many", f"{folder}/few", file_rows=5000) == 8
    spans = spark.read.parquet(f"{folder}/few").groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n"))
    assert [(r.lo, r.hi, r.n) for r in spans.orderBy("f").collect()] == [(5000 * k, 5000 * k + 4999, 5000) for k in range(8)]


def test_text_is_clustered_by_whole_values(spark):
    df = spark.range(20000).selectExpr("concat('Customer#', lpad(id, 9, '0')) AS name", "id")
    cells = layout.with_zorder_key(df, ["name"], 6).groupBy("_z").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n"))
    found = cells.orderBy("_z").collect()
    assert len(found) == 64 and all(r.b - r.a + 1 == r.n for r in found)
