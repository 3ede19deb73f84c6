from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation

from silverlode.operators import quality as q
from silverlode.operators.quality import DROP, FAIL, WARN, Rule
from silverlode.plans import employees
from silverlode.streaming.writers import append_stream

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
RULES = [Rule("has_a", "a IS NOT NULL", DROP), Rule("small_b", "b < 3"), Rule("sum", "a + b < 6", DROP)]
VALUES = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.integers(0, 5))), min_size=1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@FEW
@given(VALUES)
def test_good_and_quarantine_cover_the_input_once(spark, values):
    df = spark.createDataFrame(values, "a int, b int")
    good, bad = q.split(df, RULES, disjoint=True)
    assert sorted(rows(good) + rows(bad.drop("failed_rules")), key=repr) == sorted(values, key=repr)
    for r in q.metrics(df, RULES, "d").collect():
        assert r.passed_records + r.failed_records == len(values)
    kept = [v for v in values if v[0] is not None and v[1] is not None and v[0] + v[1] < 6]
    assert rows(q.expect(df, RULES)) == sorted(kept, key=repr)


def test_fail_beats_drop_and_null_fails(spark):
    df = spark.createDataFrame([(None, 1), (1, 1)], "a int, b int")
    rules = [Rule("has_a", "a IS NOT NULL", DROP), Rule("a_is_set", "a > 0", FAIL)]
    with pytest.raises(Exception, match="a_is_set"):
        q.expect(df, rules).collect()
    with pytest.raises(q.ExpectationFailed, match="a_is_set: 1 rows"):
        q.check_fail_rules(df, rules)
    assert rows(q.expect(df, rules, null_passes=True)) == [(1, 1)]
    q.check_fail_rules(df, rules[:1])


def test_employee_steps(spark, folder):
    schema = "fname string, lname string, deptId int"
    departments = spark.createDataFrame([(1, "ACCOUNTING"), (2, "R&D"), (3, "SALES")], "deptId int, deptName string")
    steps = [
        ([("Al", "Ash", 1), ("Bea", "Bay", 2), ("Cy", "Cole", 3)], 3),
        ([("Di", "Dale", 1), ("Ed", "East", 1), ("Fay", "Ford", 2)], 6),
        ([("Gil", "Gray", 3), ("Hal", "Hill", None), ("Ida", "Ivy", 2)], 8),
    ]

    def load():
        raw = spark.readStream.schema(schema).parquet(f"{folder}/in")
        append_stream(employees.bronze(raw), f"{folder}/bronze", f"{folder}/c")

    for data, expected in steps:
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        load()
        assert spark.read.parquet(f"{folder}/bronze").count() == expected
    spark.createDataFrame([(None, "Jay", None)], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    with pytest.raises(Exception, match="valid_first_name"):
        load()
    assert spark.read.parquet(f"{folder}/bronze").count() == 8
    silver = employees.silver(spark.read.parquet(f"{folder}/bronze"), departments, datetime(2022, 1, 1))
    assert rows(employees.count_by_department(silver)) == [("ACCOUNTING", 3), ("R&D", 3), ("SALES", 2)]
    assert "AL ASH" in {r.full_name for r in silver.collect()}
    kept = employees.bronze(spark.createDataFrame(steps[2][0], schema), drop_unknown=False)
    assert kept.count() == 3


def test_row_and_set_rules(spark):
    staff = spark.createDataFrame(
        [
            (1, "Sales", "Manager", "2022-01-01", "2022-02-01"),
            (2, "Field", "Manager", "2022-01-01", "2022-02-01"),
            (3, "Sales", "Member", "2022-03-01", "2022-02-01"),
            (4, "Field", "Manager", "2022-01-01", "2022-02-01"),
            (5, "Lab", "Member", "2022-01-01", "2022-02-01"),
            (6, None, "Manager", "2022-01-01", "2022-02-01"),
        ],
        "userId int, department string, position string, hire_date string, update_dt string",
    )
    judged = {r.userId: (r.manager_count, r.failed_rules) for r in employees.row_and_set_checked(staff).collect()}
    assert judged == {
        1: (1, []),
        2: (2, ["no_multiple_managers"]),
        3: (1, ["valid_hire_date"]),
        4: (2, ["no_multiple_managers"]),
        5: (0, []),
        6: (0, []),
    }
    assert {r.userId for r in employees.row_and_set_checked(staff, DROP).collect()} == {1, 5, 6}


def test_observed_metrics_match_counted_ones(spark, folder):
    df = spark.createDataFrame([(1, 1), (None, 2), (4, 4)], "a int, b int")
    seen = Observation()
    q.expect(q.observe(df, RULES, seen), RULES).write.parquet(f"{folder}/out")
    want = [r.asDict() for r in q.metrics(df, RULES, "d").collect()]
    assert q.observed_metrics(seen.get, RULES, "d") == want

    df.write.parquet(f"{folder}/in")
    stream = q.observe(spark.readStream.schema(df.schema).parquet(f"{folder}/in"), RULES, "rules")
    query = append_stream(q.expect(stream, RULES), f"{folder}/stream", f"{folder}/c")
    batches = [p.observedMetrics["rules"].asDict() for p in query.recentProgress if "rules" in p.observedMetrics]
    total = {k: sum(b[k] for b in batches) for k in batches[0]}
    assert q.observed_metrics(total, RULES, "d") == want


def test_not_landed_null_rules(spark):
    landing = spark.createDataFrame([("a",), ("b",), (None,)], "f string")
    loaded = spark.createDataFrame([("a",), (None,)], "f string")
    assert rows(q.not_landed(landing, loaded, "f")) == [("b",)]
    assert rows(q.not_landed(landing, loaded, "f", null_empties=True)) == []


def test_unknown_action_is_refused():
    with pytest.raises(ValueError):
        Rule("x", "true", "explode")
    assert Rule("x", "true").action == WARN


@pytest.mark.parametrize("later", ["where", "drop", "join", "semi"])
def test_fail_rule_holds_behind_later_steps(spark, folder, later):
    spark.createDataFrame([(1, "a")], "id long, d string").write.parquet(f"{folder}/in")
    spark.createDataFrame([(None, "b"), (2, "b")], "id long, d string").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    rows = spark.read.parquet(f"{folder}/in")
    other = spark.createDataFrame([("a",)], "d string")
    step = {
        "where": lambda kept: kept.where("d = 'a'"),
        "drop": lambda kept: q.expect(kept, [Rule("only_a", "d = 'a'", DROP)]),
        "join": lambda kept: kept.join(other, "d"),
        "semi": lambda kept: kept.where("id = 1").join(other, "d", "left_semi"),
    }[later]
    with pytest.raises(Exception, match="has_id"):
        step(q.expect(rows, [Rule("has_id", "id IS NOT NULL", FAIL)])).write.parquet(f"{folder}/out")


def test_fail_rule_on_a_stream(spark, folder):
    spark.createDataFrame([(1, "a"), (None, "b")], "id long, d string").write.parquet(f"{folder}/in")
    rows = spark.readStream.schema("id long, d string").parquet(f"{folder}/in")
    kept = q.expect(rows, [Rule("has_id", "id IS NOT NULL", FAIL)]).where("d = 'a'")
    query = kept.writeStream.format("parquet").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start(f"{folder}/out")
    with pytest.raises(Exception, match="has_id"):
        query.awaitTermination()
