"""Employees: rows with a department lookup and a count per department."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions.scalar import full_name, moment
from silverlode.operators.joins import enrich
from silverlode.operators.quality import DROP, FAIL, WARN, Rule, expect, with_failed_rules, with_set_measure

# Rule names and conditions of the employee feed.
BRONZE_RULES = (
    Rule("valid_dept_ID", "deptId IS NOT NULL", DROP),
    Rule("valid_first_name", "fname IS NOT NULL", FAIL),
    Rule("valid_last_name", "lname IS NOT NULL", FAIL),
)
SILVER_RULES = (Rule("valid_dept_name", "deptName IS NOT NULL", FAIL),)


def bronze(raw: DataFrame, drop_unknown: bool = True) -> DataFrame:
    """Upper-case names. A missing department id drops the row, or only warns; a missing name fails."""
    rules = BRONZE_RULES
    if not drop_unknown:
        rules = [Rule(r.name, r.condition, WARN) if r.action == DROP else r for r in rules]
    return expect(raw, rules).select(F.upper("fname").alias("fname"), F.upper("lname").alias("lname"), "deptId")


def silver(employees: DataFrame, departments: DataFrame, at: datetime | None = None) -> DataFrame:
    named = enrich(employees, departments, {"deptId": "deptId"}, {"deptName": "deptName"})
    return expect(named, SILVER_RULES).select(
        full_name("fname", "lname").alias("full_name"),
        "deptName",
        moment(at).alias("update_dt"),
    )


def count_by_department(employees: DataFrame) -> DataFrame:
    return employees.groupBy("deptName").agg(F.count(F.lit(1)).alias("emp_count"))


def row_and_set_rules(action: str = WARN) -> tuple[Rule, Rule]:
    return (
        Rule("valid_hire_date", "hire_date < update_dt", action),
        Rule("no_multiple_managers", "manager_count <= 1", action),
    )


def row_and_set_checked(employees: DataFrame, action: str = WARN, source: DataFrame | None = None) -> DataFrame:
    """Every row with its department's manager count and the names of the rules it breaks.

    The set rule judges all rows of a department with two managers; none is no violation. A stream
    of ``employees`` is judged against ``source``, the table of all of them.
    """
    counted = with_set_measure(employees, ["department"], "position = 'Manager'", "manager_count", source)
    return with_failed_rules(expect(counted, row_and_set_rules(action)), row_and_set_rules(action))
