"""Loans: raw transactions and history to combined balances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.operators.joins import enrich, union_distinct
from silverlode.operators.quality import DROP, FAIL, WARN, Rule, expect

# Rule names and conditions of the loan feed.
RULES = (
    Rule("PaymentsCurrentYear", "next_payment_date > date'2020-12-31'", WARN),
    Rule("BalancePositive", "balance > 0 AND arrears_balance > 0", DROP),
    Rule("CostCenterSpecified", "cost_center_code IS NOT NULL", FAIL),
)


def cleaned_transactions(transactions: DataFrame, treatments: DataFrame) -> DataFrame:
    """Silver: transactions with a known accounting treatment that pass the rules. Batch or stream."""
    known = enrich(
        transactions,
        treatments,
        {"accounting_treatment_id": "id"},
        {"accounting_treatment": "id"},
        how="inner",
        compare_as="bigint",
    )
    return expect(known, RULES)


def total_balances(cleaned: DataFrame, history: DataFrame) -> DataFrame:
    """Gold: balances per location from both sources; equal (balance, location) pairs collapse."""
    old = history.groupBy("addr_state").agg(F.sum("revol_bal").alias("bal"))
    new = cleaned.groupBy("country_code").agg(F.sum("balance").alias("bal"))
    return union_distinct(
        old.select("bal", F.col("addr_state").alias("location_code")),
        new.select("bal", F.col("country_code").alias("location_code")),
    )


def balances_by_cost_center(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("cost_center_code").agg(F.sum("balance").alias("total_balance"))


def counts_by_country(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("country_code").agg(F.sum("count").alias("total_count"))
