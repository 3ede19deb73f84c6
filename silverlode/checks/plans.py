"""Whole bronze / silver / gold compositions over the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.checks.registry import check, table
from silverlode.plans import country_cases, customers, employees, loans, templates


def _loans(spark: SparkSession, folder: str) -> DataFrame:
    transactions = table(spark, folder, "lineitem").select(
        F.col("l_linenumber").alias("accounting_treatment_id"),
        F.col("l_shipdate").alias("next_payment_date"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("balance"),
        F.round(F.col("l_discount") * 100).cast("long").alias("arrears_balance"),
        F.col("l_linestatus").alias("cost_center_code"),
        F.col("l_returnflag").alias("country_code"),
        F.col("l_quantity").cast("long").alias("count"),
    )
    return loans.cleaned_transactions(transactions, table(spark, folder, "region").select(F.col("r_regionkey").alias("id")))


CLEAN_LOANS = """SELECT CAST(round(l_extendedprice * 100) AS BIGINT) AS balance, l_linestatus, l_returnflag, l_quantity
    FROM lineitem JOIN region ON l_linenumber = r_regionkey
    WHERE round(l_extendedprice * 100) > 0 AND round(l_discount * 100) > 0"""


@check(
    f"""SELECT CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS bal, o_orderstatus AS location_code
    FROM orders GROUP BY o_orderstatus
    UNION SELECT CAST(sum(balance) AS BIGINT), l_returnflag FROM ({CLEAN_LOANS}) c GROUP BY l_returnflag"""
)
def plan_loans(spark: SparkSession, folder: str) -> DataFrame:
    history = table(spark, folder, "orders").select(
        F.round(F.col("o_totalprice") * 100).cast("long").alias("revol_bal"), F.col("o_orderstatus").alias("addr_state")
    )
    return loans.total_balances(_loans(spark, folder), history)


@check(
    f"""SELECT 'cost_center' AS view, l_linestatus AS code, CAST(sum(balance) AS BIGINT) AS total
    FROM ({CLEAN_LOANS}) c GROUP BY 1, 2
    UNION ALL SELECT 'country', l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT)
    FROM ({CLEAN_LOANS}) c GROUP BY 1, 2"""
)
def plan_loans_views(spark: SparkSession, folder: str) -> DataFrame:
    clean = _loans(spark, folder)
    by_center = loans.balances_by_cost_center(clean).select(
        F.lit("cost_center").alias("view"), F.col("cost_center_code").alias("code"), F.col("total_balance").alias("total")
    )
    by_country = loans.counts_by_country(clean).select(
        F.lit("country").alias("view"), F.col("country_code").alias("code"), F.col("total_count").alias("total")
    )
    return by_center.unionByName(by_country)


# Orders as customer change rows: finished orders delete, open ones update, the others carry an
# invalid flag; priorities 1 to 5 are channel codes of which 5 is unknown.
CUSTOMER_CHANGES = """
    SELECT CAST(o_custkey AS STRING) AS id, concat('c', CAST(o_custkey AS STRING)) AS first_name,
           CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderstatus END AS last_name,
           CAST(o_orderkey AS STRING) AS email, substring(o_orderpriority, 1, 1) AS channel,
           CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '1' ELSE '-1' END AS active,
           '9999-12-31' AS active_end_date, o_orderdate AS update_dt, 'loader' AS update_user
    FROM orders"""


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    raw = spark.sql(CUSTOMER_CHANGES.replace("FROM orders", "FROM {orders}"), orders=table(spark, folder, "orders"))
    channels = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("channelId"), F.col("r_name").alias("channelName")
    )
    return customers.cleansed(customers.bronze(raw), channels)


CLEAN_CUSTOMERS = f"""
    SELECT CAST(id AS INTEGER) AS id, upper(first_name) AS first_name, upper(last_name) AS last_name, email,
           r_name AS sales_channel, CAST(active AS INTEGER) AS active, update_dt
    FROM ({CUSTOMER_CHANGES}) c LEFT JOIN region ON CAST(channel AS INTEGER) = r_regionkey"""

CUSTOMER_HISTORY = f"""
    SELECT * EXCLUDE (nxt), update_dt AS start_at, nxt AS end_at FROM (
        SELECT *, lead(update_dt) OVER (PARTITION BY id ORDER BY update_dt) AS nxt FROM (
            SELECT * EXCLUDE (rn) FROM (
                SELECT *, row_number() OVER (PARTITION BY id, update_dt ORDER BY email DESC) AS rn
                FROM ({CLEAN_CUSTOMERS}) c WHERE active BETWEEN 0 AND 1) n WHERE rn = 1) u) v
    WHERE active <> 0"""


@check(f"SELECT * FROM ({CUSTOMER_HISTORY}) h")
def plan_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Change rows to SCD2 versions; of two changes at one time the greater e-mail text wins."""
    versions = customers.history(customers.silver_changes(_customers(spark, folder)), ("email",))
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("update_dt", "start_at", "end_at")}
    return versions.withColumns(times).select(
        "id", "first_name", "last_name", "email", "sales_channel", "active", "update_dt", "start_at", "end_at"
    )


@check(
    f"""SELECT id, first_name, last_name, sales_channel, active, concat_ws(',',
            CASE WHEN coalesce(active BETWEEN 0 AND 1, FALSE) THEN NULL ELSE 'valid_active' END,
            CASE WHEN sales_channel IS NULL THEN 'valid_channel' END,
            CASE WHEN last_name IS NULL THEN 'valid_last_name' END) AS failed
    FROM ({CLEAN_CUSTOMERS}) c
    WHERE NOT coalesce(active BETWEEN 0 AND 1, FALSE) OR sales_channel IS NULL OR last_name IS NULL"""
)
def plan_customers_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    bad = customers.quarantine(_customers(spark, folder))
    return bad.select(
        "id", "first_name", "last_name", "sales_channel", "active", F.concat_ws(",", "failed_rules").alias("failed")
    )


@check(
    f"""SELECT sales_channel, count(*) AS customer_count, max(update_dt) AS most_recent_customer_update_dt
    FROM ({CUSTOMER_HISTORY}) h WHERE end_at IS NULL GROUP BY sales_channel"""
)
def plan_channel_counts(spark: SparkSession, folder: str) -> DataFrame:
    versions = customers.history(customers.silver_changes(_customers(spark, folder)), ("email",))
    latest = "most_recent_customer_update_dt"
    return customers.channel_counts(versions).withColumn(latest, F.col(latest).cast("timestamp_ntz"))


@check("SELECT CAST(n_nationkey AS INTEGER) AS channelId, n_name AS channelName, 'reference' AS ingest_procedure FROM nation")
def plan_reference(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("string").alias("channelId"), F.col("n_name").alias("channelName")
    )
    return customers.reference(raw).select("channelId", "channelName", "ingest_procedure")


@check("SELECT upper(n_name) AS \"deptName\", count(*) AS emp_count FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def plan_employees(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("fname"), F.col("c_name").alias("lname"), F.col("c_nationkey").alias("deptId")
    )
    departments = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("deptId"), F.upper("n_name").alias("deptName")
    )
    return employees.count_by_department(employees.silver(employees.bronze(raw), departments))


@check(
    """WITH m AS (SELECT c_nationkey AS d, count(*) AS n FROM customer WHERE c_mktsegment = 'MACHINERY' GROUP BY 1)
    SELECT c_custkey, coalesce(n, 0) AS manager_count, concat_ws(',',
        CASE WHEN c_acctbal < 5000 THEN NULL ELSE 'valid_hire_date' END,
        CASE WHEN coalesce(n, 0) <= 1 THEN NULL ELSE 'no_multiple_managers' END) AS failed
    FROM customer LEFT JOIN m ON c_nationkey = d"""
)
def plan_row_and_set(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as staff of their nation: a balance over 5000 stands for a late hire date."""
    staff = table(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_nationkey").alias("department"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "Manager").otherwise("Member").alias("position"),
        F.when(F.col("c_acctbal") < 5000, F.lit("2020-01-01")).otherwise("2030-01-01").cast("date").alias("hire_date"),
        F.lit("2024-01-01").cast("date").alias("update_dt"),
    )
    judged = employees.row_and_set_checked(staff)
    return judged.select("c_custkey", "manager_count", F.concat_ws(",", "failed_rules").alias("failed"))


CASES = """SELECT CAST(o_orderdate AS DATE) AS "Date", n_name AS "Country", CAST(floor(o_totalprice) AS INTEGER) AS "Deaths",
        r_name AS "Continent"
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"""


@check(
    f"""WITH c AS ({CASES}), m AS (SELECT "Continent" AS k, max("Deaths") AS d FROM c GROUP BY 1)
    SELECT DATE '2024-01-01' AS "AsOfDate", "Continent", "Country" AS "CountryWithMax", "Deaths" AS "ContinentMaxDeaths"
    FROM c JOIN m ON "Continent" = k AND "Deaths" = d"""
)
def plan_country_cases(spark: SparkSession, folder: str) -> DataFrame:
    nation, customer = table(spark, folder, "nation"), table(spark, folder, "customer")
    homes = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    daily = table(spark, folder, "orders").join(homes, F.col("o_custkey") == F.col("c_custkey")).select(
        F.to_date("o_orderdate").alias("Date"), F.col("n_name").alias("Country"), F.floor("o_totalprice").cast("int").alias("Deaths")
    )
    region = table(spark, folder, "region")
    countries = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("Continent"), F.col("n_name").alias("Country")
    )
    cases = country_cases.silver(daily, countries)
    return country_cases.continent_maximum(cases, date(2024, 1, 1), "1996-01-01", "1999-12-31")


@check("SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier")
def plan_from_template(spark: SparkSession, folder: str) -> DataFrame:
    def counted(name: str) -> DataFrame:
        return table(spark, folder, name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))

    made = templates.from_template(["customer", "supplier"], counted)
    return made["customer"].unionByName(made["supplier"])
