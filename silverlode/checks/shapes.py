"""Pivot, unpivot, transpose, rollup, layout and generated data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.checks.registry import check, table
from silverlode.functions.datagen import country_codes, currency_codes, generate_for
from silverlode.operators import layout, reshape
from silverlode.session import new_folder


def _sums(group: str, column: str, values: list[str], measure: str, source: str) -> str:
    cells = ", ".join(f"round(sum({measure}) FILTER (WHERE {column} = '{v}'), 2) AS \"{v}\"" for v in values)
    return f"SELECT {group}, {cells} FROM {source} GROUP BY {group}"


@check(_sums("l_suppkey", "l_returnflag", ["A", "N", "R"], "l_quantity", "lineitem"))
def pivot_discovered(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return reshape.pivot(lines, ["l_suppkey"], "l_returnflag", F.round(F.sum("l_quantity"), 2))


@check(_sums("l_suppkey", "l_returnflag", ["R", "A", "X"], "l_quantity", "lineitem"))
def pivot_sum(spark: SparkSession, folder: str) -> DataFrame:
    """Named values in a given order; the absent X is a NULL column."""
    lines = table(spark, folder, "lineitem")
    return reshape.pivot(lines, ["l_suppkey"], "l_returnflag", F.round(F.sum("l_quantity"), 2), ["R", "A", "X"])


@check(_sums("l_suppkey, l_linestatus", "l_returnflag", ["A", "N", "R"], "l_quantity", "lineitem"))
def pivot_two_keys(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    values = ["A", "N", "R"]
    return reshape.pivot(
        lines, ["l_suppkey", "l_linestatus"], "l_returnflag", F.round(F.sum("l_quantity"), 2), values
    )


@check(
    """WITH f AS (SELECT l_orderkey, l_returnflag, l_quantity, row_number() OVER (
            PARTITION BY l_orderkey, l_returnflag ORDER BY l_shipdate, l_linenumber, l_partkey, l_quantity) AS rn
        FROM lineitem)
    SELECT l_orderkey, coalesce(max(l_quantity) FILTER (WHERE l_returnflag = 'A' AND rn = 1), 3.0) AS flag_A,
           coalesce(max(l_quantity) FILTER (WHERE l_returnflag = 'N' AND rn = 1), 3.0) AS flag_N,
           coalesce(max(l_quantity) FILTER (WHERE l_returnflag = 'R' AND rn = 1), 3.0) AS flag_R
    FROM f GROUP BY l_orderkey"""
)
def feature_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return reshape.feature_pivot(
        table(spark, folder, "lineitem"),
        "l_orderkey",
        "l_returnflag",
        "l_quantity",
        ["l_shipdate", "l_linenumber", "l_partkey"],
        values=["A", "N", "R"],
        prefix="flag_",
    )


@check(
    """SELECT l_orderkey, l_linenumber, l_partkey, 'l_quantity' AS measure, l_quantity AS amount FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_discount', nullif(l_discount, 0) FROM lineitem
    WHERE nullif(l_discount, 0) IS NOT NULL"""
)
def unpivot(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    return reshape.unpivot(lines, ids, ["l_quantity", "l_discount"], "measure", "amount")


@check(
    """SELECT user_id, """
    + ", ".join(
        f"min(props) FILTER (WHERE event_type = '{t}') AS \"{t}\""
        for t in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM events GROUP BY user_id"
)
def transpose(spark: SparkSession, folder: str) -> DataFrame:
    """Name / value rows (event type, props) to one wide row per user; names found in the data."""
    return reshape.transpose(table(spark, folder, "events"), ["user_id"], "event_type", "props")


@check(
    """SELECT p_brand, """
    + ", ".join(
        f"round(sum(l_extendedprice) FILTER (WHERE quarter(l_shipdate) = {q}) / 1000000, 2) AS \"Q{q}\""
        for q in (1, 2, 3, 4)
    )
    + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand"
)
def pivot_quarter(spark: SparkSession, folder: str) -> DataFrame:
    sold = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return reshape.quarter_pivot(sold, "p_brand", "l_shipdate", "l_extendedprice")


@check(
    """SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem
    GROUP BY ROLLUP (l_returnflag, l_linestatus, l_linenumber)"""
)
def rollup_keys(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    keys = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return reshape.rollup_agg(lines, keys, grouping_level=False).orderBy(*keys)


@check(
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity, count(*) AS n,
           CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS grouping_level
    FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)"""
)
def rollup_agg(spark: SparkSession, folder: str) -> DataFrame:
    totals = {"quantity": F.round(F.sum("l_quantity"), 2), "n": F.count(F.lit(1))}
    return reshape.rollup_agg(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"], totals)


@check("SELECT * FROM lineitem")
def layout_zorder(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    path = new_folder(spark, "zorder")
    layout.zorder(lines, ["l_partkey", "l_shipdate"], partitions=16).write.parquet(path)
    return spark.read.parquet(path)


@check(
    """SELECT layout, n AS row_count, 64 AS files, TRUE AS skips_enough FROM (SELECT count(*) AS n FROM lineitem) c,
    (VALUES ('hilbert'), ('morton')) AS v(layout)"""
)
def zorder_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Lines clustered by part and date into 64 files along both curves: a filter on either column, and one on a box, skips most files."""
    lines = table(spark, folder, "lineitem")
    columns = ["l_partkey", "l_shipdate"]
    cells = layout.measure_cells(lines, columns, layout.bits_for(64, len(columns)))
    total = lines.agg(F.max("l_partkey").alias("parts")).first()["parts"]
    found = None
    for curve in layout.CURVES:
        path = new_folder(spark, curve)
        layout.cluster(lines, columns, 64, curve, cells=cells).write.parquet(path)
        spans = layout.file_spans(spark, path, columns)
        low = F.col("min_l_partkey") <= total // 20  # a twentieth of the parts lies in few of the files
        late = F.col("max_l_shipdate") >= F.lit("2001-01-01").cast("date")
        both = (F.col("min_l_partkey") <= total // 4) & late
        own = spans.agg(
            F.lit(curve).alias("layout"),
            F.sum("row_count").alias("row_count"),
            F.count("*").cast("int").alias("files"),
            ((F.count_if(low) <= 20) & (F.count_if(late) <= 24) & (F.count_if(both) <= 12)).alias("skips_enough"),
        )
        found = own if found is None else found.unionByName(own)
    return found


@check(
    """SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS place FROM orders"""
)
def layout_compact_order(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty-four sorted files compacted into a few: every row has the place that it had."""
    root = new_folder(spark, "compact")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    orders.repartitionByRange(24, "o_orderdate", "o_orderkey").sortWithinPartitions("o_orderdate", "o_orderkey").write.parquet(f"{root}/many")
    layout.compact(spark, f"{root}/many", f"{root}/few", file_bytes=layout.folder_bytes(spark, f"{root}/many") // 3)
    rows = spark.read.parquet(f"{root}/few").withColumns({"_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")})
    sizes = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    bases = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return rows.join(bases, "_file").select("o_orderkey", "o_orderdate", (F.col("_base") + F.col("_row")).alias("place"))


@check("SELECT * FROM orders")
def layout_compact(spark: SparkSession, folder: str) -> DataFrame:
    root = new_folder(spark, "compact")
    table(spark, folder, "orders").repartition(24).write.parquet(f"{root}/many")
    layout.compact(spark, f"{root}/many", f"{root}/few")
    return spark.read.parquet(f"{root}/few")


SCHEMA = {
    "properties": {
        "id": {"type": "string"},
        "date": {"type": "string", "format": "date-time"},
        "accounting_treatment_id": {"type": "integer"},
        "balance": {"type": "integer", "minimum": 1, "maximum": 5000},
        "rate": {"type": "number"},
        "status": {"type": "string", "enum": ["active", "closed", "default"]},
        "next_payment_date": {"type": "string", "format": "date-time"},
        "secured": {"type": "boolean"},
        "country_code": {"type": "string"},
        "tags": {"type": "array", "items": {"type": "string"}},
    }
}


@check(
    """SELECT count(*) AS records, count(DISTINCT o_orderkey) AS ids, count(*) AS in_range, 3 AS statuses,
           9 AS codes FROM orders"""
)
def datagen(spark: SparkSession, folder: str) -> DataFrame:
    """One generated record per order; counts, ranges and choices are what the schema says."""
    rows = generate_for(table(spark, folder, "orders"), "o_orderkey", SCHEMA, seed=7)
    ok = (
        F.col("balance").between(1, 4999)
        & F.col("rate").between(0, 4.99)
        & F.to_timestamp("next_payment_date").between("2013-12-31", "2054-01-01")
        & F.col("secured").isNotNull()
    )
    return rows.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("id").alias("ids"),
        F.count_if(ok).alias("in_range"),
        F.count_distinct("status").cast("int").alias("statuses"),
        F.count_distinct("accounting_treatment_id").cast("int").alias("codes"),
    )


ENTITY = {
    "properties": {"id": {"type": "string"}, "date": {"type": "string", "format": "date-time"}, "status": {"type": "string", "enum": ["draft", "final"]}},
    "required": ["id", "date"],
}
MONEY = {"definitions": {"amount": {"type": "integer", "minimum": 5, "maximum": 50}, "rate": {"allOf": [{"type": "number"}]}}}
PRODUCT = {
    "allOf": [{"$ref": "entity"}, {"properties": {"country_code": {"type": "string"}}}],
    "definitions": {"code": {"type": "string", "enum": ["A", "B", "C"]}},
    "properties": {
        "amount": {"$ref": "money#/definitions/amount"},
        "rate": {"$ref": "money#/definitions/rate"},
        "class": {"$ref": "#/definitions/code"},
        "currency_code": {"type": "string"},
        "status": {"type": "string", "enum": ["active", "closed"]},
    },
    "required": ["amount"],
}


@check(
    """SELECT count(*) AS records, count(DISTINCT c_custkey) AS ids, count(*) AS in_range, TRUE AS known_codes,
        'id,date,status,country_code,amount,rate,class,currency_code' AS names FROM customer"""
)
def datagen_inherited(spark: SparkSession, folder: str) -> DataFrame:
    """One record per customer of a schema that inherits from two others and refers to definitions here and there; its own enum wins."""
    rows = generate_for(table(spark, folder, "customer"), "c_custkey", PRODUCT, seed=3, documents={"entity": ENTITY, "money": MONEY})
    ok = F.col("amount").between(5, 49) & F.col("rate").between(0, 4.99) & F.col("class").isin("A", "B", "C") & F.col("status").isin("active", "closed")
    known = F.col("country_code").isin(country_codes(spark)) & F.col("currency_code").isin(currency_codes(spark))
    return rows.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("id").alias("ids"),
        F.count_if(ok).alias("in_range"),
        F.bool_and(known).alias("known_codes"),
        F.lit(",".join(rows.columns)).alias("names"),
    )
