"""Sources and sinks: whole tables are landed as files, read back through each source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.checks.registry import check, in_batches, table
from silverlode.operators.joins import enrich
from silverlode.operators.project import type_columns
from silverlode.plans.templates import ingest_registered
from silverlode.session import new_folder
from silverlode.sources import files, sinks
from silverlode.streaming.writers import append_stream, append_to_table, each_batch, write_batch

ORDERS = "SELECT * FROM orders"
DDL = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders")


def _landed_csv(spark: SparkSession, folder: str, label: str) -> str:
    root = new_folder(spark, label)
    _orders(spark, folder).repartition(4).write.option("header", True).csv(f"{root}/landing")
    return root


@check(f"SELECT *, TRUE AS from_csv FROM ({ORDERS}) o")
def ingest_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Incremental CSV ingest with file lineage; a second run finds nothing new."""
    root = _landed_csv(spark, folder, "ingest")
    for _ in range(2):
        stream = files.ingest_files(spark, f"{root}/landing", DDL, glob="part-*.csv")
        append_stream(stream, f"{root}/bronze", f"{root}/checkpoint", name="bronze")
    rows = spark.read.parquet(f"{root}/bronze")
    return rows.withColumn("from_csv", F.col("input_file_name").endswith(".csv")).drop("input_file_name")


@check("SELECT * FROM events")
def ingest_json_pinned(spark: SparkSession, folder: str) -> DataFrame:
    """JSON batches read as a stream under a schema inferred once and pinned."""
    root = new_folder(spark, "json")
    events = table(spark, folder, "events")
    sinks.write_json_batch(events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")), f"{root}/landing", 0)
    schema = files.infer_and_pin_schema(spark, f"{root}/landing/batch=0", f"{root}/schema")
    stream = files.ingest_files(spark, f"{root}/landing/batch=0", schema, "json", lineage=None)
    append_stream(stream, f"{root}/bronze", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/bronze").select(*events.columns).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@check(
    """SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'"""
)
def schema_evolution(spark: SparkSession, folder: str) -> DataFrame:
    """Files with a new column arrive: the pinned schema grows and both generations are read."""
    root, orders = new_folder(spark, "evolve"), table(spark, folder, "orders")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    steps = [(orders.where("o_orderstatus = 'F'"), []), (orders.where("o_orderstatus <> 'F'"), ["o_orderpriority"])]
    for rows, extra in steps:
        rows.select("o_orderkey", "o_custkey", *extra).write.mode("append").json(landing)
        schema = files.infer_and_pin_schema(spark, landing, f"{root}/schema", evolve=True)
        stream = files.ingest_files(spark, landing, schema, "json", lineage=None)
        append_stream(stream, bronze, f"{root}/checkpoint")
    return spark.read.schema(schema).parquet(bronze).select("o_orderkey", "o_custkey", "o_orderpriority")


@check(ORDERS)
def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    rows = files.read_csv(spark, f"{_landed_csv(spark, folder, 'inferred')}/landing")
    numbers = {c: F.col(c).cast("long") for c in ("o_orderkey", "o_custkey")}
    return rows.withColumns({**numbers, "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz")})


@check(ORDERS)
def csv_typed_glob(spark: SparkSession, folder: str) -> DataFrame:
    return files.read_csv(spark, f"{_landed_csv(spark, folder, 'typed')}/landing/part-*", DDL)


@check(
    """SELECT 'good' AS kind, o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT 'reject', o_orderkey, CAST(NULL AS BIGINT) FROM orders WHERE o_orderstatus = 'F'"""
)
def ingest_csv_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with text in a numeric column go to rejects with their line."""
    path = new_folder(spark, "checked")
    customer = F.when(F.col("o_orderstatus") == "F", "bad").otherwise(F.col("o_custkey").cast("string"))
    table(spark, folder, "orders").select("o_orderkey", customer.alias("o_custkey")).write.option("header", True).csv(path)
    good, rejects = files.read_csv_checked(spark, path, "o_orderkey long, o_custkey long")
    line = F.split(files.CORRUPT, ",")[0].try_cast("long")
    bad = rejects.select(F.lit("reject").alias("kind"), line.alias("o_orderkey"), F.lit(None).cast("long").alias("o_custkey"))
    return good.select(F.lit("good").alias("kind"), "o_orderkey", "o_custkey").unionByName(bad)


@check(
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size,
           concat_ws(',', CASE WHEN p_size > 10 THEN NULL ELSE 'big' END,
                          CASE WHEN p_name IS NULL THEN 'named' END) AS failed FROM part"""
)
def registered_source(spark: SparkSession, folder: str) -> DataFrame:
    """Reader options and rules come from a registry row."""
    root = new_folder(spark, "registry")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    parts.write.option("header", True).option("sep", "|").csv(f"{root}/Product")
    registry = spark.createDataFrame(
        [("Product", '{"header": "true", "sep": "|"}', '{"big": "CAST(p_size AS INT) > 10", "named": "p_name IS NOT NULL"}')],
        "TableName string, ReadOptions string, Expectations string",
    )
    rows = ingest_registered(spark, registry, "Product", root)
    return rows.withColumn("failed", F.concat_ws(",", "failed_rules")).drop("failed_rules")


@check("SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang")
def query_path(spark: SparkSession, folder: str) -> DataFrame:
    """A file queried in place by its path."""
    docs = files.read_path(spark, "parquet", f"{folder.rstrip('/')}/documents.parquet")
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@check("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def csv_temp_view(spark: SparkSession, folder: str) -> DataFrame:
    root = _landed_csv(spark, folder, "view")
    files.csv_view(spark, "landed_orders", f"{root}/landing")
    return spark.sql("SELECT o_orderpriority, count(*) AS n FROM landed_orders GROUP BY o_orderpriority")


@check(ORDERS)
def table_stream_append(spark: SparkSession, folder: str) -> DataFrame:
    """A parquet table of several files read as a stream, every micro-batch handed to a function."""
    root = new_folder(spark, "append")
    rows = in_batches(_orders(spark, folder).withColumn("batch", (F.col("o_orderkey") % 3).cast("int")), f"{root}/orders")
    each_batch(rows, lambda batch, i: write_batch(batch, f"{root}/log", i), f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/log").drop("batch_id")


@check(f"SELECT * FROM ({ORDERS}) a UNION ALL SELECT * FROM ({ORDERS}) b")
def overwrite_then_append(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "overwrite")
    _orders(spark, folder).write.mode("overwrite").parquet(path)
    sinks.append_rows(_orders(spark, folder), path)
    return spark.read.parquet(path)


@check(f"SELECT 'parts' AS form, * FROM ({ORDERS}) a UNION ALL SELECT 'single', * FROM ({ORDERS}) b UNION ALL SELECT 'again', * FROM ({ORDERS}) c")
def publish_csv(spark: SparkSession, folder: str) -> DataFrame:
    """One target published as parts, as a single file and as parts again, read back each time."""
    root = new_folder(spark, "publish")
    read = None
    for form, single in (("parts", False), ("single", True), ("again", False)):
        paths = sinks.publish_csv(_orders(spark, folder), root, "orders.csv", delimiter=";", single=single)
        found = spark.read.option("header", True).option("sep", ";").csv(paths)
        kept = f"{root}/{form}"
        found.select(F.lit(form).alias("form"), "*").write.parquet(kept)
        now = spark.read.parquet(kept)
        read = now if read is None else read.unionByName(now)
    return type_columns(read, {"o_orderkey": "long", "o_custkey": "long", "o_totalprice": "double", "o_orderdate": "timestamp_ntz"})


@check(
    """SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 50 <> 0 THEN value END AS value, props,
        CASE WHEN event_id % 50 = 0 THEN '{"value":"n/a"}' WHEN event_id % 50 = 1 THEN '{"extra":"e' || event_id || '"}' END AS rescued
    FROM events WHERE event_id % 50 <> 2
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, '{"event_id": ' || event_id FROM events WHERE event_id % 50 = 2"""
)
def ingest_json_rescued(spark: SparkSession, folder: str) -> DataFrame:
    """All events as JSON with wrong types, unknown columns and broken lines among them, streamed in several batches."""
    root = new_folder(spark, "rescued")
    events = table(spark, folder, "events")
    kinds = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    text = {"ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")}
    plain = [text.get(c, F.col(c)).alias(c) for c in kinds]
    wrong = [F.lit("n/a").alias(c) if c == "value" else text.get(c, F.col(c)).alias(c) for c in kinds]
    form = F.col("event_id") % 50
    line = (
        F.when(form == 0, F.to_json(F.struct(*wrong)))
        .when(form == 1, F.to_json(F.struct(*plain, F.concat(F.lit("e"), "event_id").alias("extra"))))
        .when(form == 2, F.concat(F.lit('{"event_id": '), "event_id"))
        .otherwise(F.to_json(F.struct(*plain)))
    )
    events.repartition(4, "event_id").select(line.alias("value")).write.text(f"{root}/in")
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items())
    rows = files.ingest_json_rescued(spark, f"{root}/in", schema, "rescued", max_files_per_batch=1)
    append_stream(rows, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@check(
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 40 <> 0 THEN o_totalprice END AS o_totalprice, o_orderdate,
        o_orderkey % 40 = 0 AS rejected FROM orders"""
)
def ingest_csv_stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their dates as CSV; rows with a price that is no number are kept with their text, batch by batch."""
    root = new_folder(spark, "rejects")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    price = F.when(F.col("o_orderkey") % 40 == 0, F.lit("unknown")).otherwise(F.col("o_totalprice").cast("string"))
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    dirty = orders.repartition(4, "o_orderkey").withColumns({"o_totalprice": price, "o_orderdate": stamp})
    dirty.write.option("header", True).csv(f"{root}/in")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders.schema.fields)

    def both(batch: DataFrame, batch_id: int) -> None:
        whole = batch.withColumn("rejected", F.col(files.CORRUPT).isNotNull())
        write_batch(whole, f"{root}/out", batch_id)

    each_batch(files.ingest_csv_with_rejects(spark, f"{root}/in", schema, max_files_per_batch=1), both, f"{root}/checkpoint")
    written = spark.read.parquet(f"{root}/out")
    good, rejects = files.without_rejects(written)
    return good.drop("batch_id").unionByName(rejects.drop("batch_id", files.CORRUPT))


@check(
    """SELECT 'event_id' AS name, count(*) AS n FROM events UNION ALL SELECT 'old', count(*) FROM events WHERE event_id % 50 = 0
    UNION ALL SELECT 'value', count(value) FROM events"""
)
def schema_all_files(spark: SparkSession, folder: str) -> DataFrame:
    """A column that only the oldest of many files holds stays in the pinned schema, and no column for broken lines."""
    root = new_folder(spark, "all-files")
    events = table(spark, folder, "events")
    events.where("event_id % 50 = 0").select("event_id", F.lit(1).alias("old"), "value").repartition(1).write.json(f"{root}/in")
    rest = events.where("event_id % 50 <> 0").select("event_id", "value")
    rest.repartition(40).write.mode("append").json(f"{root}/in")
    schema = files.infer_and_pin_schema(spark, f"{root}/in", f"{root}/schema")
    counted = spark.read.schema(schema).json(f"{root}/in").agg(*[F.count(c).alias(c) for c in schema.names])
    return counted.unpivot([], counted.columns, "name", "n")


@check("SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer")
def copied_tables(spark: SparkSession, folder: str) -> DataFrame:
    target = new_folder(spark, "backup")
    names = ("orders", "customer")
    sinks.copy_tables(spark, {n: f"{folder.rstrip('/')}/{n}.parquet" for n in names}, target)
    counts = [spark.read.parquet(f"{target}/{n}").agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n in names]
    return counts[0].unionByName(counts[1])


@check(
    """SELECT l_orderkey, l_linenumber, l_partkey, r_name AS region, 'inner' AS kind
    FROM lineitem JOIN region ON l_linenumber = r_regionkey
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, r_name, 'left'
    FROM lineitem LEFT JOIN region ON l_linenumber = r_regionkey"""
)
def stream_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """A stream joined to a static reference: inner drops unknown codes, left keeps them."""
    root, region = new_folder(spark, "enriched"), table(spark, folder, "region")
    schema = table(spark, folder, "lineitem").schema
    for how in ("inner", "left"):
        lines = files.stream_table(spark, folder, schema, "lineitem.parquet")
        lines = lines.select("l_orderkey", "l_linenumber", "l_partkey")
        known = enrich(lines, region, {"l_linenumber": "r_regionkey"}, {"region": "r_name"}, how=how)
        append_stream(known.withColumn("kind", F.lit(how)), f"{root}/{how}", f"{root}/checkpoint-{how}")
    return spark.read.parquet(f"{root}/inner").unionByName(spark.read.parquet(f"{root}/left"))


@check("SELECT o_orderstatus, count(*) AS n, max(o_orderdate) AS latest FROM orders GROUP BY o_orderstatus")
def table_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """A summary written twice as a tagged table, then read by name."""
    path = new_folder(spark, "summary")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    orders = table(spark, folder, "orders")
    summary = orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("latest"))
    for _ in range(2):
        sinks.overwrite_table(summary, name, path, comment="orders by status", tier="gold")
    return spark.table(name)


@check(ORDERS)
def stream_to_registered_table(spark: SparkSession, folder: str) -> DataFrame:
    """A triggered stream into a folder, and a table registered on it."""
    root = new_folder(spark, "registered")
    name = root.rsplit("/", 1)[1].replace("-", "_")
    stream = files.stream_table(spark, folder, table(spark, folder, "orders").schema, "orders.parquet")
    append_stream(stream, f"{root}/data", f"{root}/checkpoint", name=name)
    sinks.register_table(spark, name, f"{root}/data")
    return spark.table(name)


@check("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderkey % 4 AS load FROM orders")
def table_appended_by_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Four micro-batches appended to a table of the catalog by its name, read back by that name."""
    root = new_folder(spark, "named")
    name = root.rsplit("/", 1)[1].replace("-", "_")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", (F.col("o_orderkey") % 4).alias("load"))
    append_to_table(in_batches(orders.withColumn("batch", F.col("load").cast("int")), f"{root}/in"), name, f"{root}/_checkpoint")
    return spark.table(name)


@check("SELECT o_orderstatus, count(*) AS n, 'spark_catalog' AS catalog, 'default' AS db, TRUE AS has_user FROM orders GROUP BY 1")
def session_context(spark: SparkSession, folder: str) -> DataFrame:
    """Rows stamped with the session that made them: its catalog, database and user."""
    stamped = table(spark, folder, "orders").withColumns({"catalog": F.current_catalog(), "db": F.current_database(), "by": F.current_user()})
    return stamped.groupBy("o_orderstatus", "catalog", "db").agg(F.count("*").alias("n"), F.bool_and(F.length("by") > 0).alias("has_user"))
