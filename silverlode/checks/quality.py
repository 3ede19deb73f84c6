"""Expectations over documents with their labels, and set rules over events and orders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.checks.registry import check, table
from silverlode.operators import quality as q
from silverlode.operators.joins import enrich
from silverlode.operators.quality import DROP, FAIL, ExpectationFailed, Rule
from silverlode.session import new_folder
from silverlode.sources.files import stream_table
from silverlode.sources.sinks import publish_checked
from silverlode.sources.storage import exists
from silverlode.streaming.writers import append_checked, append_stream

RULES = [
    Rule("labelled", "quality IS NOT NULL", DROP),
    Rule("fair_length", "n_chars BETWEEN 10 AND 2000"),
    Rule("not_toxic", "toxic = 0"),
]
LABELLED = """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, folder, "labels")
    return enrich(docs, labels, {"doc_id": "doc_id"}, {"quality": "quality", "toxic": "toxic"})


@check(f"SELECT * FROM ({LABELLED}) j WHERE quality IS NOT NULL")
def dq_expect_drop(spark: SparkSession, folder: str) -> DataFrame:
    return q.expect(_labelled(spark, folder), RULES)


@check(f"SELECT * FROM ({LABELLED}) j WHERE quality IS NOT NULL")
def dq_expect_fail(spark: SparkSession, folder: str) -> DataFrame:
    """A FAIL rule that holds for every row lets the load through; a drop rule still drops."""
    return q.expect(_labelled(spark, folder), [Rule("has_id", "doc_id IS NOT NULL", FAIL), *RULES])


@check(
    f"""WITH j AS ({LABELLED}), d AS (SELECT count(*) AS n FROM j WHERE quality IS NULL)
    SELECT 'documents' AS dataset, 'labelled' AS name, count(*) FILTER (WHERE quality IS NOT NULL) AS passed_records,
           count(*) FILTER (WHERE quality IS NULL) AS failed_records, (SELECT n FROM d) AS dropped_records FROM j
    UNION ALL
    SELECT 'documents', 'fair_length', count(*) FILTER (WHERE n_chars BETWEEN 10 AND 2000),
           count(*) FILTER (WHERE n_chars NOT BETWEEN 10 AND 2000), (SELECT n FROM d) FROM j
    UNION ALL
    SELECT 'documents', 'not_toxic', count(*) FILTER (WHERE toxic = 0),
           count(*) FILTER (WHERE toxic IS NULL OR toxic <> 0), (SELECT n FROM d) FROM j"""
)
def dq_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return q.metrics(_labelled(spark, folder), RULES, "documents")


QUARANTINE = f"""SELECT *, concat_ws(',',
        CASE WHEN quality IS NULL THEN 'labelled' END,
        CASE WHEN coalesce(n_chars BETWEEN 10 AND 2000, FALSE) THEN NULL ELSE 'fair_length' END,
        CASE WHEN coalesce(toxic = 0, FALSE) THEN NULL ELSE 'not_toxic' END) AS failed
    FROM ({LABELLED}) j"""


@check(f"SELECT * FROM ({QUARANTINE}) t WHERE failed <> ''")
def dq_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    bad = q.split(_labelled(spark, folder), RULES)[1]
    return bad.withColumn("failed", F.concat_ws(",", "failed_rules")).drop("failed_rules")


@check(f"SELECT * FROM ({LABELLED}) j WHERE quality IS NOT NULL AND n_chars BETWEEN 10 AND 2000 AND toxic = 0")
def dq_split_good(spark: SparkSession, folder: str) -> DataFrame:
    return q.split(_labelled(spark, folder), RULES, disjoint=True)[0]


@check(f"SELECT * FROM ({QUARANTINE}) t")
def dq_expect_all(spark: SparkSession, folder: str) -> DataFrame:
    rules = """{"labelled": "quality IS NOT NULL", "fair_length": "n_chars BETWEEN 10 AND 2000",
                "not_toxic": "toxic = 0"}"""
    marked = q.expect_all(_labelled(spark, folder), rules)
    return marked.withColumn("failed", F.concat_ws(",", "failed_rules")).drop("failed_rules")


@check(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, o_orderdate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < l_shipdate"""
)
def dq_row_rule(spark: SparkSession, folder: str) -> DataFrame:
    """Rule across columns: a line must be shipped after its order."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = table(spark, folder, "orders")
    dated = enrich(lines, orders, {"l_orderkey": "o_orderkey"}, {"o_orderdate": "o_orderdate"}, how="inner")
    return q.expect(dated, [Rule("shipped_after_order", "o_orderdate < l_shipdate", DROP)])


@check(
    """WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events
               WHERE event_type = 'purchase' GROUP BY 1, 2)
    SELECT e.event_id, e.user_id, CAST(e.ts AS DATE) AS day, coalesce(s.n, 0) AS purchases
    FROM events e LEFT JOIN s ON s.user_id = e.user_id AND s.day = CAST(e.ts AS DATE)
    WHERE coalesce(s.n, 0) <= 1"""
)
def dq_set_rule(spark: SparkSession, folder: str) -> DataFrame:
    """At most one purchase per user and day; all events of a day with more are dropped."""
    events = table(spark, folder, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), "event_type")
    kept = q.expect_set(events, ["user_id", "day"], "event_type = 'purchase'", 1, DROP, "purchases")
    return kept.drop("event_type")


@check(
    """WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events
               WHERE event_type = 'purchase' GROUP BY 1, 2)
    SELECT e.event_id, e.user_id, CAST(e.ts AS DATE) AS day, coalesce(s.n, 0) AS purchases
    FROM events e LEFT JOIN s ON s.user_id = e.user_id AND s.day = CAST(e.ts AS DATE)
    WHERE coalesce(s.n, 0) <= 1"""
)
def dq_set_rule_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The set rule over a stream of the events in several batches, judged against the table of all of them."""
    root = new_folder(spark, "set-rule")
    events = table(spark, folder, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), "event_type")
    events.repartition(4, "event_id").write.parquet(f"{root}/events")
    source = spark.read.parquet(f"{root}/events")
    rows = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/events")
    kept = q.expect_set(rows, ["user_id", "day"], "event_type = 'purchase'", 1, DROP, "purchases", source)
    append_stream(kept.drop("event_type"), f"{root}/kept", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/kept")


STEPS = ("plain", "filter", "limit", "first row", "constant filter", "empty join", "empty semi join", "stream", "published")


@check(
    f"""WITH r AS (SELECT 'positive_discount' AS rule, count(*) FILTER (WHERE NOT coalesce(l_discount > 0, FALSE)) AS failed FROM lineitem
        UNION ALL SELECT 'positive_quantity', count(*) FILTER (WHERE NOT coalesce(l_quantity > 0, FALSE)) FROM lineitem)
    SELECT rule, failed, step, failed > 0 AS stopped, step IN ('stream', 'published') AND failed = 0 AS published
    FROM r, (VALUES {", ".join(f"('{s}')" for s in STEPS)}) AS s(step)"""
)
def dq_fail_fires(spark: SparkSession, folder: str) -> DataFrame:
    """A FAIL rule that rows break stops the update whatever follows it, names its rows and publishes nothing; one that holds lets it through."""
    lines = table(spark, folder, "lineitem")
    none = table(spark, folder, "region").where("r_regionkey < 0").select(F.col("r_regionkey").alias("l_linenumber"))
    rules = [Rule("positive_discount", "l_discount > 0", FAIL), Rule("positive_quantity", "l_quantity > 0", FAIL)]
    root = new_folder(spark, "fail")

    def stopped(step: Callable[[], object]) -> bool:
        try:
            step()
        except Exception as error:  # a stream wraps what its batch raised
            if "expectation" not in str(error):
                raise
            return True
        return False

    def noop(rows: DataFrame) -> None:
        rows.write.format("noop").mode("overwrite").save()

    found = []
    for rule in rules:
        try:
            q.check_fail_rules(lines, [rule])
            failed = 0
        except ExpectationFailed as error:
            failed = int(str(error).split(": ")[1].split(" ")[0])
        stream, once = f"{root}/{rule.name}/stream", f"{root}/{rule.name}/once"
        rows = stream_table(spark, folder, lines.schema, "lineitem.parquet")
        steps = {
            "plain": lambda: noop(q.expect(lines, [rule])),
            "filter": lambda: noop(q.expect(lines, [rule]).where("l_discount > 0.05 AND l_quantity > 10")),
            "limit": lambda: noop(q.expect(lines, [rule]).limit(5)),
            "first row": lambda: q.expect(lines, [rule]).first(),
            "constant filter": lambda: noop(q.expect(lines, [rule]).where("1 = 0")),
            "empty join": lambda: noop(q.expect(lines, [rule]).join(none, "l_linenumber")),
            "empty semi join": lambda: noop(q.expect(lines, [rule]).join(none, "l_linenumber", "left_semi")),
            "stream": lambda: append_checked(rows, [rule], stream, f"{stream}-checkpoint"),
            "published": lambda: publish_checked(lines, [rule], once),
        }
        for name in STEPS:
            halted = stopped(steps[name])
            there = {"stream": f"{stream}/batch_id=0", "published": once}.get(name)
            found.append((rule.name, failed, name, halted, bool(there) and exists(spark, there)))
    return spark.createDataFrame(found, "rule string, failed long, step string, stopped boolean, published boolean")


@check(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, r_name AS region FROM lineitem
    JOIN region ON l_linenumber = r_regionkey"""
)
def dq_reference(spark: SparkSession, folder: str) -> DataFrame:
    """Line numbers looked up as region codes: unknown codes are NULL after the left join and dropped."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    coded = enrich(lines, table(spark, folder, "region"), {"l_linenumber": "r_regionkey"}, {"region": "r_name"})
    return q.expect_reference(coded, "region")


@check("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def dq_not_landed(spark: SparkSession, folder: str) -> DataFrame:
    return q.not_landed(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id")


@check(
    """SELECT DISTINCT doc_id FROM documents
    WHERE doc_id NOT IN (SELECT CASE WHEN quality IS NOT NULL THEN doc_id END FROM labels)"""
)
def dq_null_aware_anti(spark: SparkSession, folder: str) -> DataFrame:
    """NOT IN's own rule: were a single label key NULL, nothing would come back."""
    labelled = table(spark, folder, "labels").select(F.when(F.col("quality").isNotNull(), F.col("doc_id")).alias("k"))
    return q.not_landed(table(spark, folder, "documents"), labelled, "doc_id", "k", null_empties=True)


@check(
    """SELECT 'with_null' AS list, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels UNION ALL SELECT NULL)
    UNION ALL SELECT 'without', count(DISTINCT doc_id) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""
)
def dq_not_in_list_with_null(spark: SparkSession, folder: str) -> DataFrame:
    """One NULL among the loaded names empties NOT IN's result; without it the missing ones come back."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels").select("doc_id")
    lists = {"with_null": labels.union(spark.sql("SELECT CAST(NULL AS BIGINT)")), "without": labels}
    counts = [
        q.not_landed(docs, rows, "doc_id", null_empties=True).agg(F.lit(name).alias("list"), F.count("*").alias("n"))
        for name, rows in lists.items()
    ]
    return counts[0].unionByName(counts[1])


@check(
    """SELECT 'bronze' AS layer, count(*) AS row_count, count(DISTINCT user_id) AS key_count,
           max(user_id) AS max_key, max(ts) AS latest_change FROM events
    UNION ALL
    SELECT 'silver', count(*), count(DISTINCT user_id), max(user_id), max(ts) FROM events WHERE event_type <> 'error'"""
)
def dq_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    layers = {"bronze": events, "silver": events.where("event_type <> 'error'")}
    return q.reconcile(layers, "user_id", "ts")
