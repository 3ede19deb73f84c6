"""Projections, predicates, joins, aggregates, ordering, scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.checks.registry import check, table
from silverlode.functions.scalar import from_utc, ordered_first, scaled_sum, strip_quotes, to_utc
from silverlode.functions.textscore import lexicon_sentiment
from silverlode.operators import joins, project
from silverlode.operators.quality import profile

AT = datetime(2024, 1, 1)


@check(
    """SELECT event_id, TRY_CAST(event_type AS INTEGER) AS as_int, CAST(value AS BIGINT) IS NOT NULL AS has_value,
           CAST(ts AS DATE) AS day, TRY_CAST(CAST(user_id AS VARCHAR) AS INTEGER) AS user_int FROM events"""
)
def typed_projection(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "events").select(
        "event_id",
        F.col("event_type").alias("as_int"),
        F.col("value").isNotNull().alias("has_value"),
        F.col("ts").alias("day"),
        F.col("user_id").cast("string").alias("user_int"),
    )
    return project.type_columns(raw, {"as_int": "int", "day": "date", "user_int": "int"})


@check(
    """SELECT n_nationkey, upper(n_name) AS nation, TIMESTAMP '2024-01-01 00:00:00' AS ingest_dt,
           'nations' AS ingest_procedure, 'loader' AS ingest_principal FROM nation"""
)
def audit_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = project.select_as(table(spark, folder, "nation"), {"n_nationkey": "n_nationkey", "nation": "upper(n_name)"})
    audited = project.with_audit(rows, "nations", AT, "loader")
    return audited.withColumn("ingest_dt", F.col("ingest_dt").cast("timestamp_ntz"))


@check("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def columns_except(spark: SparkSession, folder: str) -> DataFrame:
    return project.except_columns(table(spark, folder, "customer"), ["c_nationkey", "c_acctbal"])


@check(
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'"""
)
def date_range(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return project.between_dates(orders, "o_orderdate", "1997-01-01", "1997-12-31")


@check(
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('5-LOW') AND o_totalprice BETWEEN 1000 AND 250000
      AND o_custkey IS NOT NULL AND (o_totalprice <= 100000 OR o_orderstatus <> 'F')"""
)
def predicates(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM {orders}
        WHERE o_orderstatus IN (:first, :second) AND o_orderpriority NOT IN ('5-LOW')
          AND o_totalprice BETWEEN 1000 AND 250000 AND o_custkey IS NOT NULL
          AND (o_totalprice <= 100000 OR o_orderstatus <> :first)""",
        args={"first": "F", "second": "O"},
        orders=table(spark, folder, "orders"),
    )


@check(
    """SELECT d.doc_id, coalesce(l.quality, 1) AS quality, 'loader' AS update_user
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def column_defaults(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id")
    rows = joins.enrich(docs, table(spark, folder, "labels"), {"doc_id": "doc_id"}, {"quality": "quality"})
    return project.with_defaults(rows, {"quality": 1, "update_user": "loader"})


@check(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(value, 0) AS v FROM events"""
)
def nested_fields(spark: SparkSession, folder: str) -> DataFrame:
    """A struct field, a map entry and a NULL default."""
    parsed = table(spark, folder, "events").select(
        "event_id",
        F.from_json("props", "k bigint").alias("s"),
        F.create_map(F.lit("value"), F.col("value")).alias("m"),
    )
    return parsed.select("event_id", F.col("s.k").alias("k"), F.coalesce(F.col("m")["value"], F.lit(0.0)).alias("v"))


@check("SELECT DISTINCT lang, source FROM documents")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("lang", "source").distinct()


@check("SELECT r_regionkey, r_name FROM region")
def commented_columns(spark: SparkSession, folder: str) -> DataFrame:
    return project.with_comments(table(spark, folder, "region"), {"r_regionkey": "region code", "r_name": "region"})


@check(
    """SELECT o_orderkey, o_totalprice, c_name AS customer, c_nationkey AS nation_key
    FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def join_enrich_inner(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, folder, "customer")
    add = {"customer": "c_name", "nation_key": "c_nationkey"}
    return joins.enrich(orders, customers, {"o_custkey": "c_custkey"}, add, how="inner").drop("o_custkey")


@check(
    """SELECT o_orderkey, o_orderpriority, r_name AS region FROM orders
    LEFT JOIN region ON CAST(substr(o_orderpriority, 1, 1) AS INTEGER) = r_regionkey"""
)
def join_enrich_left(spark: SparkSession, folder: str) -> DataFrame:
    """A code kept as text against a numeric reference id."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", F.substring("o_orderpriority", 1, 1).alias("code")
    )
    region = table(spark, folder, "region")
    return joins.enrich(orders, region, {"code": "r_regionkey"}, {"region": "r_name"}, compare_as="int").drop("code")


@check(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, r_name AS region FROM lineitem
    LEFT JOIN region ON l_linenumber = r_regionkey"""
)
def join_enrich_salted(spark: SparkSession, folder: str) -> DataFrame:
    """Seven hot keys spread over 8 tasks each."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    region = table(spark, folder, "region")
    return joins.enrich(lines, region, {"l_linenumber": "r_regionkey"}, {"region": "r_name"}, salt=8)


@check(
    """SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
    FROM customer, nation WHERE c_nationkey = n_nationkey GROUP BY n_name"""
)
def join_comma(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        """SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
        FROM {customer} AS customer, {nation} AS nation WHERE c_nationkey = n_nationkey GROUP BY n_name""",
        customer=table(spark, folder, "customer"),
        nation=table(spark, folder, "nation"),
    )


@check("SELECT doc_id, source, quality, toxic FROM documents JOIN labels USING (doc_id)")
def join_using(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return docs.join(table(spark, folder, "labels"), "doc_id")


@check(
    """SELECT n_name, c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name, c_mktsegment"""
)
def join_star(spark: SparkSession, folder: str) -> DataFrame:
    dims = [
        (table(spark, folder, "customer"), "o_custkey", "c_custkey"),
        (table(spark, folder, "nation"), "c_nationkey", "n_nationkey"),
    ]
    wide = joins.star(table(spark, folder, "orders"), dims)
    return wide.groupBy("n_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@check(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity FROM lineitem JOIN (
        SELECT l_returnflag AS f, max(l_quantity) AS q FROM lineitem GROUP BY 1) m
    ON l_returnflag = f AND l_quantity = q"""
)
def max_with_ties(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    lines = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity")
    return joins.rows_at_group_max(lines, ["l_returnflag"], "l_quantity")


@check(
    """SELECT round(sum(c_acctbal), 0) AS balance, c_nationkey AS location FROM customer GROUP BY c_nationkey
    UNION SELECT round(sum(s_acctbal), 0), s_nationkey FROM supplier GROUP BY s_nationkey
    UNION SELECT round(sum(c_acctbal), 0), c_nationkey FROM customer GROUP BY c_nationkey"""
)
def union_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Balances of customers and suppliers by nation; the customers come twice and collapse."""

    def by_nation(name: str, nation: str, balance: str) -> DataFrame:
        grouped = table(spark, folder, name).groupBy(F.col(nation).alias("location"))
        return grouped.agg(F.round(F.sum(balance), 0).alias("balance"))

    customers = by_nation("customer", "c_nationkey", "c_acctbal")
    return joins.union_distinct(customers, by_nation("supplier", "s_nationkey", "s_acctbal"), customers)


@check(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"""
)
def top_k(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.top_k(orders, 20, "o_totalprice", ["o_orderkey"])


@check("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def ordered_rows(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return customers.orderBy(F.asc("c_mktsegment"), F.desc("c_acctbal"), F.asc("c_custkey"))


@check("SELECT count(*) AS all_rows, count(1) AS ones, count(quality) AS labelled FROM documents LEFT JOIN labels USING (doc_id)")
def count_rows(spark: SparkSession, folder: str) -> DataFrame:
    joined = table(spark, folder, "documents").select("doc_id").join(table(spark, folder, "labels"), "doc_id", "left")
    return joined.agg(
        F.count("*").alias("all_rows"), F.count(F.lit(1)).alias("ones"), F.count("quality").alias("labelled")
    )


@check(
    """SELECT 'events' AS layer, count(*) AS row_count, count(DISTINCT user_id) AS key_count,
           max(user_id) AS max_key, max(ts) AS latest_change FROM events"""
)
def profile_row(spark: SparkSession, folder: str) -> DataFrame:
    return profile(table(spark, folder, "events"), "events", "user_id", "ts")


@check(
    """SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS total, max(l_shipdate) AS latest,
           count(*) FILTER (WHERE l_discount > 0.05) AS discounted,
           round(sum(l_extendedprice) / 1000000, 2) AS millions
    FROM lineitem GROUP BY 1, 2"""
)
def sums_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.sum("l_extendedprice"), 2).alias("total"),
            F.max("l_shipdate").alias("latest"),
            F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
            scaled_sum("l_extendedprice", 1_000_000).alias("millions"),
        )
    )


@check(
    """SELECT user_id, event_type AS first_type, value AS first_value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) z WHERE rn = 1"""
)
def ordered_first_value(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .groupBy("user_id")
        .agg(
            ordered_first("event_type", "ts", "event_id").alias("first_type"),
            ordered_first("value", "ts", "event_id").alias("first_value"),
        )
    )


@check(
    """SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto' AS local_ts,
           (ts AT TIME ZONE 'America/Toronto') AT TIME ZONE 'UTC' AS utc_ts FROM events"""
)
def tz_convert(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        from_utc("ts", "America/Toronto").alias("local_ts"),
        to_utc("ts", "America/Toronto").alias("utc_ts"),
    )


@check(
    """SELECT event_id, upper(event_type) AS kind, event_type || '/' || props AS tag,
           regexp_replace(props, '"', '', 'g') AS bare, CAST(ts AS DATE) AS day,
           strftime(ts, '%Y-%m-%d %H:%M') AS minute, round(value, 1) AS rounded FROM events"""
)
def scalar_functions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        F.upper("event_type").alias("kind"),
        F.concat("event_type", F.lit("/"), "props").alias("tag"),
        strip_quotes("props").alias("bare"),
        F.to_date("ts").alias("day"),
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"),
        F.round("value", 1).alias("rounded"),
    )


# A word's valence follows from its length and how often benchmark texts use it, so the
# lexicon grows with the tables.
LEXICON = """SELECT word, CASE WHEN length(word) = 3 THEN -1.5 ELSE 0.5 END AS valence FROM (
        SELECT word, count(*) AS n FROM (
            SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM benchmark) w
        WHERE word <> '' GROUP BY word) c WHERE n >= 10"""

WORDS = "SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM documents"

SENTIMENT = f"""
    WITH lex AS ({LEXICON}), s AS (
        SELECT d.doc_id, count(*) FILTER (WHERE w.word <> '') AS n,
               count(*) FILTER (WHERE valence < 0) AS neg, count(*) FILTER (WHERE valence > 0) AS pos,
               CAST(coalesce(sum(valence), 0) AS DOUBLE) AS x
        FROM documents d LEFT JOIN ({WORDS}) w ON w.doc_id = d.doc_id LEFT JOIN lex ON lex.word = w.word
        GROUP BY d.doc_id)
    SELECT doc_id, round(CAST(neg AS DOUBLE) / greatest(n, 1), 6) AS neg,
           round(CAST(n - neg - pos AS DOUBLE) / greatest(n, 1), 6) AS neu,
           round(CAST(pos AS DOUBLE) / greatest(n, 1), 6) AS pos, round(x / sqrt(x * x + 15), 6) AS compound
    FROM s ORDER BY x / sqrt(x * x + 15) DESC, doc_id"""


@check(SENTIMENT)
def text_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents scored and sorted by one entry of the score map."""
    used = table(spark, folder, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word"))
    lexicon = (
        used.where("word <> ''")
        .groupBy("word")
        .count()
        .where("count >= 10")
        .select("word", F.when(F.length("word") == 3, -1.5).otherwise(0.5).alias("valence"))
    )
    scored = lexicon_sentiment(table(spark, folder, "documents"), "doc_id", "text", lexicon)
    ordered = scored.orderBy(F.col("scores")["compound"].desc(), "doc_id")
    entries = [F.round(F.col("scores")[name], 6).alias(name) for name in ("neg", "neu", "pos", "compound")]
    return ordered.select("doc_id", *entries)


@check(
    """SELECT event_type, count(*) AS n, round(sum(value * CASE event_type WHEN 'purchase' THEN 3 WHEN 'view' THEN 1 END), 2)
           AS weighted FROM events WHERE event_type IN ('purchase', 'view') GROUP BY event_type"""
)
def inline_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows given inline as VALUES, joined to a table."""
    return spark.sql(
        """SELECT event_type, count(*) AS n, round(sum(value * weight), 2) AS weighted
        FROM {events} AS e JOIN (VALUES ('purchase', 3), ('view', 1)) AS w (kind, weight) ON e.event_type = w.kind
        GROUP BY event_type""",
        events=table(spark, folder, "events"),
    )
