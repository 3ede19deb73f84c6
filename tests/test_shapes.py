from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from silverlode.functions.datagen import accounting_treatments, generate
from silverlode.functions.scalar import from_utc, lenient_cast, to_utc
from silverlode.functions.textscore import lexicon_sentiment
from silverlode.operators import layout, project, reshape
from silverlode.checks.shapes import SCHEMA


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def abcd(spark):
    data = [
        ("foo", "one", "small", 1), ("foo", "one", "large", 2), ("foo", "one", "large", 2),
        ("foo", "two", "small", 3), ("foo", "two", "small", 3), ("bar", "one", "large", 4),
        ("bar", "one", "small", 5), ("bar", "two", "small", 6), ("bar", "two", "large", 7),
    ]
    return spark.createDataFrame(data, "A string, B string, C string, D int")


def test_pivot_two_keys(abcd):
    wide = reshape.pivot(abcd, ["A", "B"], "C", F.sum("D"))
    assert wide.columns == ["A", "B", "large", "small"]
    assert rows(wide) == [
        ("bar", "one", 4, 5), ("bar", "two", 7, 6), ("foo", "one", 4, 1), ("foo", "two", None, 6),
    ]


def test_unpivot_of_pivot_is_the_grouped_input(abcd):
    wide = reshape.pivot(abcd, ["A", "B"], "C", F.sum("D"))
    long = reshape.unpivot(wide, ["A", "B"], ["large", "small"], "C", "D")
    assert rows(long) == rows(abcd.groupBy("A", "B", "C").agg(F.sum("D")))


def test_too_many_pivot_values_raise(spark):
    with pytest.raises(ValueError, match="more than 5"):
        reshape.distinct_values(spark.range(6), "id", 5)


def test_feature_pivot_fills_after_the_pivot(spark):
    ratings = spark.createDataFrame(
        [(1, 10, 5, 1), (1, 10, 2, 0), (1, 20, 4, 1), (2, 10, 1, 1), (2, 30, 2, 1)], "user int, movie int, rating int, t int"
    )
    wide = reshape.feature_pivot(ratings, "user", "movie", "rating", ["t"], top_n=2)
    assert wide.columns == ["user", "10", "20"]
    assert rows(wide) == [(1, 2.0, 4.0), (2, 1.0, 3.0)]


def test_transpose(spark):
    pairs = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "b", "z")], "k int, name string, value string")
    assert rows(reshape.transpose(pairs, ["k"], "name", "value")) == [(1, "x", "y"), (2, None, "z")]


def test_rollup_tells_subtotal_from_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "x")], "g string, h string")
    got = rows(reshape.rollup_agg(df, ["g", "h"], {"n": F.count(F.lit(1))}))
    assert got == sorted([("a", None, 1, 0), ("a", "x", 1, 0), ("a", None, 2, 1), (None, None, 2, 3)], key=repr)


@pytest.mark.parametrize(
    "utc, local",
    [("1975-04-17 04:00:00", "1975-04-16 23:00:00"), ("2022-04-17 04:00:00", "2022-04-17 00:00:00")],
)
def test_time_zone_history(spark, utc, local):
    df = spark.createDataFrame([(utc, local)], "u string, l string")
    zone = "America/Montreal"
    row = df.select(
        from_utc(F.to_timestamp("u"), zone).cast("string").alias("l"), to_utc(F.to_timestamp("l"), zone).cast("string").alias("u")
    ).first()
    assert (row.l, row.u) == (local, utc)
    midnight = df.select(to_utc(F.lit("1975-04-17 00:00:00").cast("timestamp"), zone).cast("string")).first()[0]
    assert midnight == "1975-04-17 05:00:00"


def test_generator_does_not_depend_on_partitions(spark):
    one = generate(spark, SCHEMA, 500, seed=3).coalesce(1)
    many = generate(spark, SCHEMA, 500, seed=3).repartition(7)
    assert rows(one) == rows(many)
    assert "tags" not in one.columns
    low, high = one.agg(F.min("balance"), F.max("balance")).first()
    assert 1 <= low and high < 5000
    assert rows(generate(spark, SCHEMA, 2, seed=3, offset=100).select("id")) == [("100",), ("101",)]
    assert rows(generate(spark, SCHEMA, 500, seed=4)) != rows(one)
    assert accounting_treatments(spark).count() == 6


def test_sentiment_scores_whole_texts(spark):
    texts = spark.createDataFrame([(1, "Good good, BAD!"), (2, ""), (3, None), (4, "plain words")], "id int, t string")
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -3.0)], "word string, valence double")
    got = {r.id: r.scores for r in lexicon_sentiment(texts, "id", "t", lexicon).collect()}
    assert got[1]["pos"] == pytest.approx(2 / 3) and got[1]["neg"] == pytest.approx(1 / 3)
    assert got[1]["compound"] == pytest.approx(1 / 4)
    assert got[2] == got[3] == {"neg": 0.0, "neu": 0.0, "pos": 0.0, "compound": 0.0}
    assert got[4]["neu"] == 1.0


def test_zorder_keeps_rows_and_narrows_files(spark, folder):
    df = spark.range(20000).selectExpr(
        "id AS a", "pmod(id * 7919, 20000) AS b", "IF(id % 9 = 0, NULL, id) AS c", "CAST(id AS STRING) AS t"
    )
    layout.zorder(df, ["a", "b"], 16).write.parquet(f"{folder}/z")
    back = spark.read.parquet(f"{folder}/z")
    assert back.exceptAll(df).count() == 0 and back.count() == 20000
    spans = back.groupBy(F.input_file_name().alias("f")).agg(
        (F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")
    )
    narrow = spans.agg(F.avg("a").alias("a"), F.avg("b").alias("b")).first()
    assert narrow.a < 11000 and narrow.b < 11000
    assert layout.zorder(df, ["c", "t"], 4).count() == 20000


def test_zorder_splits_one_heavy_cell(spark):
    same = spark.range(8000).selectExpr("id", "1 AS a", "1 AS b")
    sizes = [r["count"] for r in layout.zorder(same, ["a", "b"], 8).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8


def test_compact(spark, folder):
    spark.range(1000).repartition(20).write.parquet(f"{folder}/many")
    assert layout.compact(spark, f"{folder}/many", f"{folder}/few") == 1
    assert spark.read.parquet(f"{folder}/few").count() == 1000


def test_projections(spark):
    df = spark.createDataFrame([("1", "x", None), ("n/a", "y", 5)], "id string, v string, d int")
    typed = project.type_columns(df, {"id": "int"})
    assert rows(typed) == [(1, "x", None), (None, "y", 5)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        project.type_columns(df, {"id": "int"}, strict=True).collect()
    assert rows(project.with_defaults(df, {"d": 1, "e": "z"}).select("d", "e")) == [(1, "z"), (5, "z")]
    commented = project.with_comments(df, {"id": "the key"})
    assert commented.schema["id"].metadata == {"comment": "the key"}
    assert rows(project.delete_where(df, "d > 1")) == [("1", "x", None)]
    assert rows(project.update_where(df, "d = 5", {"v": "upper(v)"}).select("v")) == [("Y",), ("x",)]
    audited = project.with_audit(df, "p").first()
    assert audited.ingest_procedure == "p" and audited.ingest_dt is not None and audited.ingest_principal


def test_lenient_cast_is_try_cast(spark):
    texts = ["1", " 7 ", "+5", "-3", "1.5", "1e3", "", "abc", "a1", "2022-01-01", "NaN", "-Infinity", "inf", "9" * 12, "\t4\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in ("int", "bigint", "double", "decimal(10,2)", "date", "boolean"):
        guarded = lenient_cast(F.col("t"), df.schema["t"].dataType, kind).cast("string")
        assert [r[0] for r in df.select(guarded).collect()] == [
            r[0] for r in df.select(F.col("t").try_cast(kind).cast("string")).collect()
        ]


def test_clustered_files_are_about_equal_without_a_sampled_range(spark, folder):
    numbers = spark.range(4000).select(F.when(F.col("id") % 50 != 0, (F.col("id") * 7919) % 4000).alias("a"), (F.col("id") % 61).alias("b"))
    df = numbers.unionByName(numbers.limit(40))  # some rows twice, some without ``a``
    cells = layout.measure_cells(df, ["a", "b"], layout.bits_for(8, 2))
    for curve in layout.CURVES:
        found = layout.cluster(df, ["a", "b"], 8, curve, cells=cells)
        assert "rangepartitioning" not in found._jdf.queryExecution().toString().lower()
        found.write.parquet(f"{folder}/{curve}")
        sizes = [r["row_count"] for r in layout.file_spans(spark, f"{folder}/{curve}", ["a", "b"]).collect()]
        assert len(sizes) == 8 and max(sizes) - min(sizes) < 100
        assert rows(spark.read.parquet(f"{folder}/{curve}")) == rows(df)


def test_a_row_whose_cell_was_not_counted_is_kept(spark):
    df = spark.range(100).select(F.col("id").alias("a"), F.col("id").alias("b"))
    cells = layout.measure_cells(df, ["a", "b"], 3)
    later = df.unionByName(spark.createDataFrame([(0, 99)], "a long, b long"))
    assert layout.cluster(later, ["a", "b"], 4, cells=cells).count() == 101
