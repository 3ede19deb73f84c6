"""Lexicon sentiment of whole texts, without any Python per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the normalisation constant of Hutto & Gilbert (2014).
ALPHA = 15.0
MARKS = 1024


def lexicon_sentiment(texts: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """(key, scores) with a map of neg, neu, pos and compound for every text.

    ``lexicon`` has the columns word (lower case, unique) and valence. Words are runs of a-z. The shares neg,
    neu and pos are of the word count; compound is x / sqrt(x * x + 15) of the valence sum. Words are counted inside the
    row, as runs of the sorted words, so that each different word of a text is one row of the join (the lexicon is broadcast by Spark
    while small) and only (key, four numbers) is shuffled after it. One more row with the number of all words, spread over many names that no
    lexicon has, brings texts without a hit along.
    """
    words = F.array_sort(F.filter(F.split(F.lower(F.col(text)), "[^a-z]+"), lambda w: w != ""))
    sorted_words = texts.select(key, F.coalesce(words, F.array().cast("array<string>")).alias("_w"))
    n = F.size("_w")
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    first = F.filter(places, lambda i: (i == 0) | (F.get("_w", i) != F.get("_w", i - 1)))
    starts = sorted_words.select(key, "_w", n.alias("_all"), first.alias("_s"))
    runs = F.transform("_s", lambda s, k: F.struct(F.get("_w", s).alias("word"), (F.coalesce(F.get("_s", k + 1), F.col("_all")) - s).alias("n")))
    whole = F.struct(F.concat(F.lit("#"), F.pmod(F.xxhash64(key), F.lit(MARKS)).cast("string")).alias("word"), F.col("_all").alias("n"))
    counted = starts.select(key, F.explode(F.concat(F.array(whole), runs)).alias("_r")).select(key, F.col("_r.word").alias("_word"), F.col("_r.n").alias("_n"))
    scored = counted.join(lexicon.select(F.col("word").alias("_word"), "valence"), "_word", "left")
    is_all, x = F.col("_word").startswith("#"), F.col("valence")
    scored = scored.where(is_all | x.isNotNull())
    sums = scored.groupBy(key).agg(
        F.sum(F.when(is_all, F.col("_n")).otherwise(0)).alias("_n"),
        F.sum(F.when(x < 0, F.col("_n")).otherwise(0)).alias("_neg"),
        F.sum(F.when(x > 0, F.col("_n")).otherwise(0)).alias("_pos"),
        F.coalesce(F.sum(x * F.col("_n")), F.lit(0.0)).cast("double").alias("_x"),
    )
    n = F.greatest(F.col("_n"), F.lit(1)).cast("double")
    scores = F.create_map(
        F.lit("neg"), F.col("_neg") / n,
        F.lit("neu"), (F.col("_n") - F.col("_neg") - F.col("_pos")) / n,
        F.lit("pos"), F.col("_pos") / n,
        F.lit("compound"), F.col("_x") / F.sqrt(F.col("_x") * F.col("_x") + F.lit(ALPHA)),
    )
    return sums.select(key, scores.alias("scores"))
