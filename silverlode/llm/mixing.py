"""Mixing sources to target weights by iterative proportional fitting.

Token totals by source, language and topic are raked to a target share on each of the three
margins and to a token budget, no cell above what it holds; a document is then kept with
its cell's share kept, by a hash of its id and text, so that a rerun draws the same sample.

The cells are a Spark table, one row for each (source, language, topic) in use, and every source and every language is a category of
its own, however small. A round scales the cells to one margin after the other, each by a partial aggregate and a join back,
and is written; rounds end when no cell moves by more than ``TOLERANCE`` of all tokens.

Topic: every document is a profile of 64 hashed word frequencies (square roots, unit length) less the mean
of its language, so that the topic margin asks for something else than the language margin; eight centres are
moved by Lloyd steps over all documents, from the eight different profiles with the least hash. Languages with less than 1/4096 of
the tokens share one mean there (and nowhere else), so the driver holds at most 4097 means and eight centres, and never a row a document or a cell.

Cases: null source or language counts as the empty string; null text is empty, has no tokens and the topic of
an empty profile, and is kept with its cell's share; a cell without tokens keeps its documents; repeated rows are
drawn alike; an empty input gives an empty result; other columns are carried along by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.buffers import groups, text_buffer, words
from silverlode.llm.frames import release, same_store, stored

SLOTS, TOPICS, STEPS = 64, 8, 8
SMALLEST = 1 / 4096
TEMPER = 0.9
REST = "(rest)"
SEED = 11
MARGINS = ("source", "lang", "topic")
TOLERANCE, ROUNDS = 1e-6, 200


@dataclass
class Mix:
    """Language means, centres of the topics, and (source, lang, topic, weight, probability) of each cell."""

    means: dict[str, np.ndarray]
    centres: np.ndarray
    cells: DataFrame


def profiles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Profile and number of words of each text."""
    found, number = [], []
    for i, j in groups(offsets):
        hashed, _, _, row = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        slot = row * SLOTS + (hashed & np.uint64(SLOTS - 1)).astype(np.int64)
        counts = np.bincount(slot, minlength=(j - i) * SLOTS).reshape(-1, SLOTS)
        found.append(np.sqrt(counts / np.maximum(1, counts.sum(1, keepdims=True))))
        number.append(counts.sum(1))
    if not found:
        return np.zeros((0, SLOTS)), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(number)


def nearest(x: np.ndarray, languages: list[str], means: dict[str, np.ndarray], centres: np.ndarray) -> np.ndarray:
    x = less_means(x, languages, means)
    return ((centres * centres).sum(1)[None, :] - 2 * x @ centres.T).argmin(1)


def _measured(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """(doc_id, source, lang, tie, n_tokens, profile) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, number = profiles(*text_buffer(batch.column(4)))
            packed = pa.array([r.tobytes() for r in x.astype("<f4")], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(number, pa.int64()), packed], ["doc_id", "source", "lang", "tie", "n_tokens", "profile"]
            )

    rows = docs.select(*_keys(names), F.col(f"`{names['text']}`").alias("text"))
    return rows.mapInArrow(run, rows.drop("text").schema.add("n_tokens", "long").add("profile", "binary"))


def _keys(names: dict[str, str]) -> list[Column]:
    text = F.coalesce(F.col(f"`{names['text']}`"), F.lit(""))
    plain = {k: F.coalesce(F.col(f"`{names[k]}`").cast("string"), F.lit("")).alias(k) for k in ("source", "lang")}
    return [F.col(f"`{names['doc_id']}`").cast("string").alias("doc_id"), plain["source"], plain["lang"], F.xxhash64(text).alias("tie")]


def _matrix(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<f4").reshape(-1, SLOTS).astype(float)


def less_means(x: np.ndarray, languages: list[str], means: dict[str, np.ndarray]) -> np.ndarray:
    none = means.get(REST, np.zeros(SLOTS))
    return x - np.stack([means.get(v, none) for v in languages]) if len(x) else x


def _sums(rows: DataFrame, group_of) -> dict:
    """Sums and number of profiles by group; ``group_of`` gives (profiles, groups) of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            x, group = group_of(_matrix(batch.column(1).to_pylist()), batch.column(0).to_pylist())
            names, at = np.unique(np.array(group, dtype=object).astype(str), return_inverse=True)
            own = np.zeros((len(names), SLOTS + 1))
            np.add.at(own, at, np.column_stack((x, np.ones(len(x)))))
            for name, values in zip(names.tolist(), own):
                sums[name] = sums.get(name, 0) + values
        for name, values in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(values)), pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["name", "place", "value"]
            )

    parts = rows.select("lang", "profile").mapInArrow(run, "name string, place int, value double")
    out: dict[str, np.ndarray] = {}
    for r in parts.groupBy("name", "place").agg(F.sum("value").alias("value")).collect():  # a row a group and slot
        out.setdefault(r["name"], np.zeros(SLOTS + 1))[r["place"]] = r["value"]
    return out


def language_means(rows: DataFrame, languages: list[str]) -> dict[str, np.ndarray]:
    known = set(languages)
    sums = _sums(rows, lambda x, lang: (x, [v if v in known else REST for v in lang]))
    return {k: v[:-1] / v[-1] for k, v in sums.items()}


def topic_centres(rows: DataFrame, means: dict[str, np.ndarray], topics: int = TOPICS, steps: int = STEPS) -> np.ndarray:
    """Topic centres over all profiles less their language's mean."""
    some = rows.select("tie", "lang", "profile").distinct().orderBy(F.xxhash64("tie"), "lang", "profile").limit(topics).collect()
    if not some:
        return np.zeros((1, SLOTS))
    x = less_means(_matrix([r["profile"] for r in some]), [r["lang"] for r in some], means)
    now = x[:topics]
    for _ in range(steps):
        here = now
        sums = _sums(rows, lambda x, lang, here=here: (less_means(x, lang, means), nearest(x, lang, means, here)))
        now = np.stack([sums[str(k)][:-1] / sums[str(k)][-1] if str(k) in sums else now[k] for k in range(len(now))])
    return now


def margin_goals(cells: DataFrame, targets: dict[str, dict] | None = None, temper: float = TEMPER) -> dict[str, DataFrame]:
    """For each margin (value, share, goal): the share of all tokens a category has and is to have; goals sum to 1.

    Given targets are taken as they are, a category they do not name gets none; other margins get their shares to the power ``temper``.
    """
    spark, found = cells.sparkSession, {}
    total = F.lit(float(cells.agg(F.sum("n")).first()[0] or 0) or 1.0)
    for name in MARGINS:
        own = cells.groupBy(name).agg((F.sum("n") / total).alias("share")).withColumnRenamed(name, "value")
        given = (targets or {}).get(name)
        if given:
            kind = cells.schema[name].dataType.simpleString()
            asked = spark.createDataFrame([(k, float(v)) for k, v in given.items()], f"value {kind}, asked double")
            own = own.join(asked, "value", "left").withColumn("goal", F.coalesce("asked", F.lit(0.0))).drop("asked")
        else:
            own = own.withColumn("goal", F.col("share") ** F.lit(temper))
        own = stored(own.withColumn("goal", F.when(F.col("share") > 0, F.col("goal")).otherwise(0.0)), f"goal-{name}")
        whole = own.agg(F.sum("goal")).first()[0] or 1.0
        found[name] = same_store(own.withColumn("goal", F.col("goal") / F.lit(whole)), own)
    return found


def scarcest(goals: dict[str, DataFrame]) -> float:
    """The largest budget that no category of any margin is too scarce for."""
    found = 1.0
    for goal in goals.values():
        least = goal.where("share > 0 AND goal > 0").agg(F.min(F.col("share") / F.col("goal"))).first()[0]
        found = min(found, least if least is not None else 1.0)
    return float(found)


def raked(cells: DataFrame, goals: dict[str, DataFrame], budget: float, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with ``taken``: tokens to take of each; margins in the proportions of the goals, ``budget`` of all, no cell above its ``n``."""
    total = float(cells.agg(F.sum("n")).first()[0] or 0)
    now = stored(cells.select(*MARGINS, "n", (F.col("n") * budget).alias("taken")), "raked")
    for _ in range(rounds):
        moved = now.withColumn("before", F.col("taken"))
        for name in MARGINS:
            have = moved.groupBy(name).agg(F.sum("taken").alias("have")).join(goals[name].withColumnRenamed("value", name), name)
            factor = F.when(F.col("have") > 0, F.col("goal") * F.lit(total * budget) / F.col("have")).otherwise(1.0)
            moved = moved.join(have.select(name, factor.alias("factor")), name)
            moved = moved.withColumn("taken", F.least("n", F.col("taken") * F.col("factor"))).drop("factor")
        moved = stored(moved, "raked", (now,))
        change = moved.agg(F.max(F.abs(F.col("taken") - F.col("before")))).first()[0] or 0.0
        now = same_store(moved.drop("before"), moved)
        if change <= TOLERANCE * max(1.0, total):
            break
    return now


def _kept(rows: DataFrame, column: str) -> list[str]:
    """Languages with enough of the tokens for a mean of their own: at most 4096."""
    total = rows.agg(F.sum("n_tokens")).first()[0] or 0
    sums = rows.groupBy(column).agg(F.sum("n_tokens").alias("n")).where(F.col("n") >= total * SMALLEST)
    return sorted(r[0] for r in sums.collect())


def _topic(rows: DataFrame, means: dict[str, np.ndarray], found: np.ndarray) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((means, found))

    @F.pandas_udf("int")
    def topic(profile: pd.Series, lang: pd.Series) -> pd.Series:
        return pd.Series(nearest(_matrix(profile.tolist()), lang.tolist(), *shared.value), dtype="int32")

    return rows.withColumn("topic", topic("profile", "lang"))


def fit(
    docs: DataFrame, targets: dict[str, dict] | None = None, temper: float = TEMPER, budget: float | None = None, **columns: str
) -> tuple[DataFrame, Mix]:
    """Measured rows with their topic, and the mix; a margin without ``targets`` gets its shares to the power ``temper``.

    Without a ``budget`` as many tokens are taken as the scarcest category of any margin allows, less 5 %.
    """
    names = {"doc_id": "doc_id", "source": "source", "lang": "lang", "text": "text"} | columns
    rows = stored(_measured(docs, names), "profiles")
    languages = _kept(rows, "lang")
    worded = rows.where("n_tokens > 0")
    means = language_means(worded, languages)
    found = topic_centres(worded, means)
    rows = stored(_topic(rows, means, found).drop("profile"), "topics", (rows,))
    cells = stored(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").cast("double").alias("n")), "cells")
    goals = margin_goals(cells, targets, temper)
    budget = 0.95 * scarcest(goals) if budget is None else budget
    taken = raked(cells, goals, budget)
    share = F.when(F.col("n") > 0, F.col("taken") / F.col("n")).otherwise(1.0)
    kept = taken.select(*MARGINS, (share / budget).alias("weight"), share.alias("probability"))
    kept = stored(kept, "shares", (taken, cells, *goals.values()))
    return rows, Mix(means, found, kept)


def drawn(rows: DataFrame, mix: Mix, seed: int = SEED) -> DataFrame:
    """Rows with weight (against an even sample), probability and whether the document is drawn."""
    chance = F.pmod(F.xxhash64("doc_id", "tie", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return rows.join(mix.cells, list(MARGINS)).withColumn("sampled", chance < F.col("probability"))


def weights(docs: DataFrame, targets: dict[str, dict] | None = None, **columns: str) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, weight, probability, sampled), one row a document."""
    rows, mix = fit(docs, targets, **columns)
    kind = docs.schema[columns.get("doc_id", "doc_id")].dataType
    found = drawn(rows, mix).withColumn("doc_id", F.col("doc_id").cast(kind))
    return found.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled")


def mixed(docs: DataFrame, targets: dict[str, dict] | None = None, **columns: str) -> DataFrame:
    """The rows of ``docs`` that are drawn, as they are."""
    names = {"doc_id": "doc_id", "source": "source", "lang": "lang", "text": "text"} | columns
    measured, mix = fit(docs, targets, **columns)
    release(measured)
    shared = docs.sparkSession.sparkContext.broadcast((mix.means, mix.centres))

    @F.pandas_udf("int")
    def topic(text: pd.Series, lang: pd.Series) -> pd.Series:
        x, _ = profiles(*text_buffer(pa.array(text, pa.large_string())))
        return pd.Series(nearest(x.astype("<f4").astype(float), lang.tolist(), *shared.value), dtype="int32")

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keys = docs.select(whole, F.col(f"`{names['text']}`").alias("_text"), *_keys(names))
    rows = keys.select("_row", "doc_id", "source", "lang", "tie", topic("_text", "lang").alias("topic"))
    return drawn(rows, mix).where("sampled").select("_row.*")
