"""Row and set expectations, quarantine, metrics and reconciliation.

A rule passes only where its condition is TRUE; FALSE and NULL are violations. FAIL beats
DROP, DROP beats WARN. Metrics count every rule over all input rows, whatever other rules do.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"
METRICS_SCHEMA = "dataset string, name string, passed_records long, failed_records long, dropped_records long"


class ExpectationFailed(Exception):
    """A FAIL rule was violated; nothing may be written."""


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    action: str = WARN

    def __post_init__(self) -> None:
        if self.action not in (WARN, DROP, FAIL):
            raise ValueError(f"unknown action {self.action!r} of rule {self.name}")

    def passes(self, null_passes: bool = False) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(null_passes))


def warn_rules(conditions: Mapping[str, str] | str) -> list[Rule]:
    """Rules from a name -> condition map or its JSON text (a row of a source registry)."""
    if isinstance(conditions, str):
        conditions = json.loads(conditions)
    return [Rule(name, text) for name, text in conditions.items()]


def _every(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def expect(df: DataFrame, rules: Sequence[Rule], null_passes: bool = False) -> DataFrame:
    """Keep, drop or fail rows by their rules; works on batch and streaming frames.

    DROP conditions are plain filters, which reach the scan. The FAIL rules of a batch frame are judged here and now, by one
    aggregate over all its rows that reads only the rules' columns; a violation raises before there is a frame to go on with, so that no
    limit, filter or join that follows can hide it. ``sinks.publish_checked`` judges without a second read, while a staged copy is
    written. In a streaming frame a violation raises while the batch runs: the verdict stands in one CASE with the drop conditions and
    reads a random text (never empty), which the optimizer may not move or repeat.
    """
    drops = [r for r in rules if r.action == DROP]
    fails = [r for r in rules if r.action == FAIL]
    if not df.isStreaming:
        check_fail_rules(df, fails, null_passes)
        fails = []
    if not fails:
        for rule in drops:
            df = df.where(rule.passes(null_passes) if null_passes else F.expr(rule.condition))
        return df
    verdict = None
    for rule in fails:
        stop = F.raise_error(F.lit(f"expectation {rule.name} failed: {rule.condition}")).cast("boolean")
        broken = ~rule.passes(null_passes)
        verdict = F.when(broken, stop) if verdict is None else verdict.when(broken, stop)
    judged = F.uuid() != ""
    return df.where(verdict.otherwise(judged & _every([r.passes(null_passes) for r in drops])))


def expect_all(df: DataFrame, conditions: Mapping[str, str] | str) -> DataFrame:
    """All rows, with the names of the violated (warn) rules in ``failed_rules``."""
    return with_failed_rules(df, warn_rules(conditions))


def check_fail_rules(df: DataFrame, rules: Sequence[Rule], null_passes: bool = False) -> None:
    """Run the FAIL rules as one aggregate over all rows and raise with counts."""
    fails = [r for r in rules if r.action == FAIL]
    if fails:
        raise_broken(fails, df.agg(*_violations(fails, null_passes)).first().asDict())


def _violations(fails: Sequence[Rule], null_passes: bool = False) -> list[Column]:
    return [F.count_if(~r.passes(null_passes)).alias(f"_fail_{i}") for i, r in enumerate(fails)]


def observe_violations(df: DataFrame, rules: Sequence[Rule], observation: Observation, null_passes: bool = False) -> DataFrame:
    """The same rows; their violations of the FAIL rules are counted by whatever writes them."""
    return df.observe(observation, *_violations([r for r in rules if r.action == FAIL], null_passes))


def raise_broken(rules: Sequence[Rule], counts: Mapping[str, int]) -> None:
    """Raise if the counts of ``observe_violations`` hold a violation."""
    fails = [r for r in rules if r.action == FAIL]
    broken = {r.name: counts[f"_fail_{i}"] for i, r in enumerate(fails) if counts.get(f"_fail_{i}")}
    if broken:
        raise ExpectationFailed("expectation " + ", ".join(f"{name}: {n} rows" for name, n in broken.items()))


def with_failed_rules(df: DataFrame, rules: Sequence[Rule], null_passes: bool = False) -> DataFrame:
    marks = [F.when(~r.passes(null_passes), F.lit(r.name)) for r in rules]
    return df.withColumn("failed_rules", F.array_compact(F.array(*marks)))


def split(
    df: DataFrame, rules: Sequence[Rule], disjoint: bool = False, null_passes: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine). Quarantine has every row that violates any rule.

    By default good loses only rows of DROP rules, so a row with a mere warning is in both.
    With ``disjoint`` good is the exact complement of quarantine.
    """
    any_broken = ~_every([r.passes(null_passes) for r in rules])
    quarantine = with_failed_rules(df.where(any_broken), rules, null_passes)
    good = df.where(_every([r.passes(null_passes) for r in rules])) if disjoint else expect(df, rules, null_passes)
    return good, quarantine


def _metric_columns(rules: Sequence[Rule]) -> list[Column]:
    dropped = ~_every([r.passes() for r in rules if r.action == DROP])
    counts = [F.count(F.lit(1)).alias("_rows"), F.count_if(dropped).alias("_dropped")]
    return counts + [F.count_if(r.passes()).alias(f"_pass_{i}") for i, r in enumerate(rules)]


def count_rules(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One row: row_count, dropped_records and an array with the counts of each rule.

    All rules are counted in a single aggregate pass.
    """
    counted = df.agg(*_metric_columns(rules))
    results = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(r.name).alias("name"),
            F.col(f"_pass_{i}").alias("passed_records"),
            (F.col("_rows") - F.col(f"_pass_{i}")).alias("failed_records"),
        )
        for i, r in enumerate(rules)
    ]
    return counted.select(
        F.col("_rows").alias("row_count"),
        F.col("_dropped").alias("dropped_records"),
        F.array(*results).alias("expectations"),
    )


def metrics(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """(dataset, name, passed_records, failed_records, dropped_records), one row per rule."""
    counted = count_rules(df, rules, dataset)
    return counted.select(F.inline("expectations"), "dropped_records")


def observe(df: DataFrame, rules: Sequence[Rule], observation: Observation | str) -> DataFrame:
    """The same rows; the rule counts come along with whatever action or stream runs them.

    Put it before ``expect``, so that dropped rows are counted.
    """
    return df.observe(observation, *_metric_columns(rules))


def observed_metrics(values: Mapping[str, int], rules: Sequence[Rule], dataset: str) -> list[dict]:
    """Rows like those of ``metrics`` from the values of an observation or a stream progress."""
    return [
        {
            "dataset": dataset,
            "name": r.name,
            "passed_records": values[f"_pass_{i}"],
            "failed_records": values["_rows"] - values[f"_pass_{i}"],
            "dropped_records": values["_dropped"],
        }
        for i, r in enumerate(rules)
    ]


def with_set_measure(
    df: DataFrame, group: Sequence[str], where: str, name: str = "set_count", source: DataFrame | None = None
) -> DataFrame:
    """Each row with the number of rows of its group that satisfy ``where`` (0 where none do).

    The counts are combined map-side and joined back without a hint. They come from ``source``
    where given: a stream is judged against the table that it belongs to.
    """
    counted = df if source is None else source
    counts = counted.where(F.expr(where)).groupBy(*group).agg(F.count(F.lit(1)).alias(name))
    counts = counts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], name)
    match = _every([F.col(g) == F.col(f"_g{i}") for i, g in enumerate(group)])
    joined = df.join(counts, match, "left")
    return joined.select(*df.columns, F.coalesce(name, F.lit(0)).alias(name))


def with_stored_measure(df: DataFrame, counts: DataFrame, group: Sequence[str], stored: str, name: str = "set_count") -> DataFrame:
    """Each row with its group's number from stored counts (``streaming.totals`` keeps them), 0 where there is none."""
    known = counts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col(stored).alias("_stored"))
    match = _every([F.col(g) == F.col(f"_g{i}") for i, g in enumerate(group)])
    return df.join(known, match, "left").select(*df.columns, F.coalesce("_stored", F.lit(0)).alias(name))


def expect_set(
    df: DataFrame,
    group: Sequence[str],
    where: str,
    bound: int,
    action: str = DROP,
    name: str = "set_count",
    source: DataFrame | None = None,
) -> DataFrame:
    """Set rule: at most ``bound`` rows with ``where`` per group. All rows of a bad group are judged.

    ``df`` may be a stream if ``source``, the table to count in, is given.
    """
    measured = with_set_measure(df, group, where, name, source)
    return expect(measured, [Rule(f"at_most_{bound}", f"`{name}` <= {bound}", action)])


def expect_reference(enriched: DataFrame, attribute: str, action: str = DROP) -> DataFrame:
    """Referential rule after a left join: the looked-up attribute must be there."""
    return expect(enriched, [Rule(f"known_{attribute}", f"`{attribute}` IS NOT NULL", action)])


def not_landed(
    landing: DataFrame, loaded: DataFrame, on: str, loaded_on: str | None = None, null_empties: bool = False
) -> DataFrame:
    """Distinct landing names with no row in the loaded layer.

    A shuffled anti join, unlike NOT IN, which can only broadcast its list. NULL names in the
    loaded layer are ignored; ``null_empties`` gives NOT IN's own rule: one NULL and nothing
    is returned.
    """
    names = landing.select(on).distinct()
    present = loaded.select(F.col(loaded_on or on).alias(on))
    missing = names.where(F.col(on).isNotNull()).join(present.distinct(), on, "left_anti")
    if null_empties:
        any_null = present.agg(F.coalesce(F.bool_or(F.col(on).isNull()), F.lit(False)).alias("any_null"))
        missing = missing.where(~any_null.scalar())
    return missing


def profile(df: DataFrame, layer: str, key: str, changed_at: str) -> DataFrame:
    """Counts, distinct keys, largest key and latest change of one layer."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(key).alias("key_count"),
        F.max(key).alias("max_key"),
        F.max(changed_at).alias("latest_change"),
    ).select(F.lit(layer).alias("layer"), "*")


def reconcile(layers: Mapping[str, DataFrame], key: str, changed_at: str) -> DataFrame:
    """Profiles of several layers, one row each."""
    profiles = [profile(df, name, key, changed_at) for name, df in layers.items()]
    return reduce(DataFrame.unionByName, profiles)
