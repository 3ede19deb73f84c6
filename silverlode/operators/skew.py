"""Order-preserving slices for keys that hold a large share of all rows.

A window partitioned by key puts one key into one task. For the rare heavy keys the rows
are cut into consecutive ranges of the ordering column, so that a window can run per
(key, slice); the caller then stitches neighbouring slices together.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "_slice"
KEY_HASH = "_hash"
# A key is heavy when it holds more than this share of the rows. At most 1 / SHARE keys
# can be heavy and the slices of all of them number at most 2 / SHARE, whatever the data.
SHARE = 1 / 1000
# Values of heavy keys from which the bounds of a text sequence are taken.
SAMPLED_TEXTS = 65536
# Entries of the frequency sketch; every item above 1/3000 of the rows is sure to be found.
SKETCH_ITEMS = 8192

PER_MILLE = f"array({', '.join(str(i / 1000) for i in range(1, 1000))})"

_SLICEABLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)


@dataclass(frozen=True)
class Slices:
    """Rows with their ``_slice``; where keys are heavy the rows also carry ``_hash``."""

    rows: DataFrame
    heavy: list[int] = field(default_factory=list)
    # Whether equal (key, order) pairs alone could fill a task.
    copies: bool = False

    def is_heavy(self) -> Column:
        return F.col(KEY_HASH).isin(self.heavy)


def heavy_keys(df: DataFrame, keys: list[str], share: float = SHARE) -> tuple[int, dict[int, int]]:
    """(row count, hash -> rows of each heavy key) from one mergeable sketch; no shuffle by key."""
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(
            f"approx_top_k(xxhash64({', '.join(f'`{k}`' for k in keys)}), {int(1 / share)}, {SKETCH_ITEMS})"
        ).alias("top"),
    ).first()
    floor = share * found["rows"]
    return found["rows"], {t["item"]: t["count"] for t in found["top"] or [] if t["count"] > floor}


def _text_quantiles(hashed: DataFrame, order: str) -> dict[int, list[str]]:
    """999 quantiles of a text sequence for each heavy key, from a bounded sample drawn by hash; only bounds depend on it."""
    drawn = hashed.select(KEY_HASH, order, F.xxhash64(order, F.monotonically_increasing_id()).alias("_h"))
    found: dict[int, list[str]] = {}
    for row in drawn.orderBy("_h").limit(SAMPLED_TEXTS).collect():
        found.setdefault(row[0], []).append(row[1])
    # Spark compares texts by their UTF-8 bytes.
    return {k: [v[len(v) * i // 1000] for i in range(1, 1000)] for k, own in found.items() if (v := sorted(own, key=lambda t: t.encode()))}


def add_slices(df: DataFrame, keys: list[str], order: str, share: float = SHARE) -> Slices:
    """Number the rows of a heavy key by range of ``order``; all other rows get slice 0.

    Equal (key, order) rows always share a slice. Numbers, dates, timestamps and texts are cut; a
    key ordered by another type stays in one task.
    """
    flat = Slices(df.withColumn(SLICE, F.lit(0)))
    if not isinstance(df.schema[order].dataType, _SLICEABLE):
        return flat
    total, heavy = heavy_keys(df, keys, share)
    if not heavy:
        return flat

    most = int(1 / share)
    wanted = {item: min(max(ceil(rows / (share * total)), 2), most) for item, rows in heavy.items()}
    hashed = df.withColumn(KEY_HASH, F.xxhash64(*keys))
    # One row per heavy key: at most 1 / share rows, each with at most 1 / share cuts.
    own = hashed.where(F.col(KEY_HASH).isin(list(heavy)))
    is_text = isinstance(df.schema[order].dataType, T.StringType)
    texts = _text_quantiles(own, order) if is_text else {}
    quantiles = F.lit(None) if is_text else F.expr(f"percentile_approx(`{order}`, {PER_MILLE}, 10000)")
    found = (
        own.groupBy(KEY_HASH)
        .agg(
            quantiles.alias("quantiles"),
            F.expr(f"coalesce(get(approx_top_k(xxhash64(`{order}`), 1, {SKETCH_ITEMS}), 0).count, 0)").alias("copies"),
        )
        .collect()
    )
    block = isqrt(most) + 1
    bounds = []
    for row in found:
        pieces = wanted[row[KEY_HASH]]
        cuts = texts.get(row[KEY_HASH], []) if is_text else row["quantiles"]
        bounds.append((row[KEY_HASH], [cuts[i * 999 // pieces] for i in range(1, pieces)] if cuts else []))
    kind = df.schema[order].dataType.simpleString()
    # Sorted by Spark's own order of the type, on which the counting below relies.
    cut_points = (
        df.sparkSession.createDataFrame(bounds, f"{KEY_HASH} long, _cuts array<{kind}>")
        .withColumn("_cuts", F.array_sort(F.array_distinct("_cuts")))
        .withColumn("_coarse", F.filter("_cuts", lambda _, i: i % block == block - 1))
    )
    # Coarse, then fine counting: about 2 / sqrt(share) comparisons for a row of a heavy key.
    coarse = F.size(F.filter("_coarse", lambda c: c <= F.col(order))) * block
    fine = F.size(F.filter(F.slice("_cuts", coarse + 1, block), lambda c: c <= F.col(order)))
    numbered = (
        hashed.join(F.broadcast(cut_points), KEY_HASH, "left")
        .withColumn(SLICE, F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(coarse + fine))
        .drop("_cuts", "_coarse")
    )
    crowded = max(row["copies"] for row in found) > share * total
    return Slices(numbered, list(heavy), crowded)
