"""Quality score of documents by regularised quadratic discriminant analysis.

Each document becomes a row of statistics of its whole text (``NAMES``), transformed to be bounded
and roughly normal. For both labels the mean and covariance come from sums over all labelled
rows that Spark adds up, in one pass; each covariance is shrunk towards its own diagonal and the
pooled one, and its Cholesky factor is kept. The score is the logistic of the difference of the two
Mahalanobis log densities plus the log odds of the labels.

Cases: null text counts as empty and is scored like any other; null or other labels are not learnt from;
several labels of one doc_id all count; a label that never occurs gives a constant score; an empty input
gives an empty result; ``accepted`` carries all other columns along, ``score_documents`` none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.buffers import WORD_BYTES, groups, prefix, slices, text_buffer, words
from silverlode.llm.frames import stored

SHRINKAGE = 0.01
POOLED = 0.3
ACCEPTED = 0.3

_CLASSES = {
    "upper": [ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"],
    "lower": [ord(c) for c in "abcdefghijklmnopqrstuvwxyz"],
    "digit": [ord(c) for c in "0123456789"],
    "stop": [ord(c) for c in ".!?"],
    "comma": [ord(c) for c in ",;:"],
    "symbol": [ord(c) for c in "#$%&*+/<=>@\\^_`{|}~[]()"],
    "bang": [ord("!")],
    "space": [0x20, 0x09],
    "line": [0x0A],
    "beyond": list(range(0x80, 0x100)),
}
NAMES = [
    "log_bytes", "log_words", "word_length", "word_length_spread", "long_words", "short_words",
    *(f"share_{k}" for k in _CLASSES), "capital_words", "upper_words", "distinct_words", "top_word", "repeated_neighbours",
    "distinct_pairs", "distinct_triples", "log_lines", "line_words", "distinct_lines", "words_a_stop", "symbol_runs", "word_entropy",
]


def _distinct(owner: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each row, the share of the most frequent one, the entropy, and the number of values."""
    # One sort of words that hold most bits of the value and the row.
    bits = np.uint64(max(1, int(rows).bit_length()))
    merged = np.sort((value >> bits << bits) | owner.astype(np.uint64))
    new = np.ones(len(merged), bool)
    new[1:] = merged[1:] != merged[:-1]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(merged)))
    o = (merged[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    total = np.bincount(owner, minlength=rows)
    distinct = np.bincount(o, minlength=rows)
    top = np.zeros(rows)
    np.maximum.at(top, o, times)
    share = times / np.maximum(total[o], 1)
    entropy = np.bincount(o, weights=-share * np.log(share), minlength=rows)
    return distinct, top / np.maximum(total, 1), entropy, total


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed statistics for each text."""
    return np.concatenate(
        [_statistics(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in groups(offsets)]
        or [np.zeros((0, len(NAMES)))]
    )


def _statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    some = np.maximum(size, 1)

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    shares = []
    kinds = {}
    for name, members in _CLASSES.items():
        table = np.zeros(256, bool)
        table[members] = True
        kinds[name] = table[data]
        shares.append(np.sqrt(per_row(kinds[name]) / some))
    hashed, start, end, row = words(data, offsets)
    length = (end - start).astype(float)
    number = np.bincount(row, minlength=rows).astype(float)
    n = np.maximum(number, 1)

    def word_mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=values, minlength=rows) / n

    mean = word_mean(length)
    spread = np.sqrt(np.maximum(word_mean(length**2) - mean**2, 0))
    first_upper = kinds["upper"][start] if len(start) else np.zeros(0, bool)
    uppers = np.concatenate(([0], np.cumsum(kinds["upper"] | kinds["beyond"])))
    all_upper = ((uppers[end] - uppers[start]) == (end - start)) & first_upper & (length > 1)
    distinct, top, entropy, _ = _distinct(row, hashed, rows)
    same = np.zeros(len(row), bool)
    same[1:] = (hashed[1:] == hashed[:-1]) & (row[1:] == row[:-1])
    runs = []
    for k in (2, 3):
        inside = row[k - 1 :] == row[: max(0, len(row) - k + 1)]
        at = np.flatnonzero(inside)
        value = slices(prefix(hashed), at, at + k)
        d, _, _, total = _distinct(row[at], value, rows)
        runs.append(np.where(total > 0, d / np.maximum(total, 1), 1.0))
    cut = np.zeros(len(data) + 1, bool)
    cut[1:] = kinds["line"]
    cut[offsets] = True
    marks = np.flatnonzero(cut)
    line_start, line_end = marks[:-1], marks[1:]
    line_row = np.searchsorted(offsets, line_start, "right") - 1
    d_lines, _, _, n_lines = _distinct(line_row, slices(prefix(data), line_start, line_end), rows)
    marks_in = ~WORD_BYTES[data] & ~kinds["space"] & ~kinds["line"]
    doubled = np.zeros(len(data), bool)
    doubled[1:] = marks_in[1:] & marks_in[:-1]
    lines = np.maximum(n_lines, 1)
    return np.column_stack(
        [
            np.log1p(size), np.log1p(number), np.log1p(mean), np.log1p(spread), np.sqrt(word_mean(length > 12)), np.sqrt(word_mean(length < 3)),
            *shares, np.sqrt(word_mean(first_upper)), np.sqrt(word_mean(all_upper)), np.where(number > 0, distinct / n, 1.0), np.sqrt(top),
            np.sqrt(word_mean(same)), *runs, np.log1p(n_lines), np.log1p(number / lines), np.where(n_lines > 0, d_lines / lines, 1.0),
            np.log1p(number / (per_row(kinds["stop"]) + 1)), np.sqrt(per_row(doubled) / some), entropy / np.log(np.maximum(number, 2)),
        ]
    )


class Discriminant:
    """Means, Cholesky factors and log odds of both labels."""

    def __init__(self, count: np.ndarray, total: np.ndarray, square: np.ndarray, shrinkage: float = SHRINKAGE) -> None:
        """count, sums and sums of outer products of the transformed statistics, by label."""
        size = total.shape[1]
        self.known = bool((count > 0).all())
        self.share = float(count[1] / max(1.0, count.sum()))
        if not self.known:
            return
        mean = total / count[:, None]
        covariance = square / count[:, None, None] - mean[:, :, None] * mean[:, None, :]
        pooled = (covariance * (count / count.sum())[:, None, None]).sum(0)
        unit = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
        self.centre, self.unit = mean.mean(0), unit
        self.mean = (mean - self.centre) / unit
        scale = np.outer(unit, unit)
        self.factor, self.log_det = [], []
        for label in (0, 1):
            own = covariance[label] / scale
            own = (1 - POOLED) * own + POOLED * pooled / scale
            own = (1 - shrinkage) * own + shrinkage * np.diag(np.diag(own)) + 0.01 * np.eye(size)
            factor = np.linalg.cholesky(own)
            self.factor.append(np.linalg.inv(factor))
            self.log_det.append(2 * np.log(np.diag(factor)).sum())
        self.prior = float(np.log(count[1] / count[0]))

    @classmethod
    def fit_rows(cls, x: np.ndarray, label: np.ndarray, shrinkage: float = SHRINKAGE) -> Discriminant:
        parts = [x[label == k] for k in (0, 1)]
        return cls(np.array([len(p) for p in parts], float), np.stack([p.sum(0) for p in parts]), np.stack([p.T @ p for p in parts]), shrinkage)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.known:
            return np.full(len(x), self.share)
        z = (x - self.centre) / self.unit
        density = []
        for label in (0, 1):
            w = (z - self.mean[label]) @ self.factor[label].T
            density.append(-0.5 * ((w * w).sum(1) + self.log_det[label]))
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) + self.prior, -500, 500)))


def measured(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """The columns ``carry`` of every row, and ``statistics`` of its text as little-endian doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics(*text_buffer(batch.column(batch.num_columns - 1))).astype("<f8")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([x.tobytes() for x in found], pa.binary())], [*batch.schema.names[:-1], "statistics"]
            )

    rows = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`").alias("_text"))
    schema = rows.drop("_text").schema.add("statistics", "binary")
    return rows.mapInArrow(run, schema)


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, len(NAMES))


def fit(labelled: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """From (label, statistics) rows, by sums that Spark adds up; labels other than 0 and 1 are left out."""
    size = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + size + size * size))
        for batch in batches:
            x, label = _rows(batch.column(1)), np.array(batch.column(0))
            for k in (0, 1):
                own = x[label == k]
                sums[k] += np.concatenate(([len(own)], own.sum(0), (own.T @ own).reshape(-1)))
        for k in (0, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(sums.shape[1], k, np.int32)), pa.array(np.arange(sums.shape[1], dtype=np.int32)), pa.array(sums[k])],
                ["label", "place", "value"],
            )

    rows = labelled.where("label IN (0, 1)").select(F.col("label").cast("int").alias("label"), "statistics")
    parts = rows.mapInArrow(run, "label int, place int, value double").groupBy("label", "place").agg(F.sum("value").alias("value"))
    total = np.zeros((2, 1 + size + size * size))
    for r in parts.collect():  # 2 x 871 rows whatever the input
        total[r["label"], r["place"]] = r["value"]
    return Discriminant(total[:, 0], total[:, 1 : 1 + size], total[:, 1 + size :].reshape(2, size, size), shrinkage)


def scored(rows: DataFrame, model: Discriminant) -> DataFrame:
    """Measured rows with ``score`` in place of their statistics."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(_rows(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score, pa.float64())], [*batch.schema.names[:-1], "score"])

    return rows.mapInArrow(run, rows.drop("statistics").schema.add("score", "double"))


def accepted(docs: DataFrame, model: Discriminant, least: float = ACCEPTED, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores ``least`` or more, as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = shared.value.score(statistics(*text_buffer(batch.column(at))))
                yield batch.filter(pa.array(score >= least))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id", folds: int = 5):
    """True for the rows that no label is learnt from: crc32 of the id as text divisible by ``folds``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def learnt(docs: DataFrame, labels: DataFrame, folds: int = 5) -> tuple[DataFrame, Discriminant]:
    """Measured rows (doc_id, statistics), and the model of the labelled rows that are not held out."""
    rows = stored(measured(docs, ["doc_id"]), "statistics")
    known = labels.where(~held_out("doc_id", folds)).select("doc_id", F.col("quality").alias("label"))
    return rows, fit(rows.join(known, "doc_id").select("label", "statistics"))


def score_documents(docs: DataFrame, labels: DataFrame, least: float = ACCEPTED) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    rows, model = learnt(docs, labels)
    return scored(rows, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
