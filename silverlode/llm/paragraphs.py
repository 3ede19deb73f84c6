"""Repeated passages by MinHash banding of paragraphs.

A paragraph is a line. Paragraphs with the same words (case and punctuation aside) are one; those of
five words or more are also compared by their five-word shingles: bands tuned for a recall of
0.995 at a Jaccard similarity of 0.8 bring candidates together, their exact Jaccard similarity is
computed, and links make components. Of all paragraphs of a component the first by (doc_id, text, place)
stays and the others are marked; runs of marked paragraphs, with blank lines between them, that
together hold 50 words or more are removed. So shorter lines that happen to be common are left alone.

Passages inside lines, or over parts of lines, are found in what is left (``remove_runs``): every window of 50 words whose
words come before, anywhere and laid out in whatever lines, is removed word for word, and its first occurrence stays.
Winnowing finds them all: each window is known by the least hash of its 13-word grams, so equal windows share it, and only
windows whose gram is repeated are hashed whole and compared. ``remove_repeats`` does both in turn. Inside lines a passage has to be equal
over 50 words; changed words are bridged only where whole lines are alike.

Cases: null text counts as empty and stays null; a text without a marked run stays as it is, byte for
byte; equal rows (doc_id and text) count as one document; a null doc_id sorts first; an empty input gives
an empty result; other columns are carried along, whatever their names: where one has the name of a count, the count gets underscores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.buffers import groups, mix, prefix, ragged, slices, text_buffer, words
from silverlode.llm.frames import free_name, release, stored
from silverlode.llm.links import components
from silverlode.llm.pairs import SIMILARITY, WORDS, kmers, near_links

SHINGLED_WORDS = WORDS
PASSAGE_WORDS = 50
GRAM_WORDS = 13
COUNTS = ("n_lines_removed", "n_bytes_removed")
ROWS, RECALL = 2, 0.995
_SEEDS = np.random.default_rng(79).integers(1, 1 << 63, (2, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands(least: float, rows: int = ROWS, recall: float = RECALL) -> int:
    """The fewest bands of ``rows`` minima that bring a pair just similar enough together with that recall."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - least**rows)))


def jaccard(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Common shingles over all of both; a shingle counts as often as it comes."""
    total = len(a) + len(b)
    if not total or min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (total - common)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and end byte of every line; the line feed belongs to the line before it."""
    cut = np.zeros(len(data) + 1, bool)
    cut[1:] = data == 0x0A
    cut[offsets] = True
    marks = np.flatnonzero(cut)
    start, end = marks[:-1], marks[1:]
    return np.searchsorted(offsets, start, "right") - 1, start, end


def _identified(data: np.ndarray, offsets: np.ndarray):
    """Row, place in the row, first byte, end byte, number of words and id of every line with a word."""
    row, start, end = lines(data, offsets)
    bounds = np.append(start, len(data))
    hashed, _, _, line = words(data, bounds)
    number = np.bincount(line, minlength=len(start))
    after = np.cumsum(number)
    ids = slices(prefix(hashed), after - number, after)
    place = np.arange(len(row)) - np.searchsorted(row, row)
    some = number > 0
    return row[some], place[some], start[some], end[some], number[some], ids[some].view(np.int64)


def _line_table(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            keys = np.array(batch.column(0))
            for i, j in groups(offsets):
                row, place, _, _, number, ids = _identified(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[i:j][row], pa.int64()), pa.array(place.astype(np.int32)), pa.array(number.astype(np.int32)), pa.array(ids)],
                    ["doc_key", "place", "n_words", "key"],
                )

    return docs.select("doc_key", "text").mapInArrow(run, "doc_key bigint, place int, n_words int, key bigint")


def _members(docs: DataFrame, least: float, fewest: int) -> DataFrame:
    """(bucket, key) of the bands of every line of ``fewest`` words or more."""
    number = bands(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            for i, j in groups(offsets):
                own = data[offsets[i] : offsets[j]]
                _, _, start, end, n_words, ids = _identified(own, offsets[i : j + 1] - offsets[i])
                long = n_words >= fewest
                start, end, ids = start[long], end[long], ids[long]
                if not len(ids):
                    continue
                size = end - start
                flat = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                grams, begins = kmers(own[flat], np.concatenate(([0], np.cumsum(size))))
                buckets = []
                for band in range(number):
                    value = np.zeros(len(ids), np.uint64)
                    for k in range(band * ROWS, band * ROWS + ROWS):
                        value = mix(value + np.minimum.reduceat((grams ^ _SEEDS[0, k]) * _SEEDS[1, k], begins[:-1]))
                    buckets.append(value + np.uint64(band))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(buckets).view(np.int64)), pa.array(np.tile(ids, number))], ["bucket", "key"]
                )

    return docs.select("text").mapInArrow(run, "bucket bigint, key bigint")


def _extracted(chosen: DataFrame) -> DataFrame:
    """(key, text) of the chosen lines of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            keys, texts = [], []
            for k, wanted in enumerate(batch.column("wanted").to_pylist()):
                own = data[offsets[k] : offsets[k + 1]]
                _, start, end = lines(own, np.array([0, len(own)]))
                for w in wanted:
                    keys.append(w["key"])
                    texts.append(own[start[w["place"]] : end[w["place"]]].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.string())], ["key", "text"])

    return chosen.mapInArrow(run, "key bigint, text string")


def cut(text: bytes, marked: list[int], fewest: int) -> tuple[bytes, int]:
    """The text without its runs of marked lines of ``fewest`` words together, and how many lines went."""
    data = np.frombuffer(text, np.uint8)
    _, start, end = lines(data, np.array([0, len(data)]))
    row = words(data, np.append(start, len(data)))[3]
    number = np.bincount(row, minlength=len(start))
    flags = np.zeros(len(start), bool)
    flags[marked] = True
    keep = np.ones(len(start), bool)
    run: list[int] = []
    for k in [*np.flatnonzero(flags | (number > 0)).tolist(), -1]:
        if k >= 0 and flags[k]:
            run.append(k)
            continue
        if sum(int(number[x]) for x in run) >= fewest:
            keep[run] = False
        run = []
    left = b"".join(text[s:e] for s, e, k in zip(start.tolist(), end.tolist(), keep) if k)
    return left, int((~keep).sum())


def count_names(columns: list[str]) -> tuple[str, str]:
    """What the two counts are called beside ``columns``: underscores are added where a name is taken."""
    return tuple(free_name(c, columns) for c in COUNTS)


def remove_passages(
    docs: DataFrame, least: float = SIMILARITY, fewest: int = PASSAGE_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with ``text`` cut, and (n_lines_removed, n_bytes_removed) beside it."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        row.alias("row"), F.col(text).alias("raw"), value.alias("text"), F.xxhash64(F.col(doc_id), value).alias("doc_key"), F.col(doc_id).alias("id")
    )
    table = stored(_line_table(rows), "lines")
    first_seen = table.groupBy("key").agg(F.min(F.struct("doc_key", "place")).alias("at"))

    def texts(keys: DataFrame) -> DataFrame:
        chosen = first_seen.join(keys, "key").groupBy("at.doc_key").agg(F.collect_list(F.struct("key", F.col("at.place").alias("place"))).alias("wanted"))
        return _extracted(rows.select("doc_key", "text").join(chosen, "doc_key").select("text", "wanted"))

    links = near_links(_members(rows, least, SHINGLED_WORDS), texts, jaccard, least)
    found = components(links)
    release(links)
    ids = stored(rows.select("doc_key", "id", F.xxhash64("text").alias("tie")).distinct(), "ids")
    placed = table.join(found.select(F.col("node").alias("key"), "component"), "key", "left")
    placed = placed.select("doc_key", "place", F.coalesce("component", "key").alias("class"))
    several = placed.groupBy("class").agg(F.min(F.struct("doc_key", "place")).alias("x"), F.max(F.struct("doc_key", "place")).alias("y"))
    repeated = placed.join(several.where("x <> y").select("class"), "class").join(ids, "doc_key")
    repeated = stored(repeated.select("class", "doc_key", "place", F.struct("id", "tie", "place").alias("at")), "repeated", (table, found, ids))
    kept = repeated.groupBy("class").agg(F.min("at").alias("first"))
    marked = repeated.join(kept, "class").where(~F.col("at").eqNullSafe(F.col("first")))
    marked = stored(marked.groupBy("doc_key").agg(F.collect_set("place").alias("marked")), "marked", (repeated,))

    @F.pandas_udf("text string, n_lines_removed int, n_bytes_removed bigint")
    def applied(values, places):
        import pandas as pd

        out = []
        for v, p in zip(values, places):
            if v is None or p is None or not len(p):
                out.append((v, 0, 0))
                continue
            whole = v.encode()
            left, gone = cut(whole, sorted(p), fewest)
            out.append((left.decode("utf-8", "replace") if gone else v, gone, len(whole) - len(left)))
        return pd.DataFrame(out, columns=["text", "n_lines_removed", "n_bytes_removed"])

    joined = rows.select("row", "raw", "doc_key").join(marked, "doc_key", "left")
    done = joined.select("row", applied("raw", "marked").alias("cut"))
    columns = [F.col(f"cut.text").alias(text) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    return done.select(*columns, *[F.col(f"cut.{c}").alias(n) for c, n in zip(COUNTS, count_names(docs.columns))])


def windows(hashed: np.ndarray, row: np.ndarray, n_rows: int, fewest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of every window of ``fewest`` words of a row, the place of its least gram, and that gram's hash."""
    size = min(GRAM_WORDS, fewest)
    counts = np.bincount(row, minlength=n_rows)
    start = ragged(np.cumsum(counts) - counts, np.maximum(counts - fewest + 1, 0))
    if not len(start):
        return start, start, np.zeros(0, np.int64)
    first = np.arange(len(hashed) - size + 1)
    grams = slices(prefix(hashed), first, first + size)
    at = start + np.lib.stride_tricks.sliding_window_view(grams, fewest - size + 1).argmin(1)[start]
    return start, at, grams[at].view(np.int64)


def _anchors(docs: DataFrame, fewest: int) -> DataFrame:
    """(doc_key, gram, n): the least grams of each row's windows, and at how many places they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            keys = np.array(batch.column(0))
            for i, j in groups(offsets):
                hashed, _, _, row = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                _, at, grams = windows(hashed, row, j - i, fewest)
                at, one = np.unique(at, return_index=True)
                pairs, number = np.unique(np.stack((row[at], grams[one])), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[i:j][pairs[0]], pa.int64()), pa.array(pairs[1], pa.int64()), pa.array(number, pa.int64())], ["doc_key", "gram", "n"]
                )

    return docs.select("doc_key", "text").mapInArrow(run, "doc_key bigint, gram bigint, n bigint")


def _hashed_windows(docs: DataFrame, fewest: int) -> DataFrame:
    """(key, doc_key, place) of the windows of (doc_key, text, grams) that hold one of the grams as their least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            keys = np.array(batch.column("doc_key"))
            known = np.unique(np.array(batch.column("grams").flatten(), np.int64))
            for i, j in groups(offsets):
                hashed, _, _, row = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                start, _, grams = windows(hashed, row, j - i, fewest)
                start = start[np.isin(grams, known)]
                ids = slices(prefix(hashed), start, start + fewest) if len(start) else np.zeros(0, np.uint64)
                place = start - np.searchsorted(row, row[start])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.view(np.int64)), pa.array(keys[i:j][row[start]], pa.int64()), pa.array(place.astype(np.int32))],
                    ["key", "doc_key", "place"],
                )

    return docs.select("doc_key", "text", "grams").mapInArrow(run, "key bigint, doc_key bigint, place int")


def cut_runs(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The text without the words of ``spans`` (first, end), with what follows them in their line, and how many lines lost all words."""
    data = np.frombuffer(text, np.uint8)
    _, start, end, _ = words(data, np.array([0, len(data)]))
    gone = np.zeros(len(start) + 2, np.int64)
    for a, b in spans:
        gone[a + 1 : b + 1] = 1
    a, b = np.flatnonzero(np.diff(gone) == 1), np.flatnonzero(np.diff(gone) == -1)
    line = np.searchsorted(np.flatnonzero(data == 0x0A), start)
    left, done = [], 0
    for x, y in zip(a.tolist(), b.tolist()):
        s, e = int(start[x]), int(start[y]) if y < len(start) else len(text)
        feed = text.rfind(b"\n", int(end[y - 1]), e) if y < len(start) else text.find(b"\n", int(end[y - 1]))
        if feed >= 0:  # a line of which nothing is left goes with its line feed
            e = feed + 1 if x == 0 or line[x - 1] != line[x] else feed
        left.append(text[done:s])
        done = e
    left.append(text[done:])
    return b"".join(left), len(np.setdiff1d(line[gone[1:-1] > 0], line[gone[1:-1] == 0]))


def remove_runs(docs: DataFrame, fewest: int = PASSAGE_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` without the windows of ``fewest`` words that come before, and (n_lines_removed, n_bytes_removed) beside it."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        row.alias("row"), F.col(text).alias("raw"), F.xxhash64(F.col(doc_id), value).alias("doc_key"), F.col(doc_id).alias("id")
    )
    rows = stored(rows, "cut").withColumn("text", F.coalesce("raw", F.lit("")))
    anchors = stored(_anchors(rows, fewest), "anchors")
    several = anchors.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")
    chosen = anchors.join(several, "gram").groupBy("doc_key").agg(F.collect_set("gram").alias("grams"))
    table = stored(_hashed_windows(rows.select("doc_key", "text").join(chosen, "doc_key"), fewest), "windows", (anchors,))
    several = table.groupBy("key").agg(F.min(F.struct("doc_key", "place")).alias("x"), F.max(F.struct("doc_key", "place")).alias("y"))
    ids = rows.select("doc_key", "id", F.xxhash64("text").alias("tie")).distinct()
    repeated = table.join(several.where("x <> y").select("key"), "key").join(ids, "doc_key")
    repeated = stored(repeated.select("key", "doc_key", "place", F.struct("id", "tie", "place", "doc_key").alias("at")), "repeated", (table,))
    kept = repeated.groupBy("key").agg(F.min("at").alias("first"))
    later = repeated.join(kept, "key").where(~F.col("at").eqNullSafe(F.col("first")))
    # Where a window overlaps its own first occurrence, the words of that stay.
    own = F.when(F.col("first.doc_key") == F.col("doc_key"), F.col("first.place") + fewest).otherwise(0)
    spans = later.select("doc_key", F.struct(F.greatest("place", own).alias("a"), (F.col("place") + fewest).alias("b")).alias("span"))
    marked = stored(spans.groupBy("doc_key").agg(F.collect_set("span").alias("marked")), "marked", (repeated,))

    @F.pandas_udf("text string, n_lines_removed int, n_bytes_removed bigint")
    def applied(values, spans):
        import pandas as pd

        out = []
        for v, p in zip(values, spans):
            if v is None or p is None or not len(p):
                out.append((v, 0, 0))
                continue
            whole = v.encode()
            left, gone = cut_runs(whole, [(x["a"], x["b"]) for x in p])
            out.append((left.decode("utf-8", "replace"), gone, len(whole) - len(left)))
        return pd.DataFrame(out, columns=["text", "n_lines_removed", "n_bytes_removed"])

    done = rows.select("row", "raw", "doc_key").join(marked, "doc_key", "left").select("row", applied("raw", "marked").alias("cut"))
    columns = [F.col("cut.text").alias(text) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    return done.select(*columns, *[F.col(f"cut.{c}").alias(n) for c, n in zip(COUNTS, count_names(docs.columns))])


def remove_repeats(
    docs: DataFrame, least: float = SIMILARITY, fewest: int = PASSAGE_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``remove_passages`` and then ``remove_runs``; the counts are those of both together."""
    whole = remove_passages(docs, least, fewest, doc_id, text)
    columns, before = [F.col(f"`{c}`") for c in docs.columns], free_name("_before", docs.columns)
    lines_, bytes_ = count_names(docs.columns)
    earlier = F.struct(F.col(f"`{lines_}`").alias("lines"), F.col(f"`{bytes_}`").alias("bytes")).alias(before)
    after = remove_runs(whole.select(*columns, earlier), fewest, doc_id, text)
    sums = [(F.col(f"`{n}`") + F.col(f"`{before}`.{c}")).alias(n) for n, c in ((lines_, "lines"), (bytes_, "bytes"))]
    return after.select(*columns, *sums)


def without_passages(docs: DataFrame, text: str = "text", size: str = "n_chars", **options) -> DataFrame:
    """The rows of ``docs`` with their passages cut and the column ``size`` (if there) counted anew where they were."""
    cut_rows = remove_repeats(docs, text=text, **options)
    if size in docs.columns:
        counted = F.when(F.col(f"`{count_names(docs.columns)[1]}`") > 0, F.length(text)).otherwise(F.col(size))
        cut_rows = cut_rows.withColumn(size, counted.cast(docs.schema[size].dataType))
    return cut_rows.select(*[F.col(f"`{c}`") for c in docs.columns])
