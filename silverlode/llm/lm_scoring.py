"""Cross-entropy difference of documents under a target and a background n-gram model.

Both models are trigram models over one vocabulary of 160 symbols: every byte of a text is one token,
letters by case, digits and control characters as one symbol each, ASCII marks by themselves, and the
bytes of other characters by their UTF-8 role. Counts cover all bytes of all documents: the
background every document, the target those named by the caller. Orders three, two, one and zero
are interpolated with the same weights in both, so the models differ in their counts alone. A token's loss
is its negative log probability after the two tokens before it; a document's score is the mean loss under
the target less that under the background: lower means more like the target.

Tasks count into dense tables and send the cells in use, which Spark sums; the finished model has at most 160^3
cells, so it is broadcast whatever the size of the corpus.

Cases: null text counts as empty and has no tokens and losses of 0; a target of no documents has uniform
losses; repeated ids in the target count once, repeated documents each time; an empty input gives an empty
result; a null doc_id is scored and never in the target; other columns are not carried.

``word_cross_entropy_difference``, which the query uses, does the same with words in place of bytes, over the shared vocabulary of all
words. Batches of about ``TOKENS`` words send each of their different n-grams once, as a 64-bit fingerprint with its counts; Spark deals
those by ranges of the fingerprint, so that a common n-gram is one entry for each batch and no range is larger than another, sums each range, and
gives every batch back what the others counted; the batch then works out its documents' losses. Words and pairs go first, trigrams after
them, so that only one of the two is on disk at a time. A text without words has no tokens there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.buffers import groups, mix, text_buffer, words
from silverlode.llm.frames import stored

SYMBOLS = 160
SLICES = 8  # ranges of fingerprints, at least
TOKENS = 1 << 19
RANGE_TOKENS = 3 << 19
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
WEIGHTS = (0.02, 0.08, 0.25, 0.65)  # of orders 0 to 3
_marks = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
_OF_BYTE = np.zeros(256, np.int64)
_OF_BYTE[0x20], _OF_BYTE[0x0A] = 1, 2
for _c in range(26):
    _OF_BYTE[ord("a") + _c], _OF_BYTE[ord("A") + _c] = 3 + _c, 29 + _c
_OF_BYTE[ord("0") : ord("9") + 1] = 55
for _k, _c in enumerate(_marks):
    _OF_BYTE[_c] = 56 + _k
_OF_BYTE[0x80:0xC0] = 88 + np.arange(64)
_OF_BYTE[0xC0:] = 152 + (np.arange(0xC0, 0x100) >> 3 & 7)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The cell of each byte and the two before it; line feeds stand before a text."""
    s = _OF_BYTE[data]
    before = np.full((2, len(s)), _OF_BYTE[0x0A])
    before[0, 1:], before[1, 2:] = s[:-1], s[:-2]
    first = offsets[:-1][np.diff(offsets) > 0]
    second = offsets[:-1][np.diff(offsets) > 1] + 1
    before[0, first] = before[1, first] = before[1, second] = _OF_BYTE[0x0A]
    return (before[1] * SYMBOLS + before[0]) * SYMBOLS + s


def counted(docs: DataFrame) -> DataFrame:
    """(cell, target, background) summed over (text, wanted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, SYMBOLS**3), np.int64)
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            wanted = np.array(batch.column(1).fill_null(False))
            for i, j in groups(offsets):
                own = offsets[i : j + 1] - offsets[i]
                cells = trigrams(data[offsets[i] : offsets[j]], own)
                flags = np.repeat(wanted[i:j], np.diff(own))
                for k, part in enumerate((cells[flags], cells)):
                    at, times = np.unique(part, return_counts=True)
                    sums[k, at] += times
        used = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(sums[0, used]), pa.array(sums[1, used])], ["cell", "target", "background"]
        )

    parts = docs.select("text", "wanted").mapInArrow(run, "cell int, target bigint, background bigint")
    return parts.groupBy("cell").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def losses(counts: np.ndarray) -> np.ndarray:
    """Negative log probability of every cell, from its counts."""
    c3 = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    w0, w1, w2, w3 = WEIGHTS

    def share(c: np.ndarray) -> np.ndarray:
        total = c.sum(-1, keepdims=True)
        return np.divide(c, total, out=np.full(c.shape, 1 / SYMBOLS), where=total > 0)

    p = w0 / SYMBOLS + w1 * share(c1)[None, None, :] + w2 * share(c2)[None, :, :] + w3 * share(c3)
    return -np.log(p).astype(np.float32).reshape(-1)


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, difference) of every row; ``target_ids`` names the target by doc_id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    wanted = target_ids.select(F.col("doc_id")).distinct().withColumn("wanted", F.lit(True))
    # A merge join at every size: what is moved then follows the input.
    table = counted(rows.join(wanted.hint("merge"), "doc_id", "left")).toPandas()  # at most 160^3 rows
    counts = np.zeros((2, SYMBOLS**3), np.int64)
    for k, name in enumerate(("target", "background")):
        counts[k, table["cell"].to_numpy(np.int64)] = table[name].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(np.stack([losses(c) for c in counts]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            found = np.zeros((2, batch.num_rows))
            for i, j in groups(offsets):
                own = offsets[i : j + 1] - offsets[i]
                cells = trigrams(data[offsets[i] : offsets[j]], own)
                for k in (0, 1):
                    sums = np.concatenate(([0.0], np.cumsum(shared.value[k][cells], dtype=float)))
                    found[k, i:j] = sums[own[1:]] - sums[own[:-1]]
            number = np.diff(offsets)
            target, background = found / np.maximum(number, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number, pa.int64()), *(pa.array(v, pa.float64()) for v in (target, background, target - background))],
                ["doc_id", "n_tokens", "target_loss", "background_loss", "difference"],
            )

    schema = rows.select("doc_id").schema.add("n_tokens", "long")
    for name in ("target_loss", "background_loss", "difference"):
        schema = schema.add(name, "double")
    return rows.mapInArrow(run, schema)


def word_trigrams(rows: DataFrame, number: int = 0, slices: int = 1) -> DataFrame:
    """(doc_key, wanted, a, b, z, n): the different word trigrams of each row, or those of one slice by their middle word; zeros stand before a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            keys, wanted = np.array(batch.column(0)), np.array(batch.column(1).fill_null(False))
            for i, j in groups(offsets):
                hashed, _, _, row = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                z = hashed.view(np.int64)
                b, a = np.zeros_like(z), np.zeros_like(z)
                b[1:], a[2:] = np.where(row[1:] == row[:-1], z[:-1], 0), np.where(row[2:] == row[:-2], z[:-2], 0)
                own = np.flatnonzero(mix(b.view(np.uint64)) % np.uint64(slices) == number)
                row, a, b, z = row[own], a[own], b[own], z[own]
                order = np.lexsort((z, b, a, row))
                row, a, b, z = row[order], a[order], b[order], z[order]
                new = np.ones(len(z), bool)
                new[1:] = (row[1:] != row[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (z[1:] != z[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(z))).astype(np.int64)
                columns = (keys[i:j][row[first]], wanted[i:j][row[first]], a[first], b[first], z[first], times)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], ["doc_key", "wanted", "a", "b", "z", "n"])

    kind = "doc_key bigint, wanted boolean, a bigint, b bigint, z bigint, n bigint"
    return rows.select("doc_key", "wanted", "text").mapInArrow(run, kind)


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), "zstd", asbytes=True)  # small numbers: what the JVM holds and moves is a tenth


def _unpacked(cell: pa.Scalar, number: int, kind: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(cell.as_buffer(), number * np.dtype(kind).itemsize, "zstd"), kind)


def word_batches(rows: DataFrame) -> DataFrame:
    """(batch, doc_id, wanted, lengths, vocabulary, tokens, n_tokens, n_target) from (doc_id, wanted, text): runs of documents as places in their own vocabulary."""

    def packed(held: list[tuple]) -> pa.RecordBatch:
        ids, wanted, lengths, hashed = (list(c) for c in zip(*held))
        wanted, lengths = np.concatenate(wanted), np.concatenate(lengths)
        vocabulary, tokens = np.unique(np.concatenate(hashed), return_inverse=True)
        ids = pa.concat_arrays(ids)
        cells = [[wanted.tobytes()], [lengths.astype("<u4").tobytes()], [vocabulary.astype("<u8").tobytes()], [_packed(tokens.astype("<u4"))]]
        numbers = [[int(lengths.sum())], [int(lengths[wanted].sum())]]
        columns = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *(pa.array(c, pa.binary()) for c in cells)]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array(n, pa.int64()) for n in numbers)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            wanted = np.array(batch.column(1).fill_null(False), bool)
            for i, j in groups(offsets):
                hashed, _, _, row = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                held.append((batch.column(0).slice(i, j - i), wanted[i:j], np.bincount(row, minlength=j - i), hashed))
                size += len(hashed) + j - i
                if size >= TOKENS:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    names = ["doc_id", "wanted", "lengths", "vocabulary", "tokens", "n_tokens", "n_target"]
    kind = f"doc_id array<{rows.schema['doc_id'].dataType.simpleString()}>, wanted binary, lengths binary, vocabulary binary, tokens binary"
    found = rows.select("doc_id", "wanted", "text").mapInArrow(run, f"{kind}, n_tokens bigint, n_target bigint")
    return found.withColumn("batch", F.monotonically_increasing_id())


class NGrams:
    """The words of a batch, a mark before each text that has any, and the fingerprints and counts of their n-grams."""

    def __init__(self, wanted: pa.Scalar, lengths: pa.Scalar, vocabulary: pa.Scalar, tokens: pa.Scalar) -> None:
        self.wanted, self.lengths = np.frombuffer(wanted.as_buffer(), bool), np.frombuffer(lengths.as_buffer(), "<u4").astype(np.int64)
        self.vocabulary = np.concatenate((np.zeros(1, np.uint64), np.frombuffer(vocabulary.as_buffer(), "<u8")))
        size = self.lengths + (self.lengths > 0)
        stop = np.cumsum(size)[self.lengths > 0]
        self.first = stop - size[self.lengths > 0]
        self.token = np.ones(int(size.sum()), bool)
        self.token[self.first] = False
        self.history = np.ones(len(self.token), bool)
        self.history[stop - 1] = False
        self.target = np.repeat(self.wanted, size)
        self.words = np.zeros(len(self.token), np.int64)
        self.words[self.token] = _unpacked(tokens, int(self.lengths.sum()), "<u4").astype(np.int64) + 1
        self.hashed = self.vocabulary[self.words]
        self.before = np.zeros_like(self.hashed)
        self.before[1:] = self.hashed[:-1]
        self.before[self.first] = 0

    def short(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words (odd fingerprints) and pairs (even): fingerprints, counts, and the place of each word and of each pair of the batch.

        Counts are how often one ends a text's prefix (in the target, in all) and how often a word follows it (the same).
        """
        different, pair = np.unique(mix(self.before * _FACTORS[0] + self.hashed) & ~np.uint64(1), return_inverse=True)
        keys = np.concatenate((mix(self.vocabulary + _FACTORS[1]) | np.uint64(1), different))
        order = np.argsort(keys)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        word, pair = place[self.words], place[pair + len(self.vocabulary)]
        counts = np.zeros((len(keys), 4), np.int64)
        for k, which in enumerate((self.token & self.target, self.token, self.history & self.target, self.history)):
            counts[:, k] = np.bincount(word[which], minlength=len(keys)) + np.bincount(pair[which], minlength=len(keys))
        return keys[order], counts, word, pair

    def long(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Trigrams: fingerprints, counts (in the target, in all), and the place of each of the batch."""
        real = self.token[1:]
        whole = mix(self.before[:-1][real] * _FACTORS[0] + self.hashed[:-1][real] * _FACTORS[1] + self.hashed[1:][real])
        keys, place = np.unique(whole, return_inverse=True)
        counts = np.zeros((len(keys), 2), np.int64)
        counts[:, 0] = np.bincount(place[self.target[1:][real]], minlength=len(keys))
        counts[:, 1] = np.bincount(place, minlength=len(keys))
        return keys, counts, place


def counted_elsewhere(batches: DataFrame, order: str, ranges: int) -> DataFrame:
    """(batch, part, n_keys, counts, n_words): what all other batches counted of each n-gram of a batch, by ranges of fingerprints, in their order.

    ``n_words`` adds up to the number of different words, the mark before texts among them.
    """
    width = 4 if order == "short" else 2
    columns = ["wanted", "lengths", "vocabulary", "tokens"]

    def send(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)
        for batch in batches_:
            for k in range(batch.num_rows):
                keys, counts = getattr(NGrams(*(batch.column(c)[k] for c in columns)), order)()[:2]
                at = np.concatenate(([0], np.searchsorted(keys, bounds), [len(keys)]))
                used = np.flatnonzero(np.diff(at))
                number = pa.array(np.full(len(used), batch.column("batch")[k].as_py()), pa.int64())
                cells = [[keys[at[r] : at[r + 1]].astype("<u8").tobytes() for r in used], [_packed(counts[at[r] : at[r + 1]].astype("<u4")) for r in used]]
                cells = [number, pa.array(used.astype(np.int32)), *(pa.array(c, pa.binary()) for c in cells)]
                yield pa.RecordBatch.from_arrays(cells, ["batch", "part", "keys", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        keys, offsets = text_buffer(rows["keys"])
        at = offsets // 8
        own = [_unpacked(c, n * width, "<u4") for c, n in zip(rows["counts"], np.diff(at).tolist())]
        keys, own = keys.view("<u8"), np.concatenate(own).reshape(-1, width)
        by_key = np.argsort(keys)
        ordered = keys[by_key]
        new = np.append(True, ordered[1:] != ordered[:-1])
        found = np.zeros(rows.num_rows, np.int64)
        found[0] = np.count_nonzero(new & (ordered & np.uint64(1) == 1))
        del keys, ordered
        starts, which = np.flatnonzero(new), np.cumsum(new) - 1
        others = np.empty(own.shape, "<i8")
        for k in range(width):  # column by column, so that working arrays stay small
            column = own[by_key, k].astype(np.int64)
            others[by_key, k] = np.add.reduceat(column, starts)[which] - column
        cells = pa.array([_packed(others[i:j]) for i, j in zip(at[:-1], at[1:])], pa.binary())
        n_keys = pa.array(np.diff(at).astype(np.int32))
        return pa.table([rows["batch"], rows["part"], n_keys, cells, pa.array(found)], ["batch", "part", "n_keys", "counts", "n_words"])

    sent = batches.select("batch", *columns).mapInArrow(send, "batch bigint, part int, keys binary, counts binary")
    return sent.groupBy("part").applyInArrow(add, "batch bigint, part int, n_keys int, counts binary, n_words bigint")


def word_cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, difference) of every row by models of one to three words."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    wanted = target_ids.select("doc_id").distinct().withColumn("wanted", F.lit(True))
    # A merge join at every size: what is moved then follows the input.
    batches = stored(word_batches(rows.join(wanted.hint("merge"), "doc_id", "left")), "batches")
    sums = batches.agg(F.sum("n_target"), F.sum("n_tokens")).first()
    totals = [n or 0 for n in sums]
    ranges = max(SLICES, -(-totals[1] // RANGE_TOKENS))
    short, long = (stored(counted_elsewhere(batches, order, ranges), order) for order in ("short", "long"))
    size = max(1, (short.agg(F.sum("n_words")).first()[0] or 0) - 1)
    w0, w1, w2, w3 = WEIGHTS

    def share(c: np.ndarray, h: np.ndarray) -> np.ndarray:
        return np.divide(c, h, out=np.full(len(c), 1 / size), where=h > 0)

    def run(own: pa.Table, others: pa.Table) -> pa.Table:
        grams = NGrams(*(own[c][0] for c in ("wanted", "lengths", "vocabulary", "tokens")))
        others = others.sort_by("part")

        def whole(order: str, counts: np.ndarray) -> np.ndarray:
            rows = others.filter(pc.equal(others["kind"], order))
            cells = [_unpacked(c, n * counts.shape[1], "<i8") for c, n in zip(rows["counts"], rows["n_keys"].to_pylist())]
            return counts + np.concatenate([np.zeros(0, "<i8"), *cells]).reshape(counts.shape)

        _, counts, word, pair = grams.short()
        counts = whole("short", counts)
        at = np.flatnonzero(grams.token)  # a token's history is the entry before it
        alone, two, one_before, two_before = counts[word[at]], counts[pair[at]], counts[word[at - 1]], counts[pair[at - 1]]
        _, counts, place = grams.long()
        three = whole("long", counts)[place]
        found = np.zeros((2, len(grams.lengths)))
        full = grams.lengths > 0
        stop = np.cumsum(grams.lengths)[full]
        for k in (0, 1):
            p = w0 / size + w1 * (alone[:, k] / totals[k] if totals[k] else 1 / size) + w2 * share(two[:, k], one_before[:, 2 + k])
            loss = -np.log(p + w3 * share(three[:, k], two_before[:, 2 + k]))
            if len(loss):
                found[k, full] = np.add.reduceat(loss, stop - grams.lengths[full]) / grams.lengths[full]
        figures = [pa.array(v) for v in (grams.lengths, *found, found[0] - found[1])]
        return pa.table([own["doc_id"].combine_chunks().flatten(), *figures], names)

    names = ["doc_id", "n_tokens", "target_loss", "background_loss", "difference"]
    schema = rows.select("doc_id").schema.add("n_tokens", "long")
    for name in names[2:]:
        schema = schema.add(name, "double")
    known = short.withColumn("kind", F.lit("short")).unionByName(long.withColumn("kind", F.lit("long"))).drop("n_words")
    return batches.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(run, schema)
