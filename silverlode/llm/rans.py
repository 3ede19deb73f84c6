"""Token files coded by a static range asymmetric numeral system (rANS).

Files. A folder holds three Parquet tables. ``table``: (id, frequency), frequencies summing to
2^20, one shared table counted over every document. ``blocks``: independent blocks of whole
documents in ascending doc_id order, about 32 Ki ids each (a longer document has a block of
its own): part, block, start (ids before it in its part), n_ids, doc_ids and doc_lengths,
lanes, states (lane states before the first step, little-endian uint64), marks and mark_states
(checkpoints: word position and lane states after every 256 steps, where decoding can begin),
words (renormalisation words, little-endian uint32, in decoding order) and crc32 of the block's
ids as little-endian uint32. ``parts``: (part, base), ids before each part. Step k of a block
holds ids k * lanes ... k * lanes + lanes - 1, one a lane, padded with the end id.

Spark writes and reads the tables, so they live on any storage, and a lost task is simply run
again. Ids must be below 65536.

Cases: null text counts as empty and holds the end id alone; repeated doc_ids stay separate
rows ordered by their ids; a null doc_id sorts first; an empty input gives empty tables. Columns
other than the two named are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.llm.buffers import text_buffer
from silverlode.llm.tokens import encoder

LANES = 64
BLOCK_IDS = 1 << 15
MARK_STEPS = 256
SCALE = 20
LOW = np.uint64(1 << 31)
TOGETHER = 1 << 21  # ids coded at once
ROWS_PER_PART = 8192
_WORD = np.uint64(32)
_BITS = np.uint64(SCALE)
_TOKENS = "doc_id bigint, ids binary, histogram binary"
_BLOCKS = (
    "part int, block int, start bigint, n_ids bigint, doc_ids array<bigint>, doc_lengths array<bigint>, lanes int, "
    "states binary, marks array<bigint>, mark_states binary, words binary, crc32 bigint"
)


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, histogram): ids as zstd of little-endian uint16, and a last row a task that counts its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, pack = encoder(tokenizer), zstandard.ZstdCompressor(level=1)
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            out = []
            for _, ids, places in tool.encode(data, offsets):
                counts += np.bincount(ids, minlength=1 << 16)
                end = np.array([end_id], "<u2")
                out += [pack.compress(np.concatenate((ids[a:b], end)).tobytes()) for a, b in zip(places[:-1], places[1:])]
            counts[end_id] += len(out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary()), pa.nulls(len(out), pa.binary())], ["doc_id", "ids", "histogram"]
            )
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(1, pa.int64()),
                pa.nulls(1, pa.binary()),
                pa.array([np.stack((seen, counts[seen])).astype("<i8").tobytes()], pa.binary()),
            ],
            ["doc_id", "ids", "histogram"],
        )

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _TOKENS)


def counted(tokens: DataFrame) -> DataFrame:
    """(id, count) over all documents, from the tasks' histograms; as many rows as ids in use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                ids, counts = np.frombuffer(value, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts)], ["id", "count"])

    rows = tokens.where("histogram IS NOT NULL").select("histogram").mapInArrow(run, "id bigint, count bigint")
    return rows.groupBy("id").agg(F.sum("count").alias("count"))


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Whole frequencies summing to 2^20, at least 1 for every id in use."""
    total, whole = int(counts.sum()), 1 << SCALE
    if not total:
        return counts.astype(np.int64)
    scaled = np.where(counts > 0, np.maximum(1, counts * whole // total), 0).astype(np.int64)
    left = whole - int(scaled.sum())
    order = np.argsort(-scaled, kind="stable")
    if left > 0:
        scaled[order[0]] += left
    for k in order:
        if left >= 0:
            break
        take = min(-left, int(scaled[k]) - 1)
        scaled[k] -= take
        left += take
    return scaled


class Coder:
    """Codes many blocks at a time: lanes x blocks wide, one step after the other."""

    def __init__(self, scaled: np.ndarray) -> None:
        self.freq = scaled.astype(np.uint64)
        self.cum = np.concatenate(([0], np.cumsum(scaled)))[:-1].astype(np.uint64)
        self.limit = ((LOW >> _BITS) << _WORD) * self.freq
        self.symbol = np.repeat(np.arange(len(scaled), dtype=np.uint16), scaled)

    def encode(self, runs: list[np.ndarray], pad: int) -> list[dict]:
        """States, checkpoints and words of each run of ids."""
        order = sorted(range(len(runs)), key=lambda k: -len(runs[k]))
        steps = np.array([-(-len(runs[k]) // LANES) for k in order])
        top = int(steps[0])
        ids = np.full((len(order), top * LANES), pad, np.uint16)
        for row, k in enumerate(order):
            ids[row, : len(runs[k])] = runs[k]
        ids = ids.reshape(len(order), top, LANES)
        x = np.full((len(order), LANES), LOW, np.uint64)
        words = np.zeros((len(order), top, LANES), np.uint32)
        spilt = np.zeros((len(order), top, LANES), bool)
        saved: dict[int, np.ndarray] = {}
        for step in range(top - 1, -1, -1):
            n = int(np.searchsorted(-steps, -step, "left"))  # blocks that reach this step
            if (step + 1) % MARK_STEPS == 0:
                saved[step + 1] = x.copy()
            s, own = ids[:n, step], x[:n]
            full = own >= self.limit[s]
            words[:n, step] = own.astype(np.uint32)
            spilt[:n, step] = full
            own = np.where(full, own >> _WORD, own)
            f = self.freq[s]
            q = own // f
            x[:n] = (q << _BITS) + (own - q * f) + self.cum[s]
        out: list[dict] = [{}] * len(order)
        for row, k in enumerate(order):
            at = [m for m in range(MARK_STEPS, int(steps[row]), MARK_STEPS)]
            per_step = np.cumsum(spilt[row].sum(1))
            out[k] = {
                "states": x[row].astype("<u8").tobytes(),
                "marks": [int(per_step[m - 1]) for m in at],
                "mark_states": b"".join(saved[m][row].astype("<u8").tobytes() for m in at),
                "words": words[row][spilt[row]].astype("<u4").tobytes(),
            }
        return out

    def decode(self, blocks: list[dict]) -> list[np.ndarray]:
        """Ids of each block; every checkpoint begins a stretch that is decoded beside the others."""
        stretches = []
        pool, base = [], 0
        for k, b in enumerate(blocks):
            steps = -(-b["n_ids"] // LANES)
            words = np.frombuffer(b["words"], "<u4")
            states = np.frombuffer(b["states"] + b["mark_states"], "<u8").reshape(-1, LANES)
            for m, position in enumerate([0, *b["marks"]]):
                stretches.append((min(MARK_STEPS, steps - m * MARK_STEPS), k, m, base + position, states[m]))
            pool.append(words)
            base += len(words)
        words = np.concatenate([*pool, np.zeros(1, np.uint32)]).astype(np.uint64)
        stretches.sort(key=lambda t: -t[0])
        steps = np.array([t[0] for t in stretches])
        x = np.array([t[4] for t in stretches], np.uint64)
        place = np.array([t[3] for t in stretches])
        top = int(steps[0])
        found = np.zeros((len(stretches), top, LANES), np.uint16)
        slot_mask = np.uint64((1 << SCALE) - 1)
        for step in range(top):
            n = int(np.searchsorted(-steps, -step, "left"))
            own = x[:n]
            slot = own & slot_mask
            s = self.symbol[slot]
            found[:n, step] = s
            own = self.freq[s] * (own >> _BITS) + slot - self.cum[s]
            low = own < LOW
            taken = np.cumsum(low, axis=1)
            at = place[:n, None] + taken - 1
            x[:n] = np.where(low, (own << _WORD) | words[np.where(low, at, 0)], own)
            place[:n] += taken[:, -1]
        out = [np.zeros(-(-b["n_ids"] // LANES) * LANES, np.uint16) for b in blocks]
        for row, (count, k, m, _, _) in enumerate(stretches):
            first = m * MARK_STEPS * LANES
            out[k][first : first + count * LANES] = found[row, :count].reshape(-1)
        return [ids[: b["n_ids"]] for ids, b in zip(out, blocks)]


def _coder(spark: SparkSession, folder: str):
    """The shared table as a broadcast value: at most 65536 frequencies."""
    scaled = np.zeros(1 << 16, np.int64)
    for row in spark.read.parquet(f"{folder}/table").collect():
        scaled[row["id"]] = row["frequency"]
    return spark.sparkContext.broadcast(scaled)


def encode(docs: DataFrame, folder: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Tokenise whole texts and write them in ascending doc_id order into ``folder``."""
    spark = docs.sparkSession
    tokenised(docs, tokenizer, end_id, doc_id, text).write.option("compression", "none").parquet(f"{folder}/_tokens")
    tokens = spark.read.parquet(f"{folder}/_tokens")
    counts = np.zeros(1 << 16, np.int64)
    for row in counted(tokens).collect():
        counts[row["id"]] = row["count"]
    scaled = frequencies(counts)
    used = np.flatnonzero(scaled)
    spark.createDataFrame(
        [(int(k), int(scaled[k])) for k in used], "id int, frequency bigint"
    ).coalesce(1).write.parquet(f"{folder}/table")
    shared = _coder(spark, folder)
    rows = tokens.where("ids IS NOT NULL").select("doc_id", "ids")
    parts = max(1, -(-rows.count() // ROWS_PER_PART))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, unpack = Coder(shared.value), zstandard.ZstdDecompressor()
        part = TaskContext.get().partitionId()
        start = number = waiting = 0
        docs: list[int | None] = []
        pieces: list[np.ndarray] = []
        size = 0
        ready: list[tuple[np.ndarray, list, list[int]]] = []

        def written() -> pa.RecordBatch:
            nonlocal start, number
            columns: dict[str, list] = {name.split()[0]: [] for name in _BLOCKS.split(", ")}
            for (ids, owners, lengths), coded in zip(ready, coder.encode([r[0] for r in ready], end_id)):
                row = coded | {"part": part, "block": number, "start": start, "n_ids": len(ids), "lanes": LANES}
                row |= {"doc_ids": owners, "doc_lengths": lengths, "crc32": zlib.crc32(ids.astype("<u4").tobytes())}
                for name, values in columns.items():
                    values.append(row[name])
                start, number = start + len(ids), number + 1
            kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
            schema = [kinds[name.split()[1]] for name in _BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns.values(), schema)], list(columns))

        def close() -> None:
            nonlocal docs, pieces, size, waiting
            ready.append((np.concatenate(pieces), docs, [len(p) for p in pieces]))
            waiting += size
            docs, pieces, size = [], [], 0

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(unpack.decompress(value), "<u2")
                docs.append(key)
                pieces.append(ids)
                size += len(ids)
                if size >= BLOCK_IDS:
                    close()
                if waiting >= TOGETHER:
                    yield written()
                    ready, waiting = [], 0
        if pieces:
            close()
        if ready:
            yield written()

    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(run, _BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")
    sizes = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("base")).coalesce(1).write.parquet(
        f"{folder}/parts"
    )


def decode(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids): every document of the files, ids as little-endian uint32; a damaged block is an error."""
    shared = _coder(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            size = np.cumsum(np.array(batch.column("n_ids"))) // TOGETHER
            cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                blocks = batch.slice(a, b - a).to_pylist()
                keys, starts, values = [], [], []
                for block, ids in zip(blocks, coder.decode(blocks) if blocks else []):
                    whole = ids.astype("<u4")
                    if zlib.crc32(whole.tobytes()) != block["crc32"]:
                        raise ValueError(f"block {block['block']} of part {block['part']} is damaged")
                    ends = np.cumsum(block["doc_lengths"])
                    begins = ends - np.array(block["doc_lengths"])
                    keys += block["doc_ids"]
                    starts += (block["start"] + block["base"] + begins).tolist()
                    values += [whole[i:j].tobytes() for i, j in zip(begins, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(values, pa.binary())],
                    ["doc_id", "start", "ids"],
                )

    blocks = spark.read.parquet(f"{folder}/blocks").join(spark.read.parquet(f"{folder}/parts"), "part")
    return blocks.mapInArrow(run, "doc_id bigint, start bigint, ids binary")
