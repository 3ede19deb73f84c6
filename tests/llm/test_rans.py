from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from silverlode.llm import rans

BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("sizes", [[1], [64, 65, 1], [40_000, 5, 70_000], [16_384, 16_385]])
def test_round_trip(sizes):
    pick = np.random.default_rng(sum(sizes))
    runs = [np.minimum(pick.geometric(0.01, n), 3000).astype(np.uint16) for n in sizes]
    counts = np.bincount(np.concatenate(runs), minlength=1 << 16)
    counts[2] += 1
    coder = rans.Coder(rans.frequencies(counts))
    blocks = [c | {"n_ids": len(r)} for c, r in zip(coder.encode(runs, 2), runs)]
    assert all((a == b).all() for a, b in zip(coder.decode(blocks), runs))
    if max(sizes) > 16_384:
        assert any(b["marks"] for b in blocks)


def test_frequencies_sum_and_keep_rare_ids():
    counts = np.zeros(1 << 16, np.int64)
    counts[:50_000] = 1
    counts[7] = 10**12
    scaled = rans.frequencies(counts)
    assert scaled.sum() == 1 << 20 and (scaled[:50_000] >= 1).all() and not scaled[50_000:].any()


def test_documents(spark, folder):
    texts = ["Hello, world. It's  here\n\nnow", None, "", "x" * 20_000, "日本 語", "a  b"]
    rows = [(k, t, "no") for k, t in zip([9, 3, 3, 1, None, 7], texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    rans.encode(docs, f"{folder}/f", BYTES, 2)
    got = sorted((r.start, r.doc_id, bytes(r.ids)) for r in rans.decode(spark, f"{folder}/f").collect())
    tool = Tokenizer.from_file(BYTES)
    encoded = [(k, np.array([*tool.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for k, t, _ in rows]
    want, start = [], 0
    for k, ids in sorted(encoded, key=lambda r: (-1 if r[0] is None else r[0], r[1])):
        want.append((start, k, ids))
        start += len(ids) // 4
    assert [(s, k, zlib.crc32(i)) for s, k, i in got] == [(s, k, zlib.crc32(i)) for s, k, i in want]


def test_empty_and_damaged(spark, folder):
    rans.encode(spark.createDataFrame([], "doc_id bigint, text string"), f"{folder}/e", BYTES, 2)
    assert rans.decode(spark, f"{folder}/e").collect() == []
    rans.encode(spark.createDataFrame([(1, "some words")], "doc_id bigint, text string"), f"{folder}/d", BYTES, 2)
    from pyspark.sql import functions as F

    broken = spark.read.parquet(f"{folder}/d/blocks").withColumn("crc32", F.col("crc32") + 1)
    broken.write.parquet(f"{folder}/x/blocks")
    for name in ("table", "parts"):
        spark.read.parquet(f"{folder}/d/{name}").write.parquet(f"{folder}/x/{name}")
    with pytest.raises(Exception, match="damaged"):
        rans.decode(spark, f"{folder}/x").collect()
