"""The operators as queries over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import (
    alignment,
    flat_graph,
    hash_tree,
    hilbert,
    lm_scoring,
    mixing,
    order_minhash,
    packing,
    paragraphs,
    quality,
    rans,
    suffixes,
    whitening,
)
from silverlode.llm.frames import small_batches, table
from silverlode.session import new_folder

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return function


@query
def op3_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "rans")
    rans.encode(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), 2)
    read = rans.decode(spark, folder)
    return read.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1, 4096)


@query
def op5_suffix_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = {"whole": F.sha2(F.col("text").cast("binary"), 256)}
    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents"), 400, extra=digest)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.when(F.col("kept").isNull(), F.col("whole")).otherwise(F.sha2("kept", 256)).alias("kept_sha256"),
        removed.alias("n_bytes_removed"),
    )


@query
def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = paragraphs.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines_removed", "n_bytes_removed", "text")


@query
def op9_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_raked_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.weights(table(spark, sf_dir, "documents"))


@query
def op4_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as of high quality and not toxic."""
    good = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return lm_scoring.word_cross_entropy_difference(table(spark, sf_dir, "documents"), good)


@query
def op7_shifted_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(table(spark, sf_dir, "embeddings"), F.col("key") % 100 == 0, 10)


@query
def op2_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_graph.near_duplicates(table(spark, sf_dir, "embeddings"), 0.9)


@query
def op11_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.agreement(table(spark, sf_dir, "documents"), a, b)


@query
def op12_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of weight 1 in three regions of two racks; the grown tree has a 25th in a region of its own."""
    tree = hash_tree.standard_tree(24)
    placed = hash_tree.place(table(spark, sf_dir, "documents"), tree, hash_tree.grown(tree))
    return hash_tree.slots(placed).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# The checksum goes over the bytes of each different text; its table of 256 entries follows from the polynomial.
ORACLE["op12_hash_tree"] = """
WITH entries AS (
  SELECT range AS b, list_reduce(list_prepend(range, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256)),
fixed AS (SELECT list(v ORDER BY b) AS t FROM entries),
texts AS MATERIALIZED (SELECT text, hex(encode(text)) AS h FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL)),
bytes AS MATERIALIZED (
  SELECT text, list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)) AS b FROM texts),
sums AS (
  SELECT text, CAST(length(b) AS BIGINT) AS n, CAST(xor(list_reduce(list_prepend(4294967295, b),
    lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS BIGINT) AS crc FROM bytes, fixed),
keys AS (SELECT DISTINCT coalesce(CAST(doc_id AS VARCHAR), 'null') AS k FROM documents),
leaves AS (SELECT n, s, s // 4 AS rack, s // 8 AS region FROM (VALUES (24), (25)) AS v(n), range(25) AS r(s) WHERE s < n),
draws AS (
  SELECT k, n, path, w, -ln((CAST('0x' || substr(md5(k || path), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / w AS score
  FROM keys, (
    SELECT n, '/' || region AS path, CAST(count(*) AS DOUBLE) AS w FROM leaves GROUP BY n, region
    UNION ALL SELECT n, '/' || region || '/' || rack, CAST(count(*) AS DOUBLE) FROM leaves GROUP BY n, region, rack
    UNION ALL SELECT n, '/' || region || '/' || rack || '/' || s, 1.0 FROM leaves)),
regions AS (SELECT k, n, arg_min(path, score) AS region FROM draws WHERE path NOT LIKE '/%/%' GROUP BY k, n),
racks AS (
  SELECT k, n, arg_min(path, score) AS rack FROM draws JOIN regions USING (k, n)
  WHERE path LIKE region || '/%' AND path NOT LIKE region || '/%/%' GROUP BY k, n),
shards AS (
  SELECT k, n, CAST(split_part(arg_min(path, score), '/', 4) AS INTEGER) AS shard FROM draws JOIN racks USING (k, n)
  WHERE path LIKE rack || '/%' GROUP BY k, n),
placed AS (
  SELECT doc_id, coalesce(s.n, 0) + 8 AS size, coalesce(s.crc, 0) AS text_crc32, now.shard, later.shard AS grown_shard
  FROM documents LEFT JOIN sums s USING (text)
  JOIN shards now ON now.n = 24 AND now.k = coalesce(CAST(doc_id AS VARCHAR), 'null')
  JOIN shards later ON later.n = 25 AND later.k = now.k)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM placed
"""


@query
def op13_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("bigint"))
