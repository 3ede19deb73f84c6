"""Whitening by MLlib's BlockMatrix: centred rows as distributed blocks, their scatter by a transposed product, a small
eigenproblem in the driver, and a second product that projects every row.

Each entry c becomes the whole number x = floor(steps * c). The fit list holds each different vector x once; its
n, its sums S and its covariance (divisor n, centred before multiplying) decide everything. Block rows hold
``BLOCK_ROWS`` rows; the middle dimension of the transposed product is split so that a task multiplies ``TASK_BLOCKS`` blocks, and
partial products are summed by key. Every row of the table has a number of its own, by which its projection is joined back: equal
vectors, however many, are equal rows of the matrix and no common key.

The driver holds one dimensions x dimensions matrix, the eigenvectors and, within MLlib, the coordinates of the blocks.
``deviation`` is the exact sum of (n * x - S)^2, a decimal of 38 digits.

Cases: vectors that are null, empty, hold a null or non-finite entry, or have another length than the commonest one (the
longer of two equally common) are left out, null ids are kept as they are; rows with the same id or vector are rows of
their own; a direction without variance (at most 1e-12 of the trace) has no whitened value, so that one different vector or an empty
table gives no rows; only the key is carried, whatever other columns there are.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.llm.frames import stored

BLOCK_ROWS, BLOCK_COLUMNS, TASK_BLOCKS = 1024, 1024, 8
FLAT = 1e-12
RESULT = "{key} {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whole_vectors(vectors: DataFrame, key: str, vector: str, steps: int) -> DataFrame:
    """(key, x): the vectors that take part, as whole numbers."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key), v.alias("v")).where("v IS NOT NULL AND size(v) > 0")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where(~bad)
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    x = F.transform("v", lambda c: F.floor(c * steps).cast("bigint"))
    return rows.where(F.size("v") == (sizes["d"] if sizes else 0)).select(F.col(key), x.alias("x"))


def numbered(rows: DataFrame) -> DataFrame:
    """The rows, written, with ``index`` from 0 without a gap: place in the partition after the partitions before."""
    known = stored(rows.withColumn("at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftrightunsigned("at", 33)
    sizes = known.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a written partition
    bases = F.broadcast(sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")))
    index = F.col("base") + F.col("at").bitwiseAND((1 << 33) - 1)
    return known.join(bases, part == F.col("part")).withColumn("index", index).drop("at", "part", "base")


def _matrix(vectors: DataFrame, n: int, dimensions: int) -> IndexedRowMatrix:
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, dimensions)


def _blocks(rows: DataFrame, mean: Column, n: int, dimensions: int) -> BlockMatrix:
    """The centred rows (index, x) as blocks."""
    centred = F.zip_with("x", mean, lambda a, m: a - m)
    vectors = rows.select("index", array_to_vector(centred).alias("vector"))
    return _matrix(vectors, n, dimensions).toBlockMatrix(BLOCK_ROWS, min(BLOCK_COLUMNS, dimensions))


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transposed product of a tall matrix with itself, the rows split over tasks and their products summed."""
    wrapper = blocks.transpose()._java_matrix_wrapper
    splits = max(1, -(-blocks.numRowBlocks // TASK_BLOCKS))
    product = BlockMatrix(wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits), blocks.colsPerBlock, blocks.colsPerBlock)
    found = product.toLocalMatrix().toArray()
    return (found + found.T) / 2


def project(blocks: BlockMatrix, onto: np.ndarray) -> BlockMatrix:
    """The rows times a small matrix."""
    table = SparkSession.active().createDataFrame([(k, row.tolist()) for k, row in enumerate(onto)], "index bigint, row array<double>")
    matrix = _matrix(table.select("index", array_to_vector("row").alias("vector")), *onto.shape)
    return blocks.multiply(matrix.toBlockMatrix(blocks.colsPerBlock, onto.shape[1]))


def whiten(vectors: DataFrame, components: int = 4, steps: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): each row on the leading components."""
    spark = vectors.sparkSession
    rows = numbered(whole_vectors(vectors, key, vector, steps))
    fit = numbered(rows.select("x").distinct())
    dimensions = len(fit.select("x").first()["x"]) if not fit.isEmpty() else 0
    empty = spark.createDataFrame([], RESULT.format(key=f"`{key}`", kind=vectors.schema[key].dataType.simpleString()))
    if not dimensions:
        return empty
    n, *sums = fit.agg(F.count("*"), *[F.sum(F.col("x")[k]) for k in range(dimensions)]).first()
    mean = F.array(*[F.lit(s / n) for s in sums])
    fitted = _blocks(fit, mean, n, dimensions)
    covariance = scatter(fitted) / n
    values, axes = np.linalg.eigh(covariance)
    order = [k for k in np.argsort(values)[::-1][:components] if values[k] > FLAT * np.trace(covariance)]
    if not order:
        return empty
    onto = axes[:, order] / np.sqrt(values[order])
    error = float(np.abs(scatter(project(fitted, onto)) / n - np.eye(len(order))).max())
    explained = F.array(*[F.lit(float(values[k] / np.trace(covariance))) for k in order])

    whole = project(_blocks(rows, mean, rows.count(), dimensions), onto).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", whole._java_matrix_wrapper._java_model)
    found = found.select("index", vector_to_array("vector").alias("z"))
    exact = F.zip_with("x", F.array(*[F.lit(s) for s in sums]), lambda x, s: (x.cast("decimal(19,0)") * n - s).cast("decimal(19,0)"))
    deviation = F.aggregate(exact, F.lit(0).cast("decimal(38,0)"), lambda total, t: (total + t * t).cast("decimal(38,0)"))
    each = F.posexplode(F.zip_with("z", explained, lambda z, e: F.struct(z.alias("whitened"), e.alias("explained"))))
    return (
        rows.select("index", F.col(key).alias("own"), deviation.alias("deviation"))
        .join(found, "index")
        .select("own", "deviation", each.alias("at", "value"))
        .select(
            F.col("own").alias(key),
            (F.col("at") + 1).cast("int").alias("component"),
            F.lit(n).cast("bigint").alias("n"),
            "deviation",
            F.col("value.whitened").alias("whitened"),
            F.col("value.explained").alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
