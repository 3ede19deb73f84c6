"""File layout: multi-column clustering for data skipping, and small-file compaction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_FILE_BYTES = 256 << 20
TARGET_FILE_ROWS = 4_000_000

SAMPLED_TEXTS = 64
COUNTED_CELLS = 1 << 16
CURVES = ("hilbert", "morton")


def _is_text(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType))


def _as_ordered(df: DataFrame, name: str) -> Column:
    """A number that rises with the column, or its whole text."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("string")


def _text_cuts(df: DataFrame, name: str, cells: int) -> list[str]:
    """Quantiles of whole texts from a sample of 64 rows a cell, drawn by hash; only bounds depend on it."""
    drawn = df.where(F.col(name).isNotNull()).select(name, F.xxhash64(name, F.spark_partition_id(), F.monotonically_increasing_id()).alias("_h"))
    found = sorted((r[0] for r in drawn.orderBy("_h").limit(SAMPLED_TEXTS * cells).collect()), key=lambda t: t.encode())
    return [found[len(found) * k // cells] for k in range(1, cells)] if found else []


def _literal(value: float | str) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D"


def _with_bucket(df: DataFrame, ordered: str, name: str, cuts: Sequence[float] | Sequence[str], bits: int) -> DataFrame:
    """Add the count of cuts that are <= the value by binary search over a literal array.

    Each halving is a projection of its own: the generated code stays short enough to be
    compiled, which one nested expression of 2**bits branches is not.
    """
    values = ", ".join([*map(_literal, cuts), *["NULL"] * ((1 << bits) - 1 - len(cuts))])
    found = df.withColumn(name, F.lit(0))
    if not cuts:
        return found
    for bit in reversed(range(bits)):
        step = 1 << bit
        reached = F.expr(f"coalesce({ordered} >= element_at(array({values}), `{name}` + {step}), false)")
        found = found.withColumn(name, F.col(name) + F.when(reached, step).otherwise(0))
    return found


def with_zorder_key(df: DataFrame, columns: Sequence[str], bits: int = 8, name: str = "_z") -> DataFrame:
    """Add the Morton key: bucket numbers of the columns with their bits interleaved.

    Buckets are bounded by approximate quantiles, those of texts by whole values of a sample; NULL
    goes to bucket 0. What reaches the driver is one row of 2**bits - 1 bounds per column, and 64 times as
    many sampled values of a text column.
    """
    if bits * len(columns) > 62:
        raise ValueError("bits times columns must stay within a long")
    numbered = with_cells(df, columns, bits)
    # Entry b holds the bits of b, each moved to its place among those of the other columns.
    spread = [sum((b >> bit & 1) << (bit * len(columns)) for bit in range(bits)) for b in range(1 << bits)]
    table = F.expr(f"array({', '.join(f'{v}L' for v in spread)})")
    last = len(columns) - 1
    pieces = [F.shiftleft(F.element_at(table, F.col(f"_b{i}") + 1), last - i) for i in range(len(columns))]
    keyed = numbered.withColumn(name, reduce(lambda a, b: a.bitwiseOR(b), pieces))
    return keyed.select(*df.columns, name)


def zorder(df: DataFrame, columns: Sequence[str], partitions: int, bits: int = 8) -> DataFrame:
    """Same rows, clustered so that row groups have narrow ranges in every named column.

    A row hash follows the key in the range partitioning, so one heavy cell spreads over
    several partitions.
    """
    keyed = with_zorder_key(df, columns, bits)
    spread = F.xxhash64(*[c for c in df.columns if not has_map(df.schema[c].dataType)])
    return keyed.repartitionByRange(partitions, F.col("_z"), spread).sortWithinPartitions("_z", *columns).drop("_z")


def bits_for(files: int, columns: int) -> int:
    """Bits a column that tell the target files apart, and two more for cells smaller than a file."""
    return max(1, ceil(log2(max(2, files)) / columns)) + 2


def _bit(number: Column, bit: int) -> Column:
    return F.shiftright(number, bit).bitwiseAND(1)


def _packed(bits: list[Column]) -> Column:
    """Bits, the most significant first, as bytes: any number of them, in an order that compares like the number."""
    bits = [*bits, *[F.lit(0)] * (-len(bits) % 8)]
    groups = [bits[k : k + 8] for k in range(0, len(bits), 8)]
    values = [reduce(lambda a, b: a + b, [F.shiftleft(b.cast("int"), 7 - k) for k, b in enumerate(g)]) for g in groups]
    return F.unhex(F.concat(*[F.lpad(F.hex(v), 2, "0") for v in values]))


def _hilbert_axes(df: DataFrame, names: Sequence[str], bits: int) -> DataFrame:
    """Skilling's transform of the cell numbers in place: their bits, interleaved, then are the Hilbert index."""
    first = names[0]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for name in names:
            high = _bit(F.col(name), bit) == 1
            swapped = F.when(high, F.lit(0)).otherwise(F.col(first).bitwiseXOR(F.col(name)).bitwiseAND(low))
            df = df.withColumn("_t", swapped)
            turned = F.when(high, F.col(first).bitwiseXOR(F.lit(low))).otherwise(F.col(first).bitwiseXOR(F.col("_t")))
            if name == first:
                df = df.withColumn(first, F.when(high, F.col(first).bitwiseXOR(F.lit(low))).otherwise(F.col(first)))
            else:
                df = df.withColumns({first: turned, name: F.col(name).bitwiseXOR(F.col("_t"))})
    for before, name in zip(names[:-1], names[1:]):
        df = df.withColumn(name, F.col(name).bitwiseXOR(F.col(before)))
    df = df.withColumn("_t", F.lit(0))
    for bit in range(bits - 1, 0, -1):
        flip = F.when(_bit(F.col(names[-1]), bit) == 1, F.lit((1 << bit) - 1)).otherwise(0)
        df = df.withColumn("_t", F.col("_t").bitwiseXOR(flip))
    return df.withColumns({name: F.col(name).bitwiseXOR(F.col("_t")) for name in names}).drop("_t")


def _numbered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"_n{i}": _as_ordered(df, c) for i, c in enumerate(columns)})


def cell_cuts(df: DataFrame, columns: Sequence[str], bits: int) -> list[list]:
    """For each column the quantiles that bound its cells, rising."""
    cells = 1 << bits
    numbered = _numbered(df, columns)
    texts = {i for i, c in enumerate(columns) if _is_text(df.schema[c].dataType)}
    fractions = f"array({', '.join(str(i / cells) for i in range(1, cells))})"
    numbers = [i for i in range(len(columns)) if i not in texts]
    quantiles = [F.expr(f"percentile_approx(_n{i}, {fractions})").alias(f"_q{i}") for i in numbers]
    row = numbered.agg(*quantiles).first() if quantiles else {}
    bounds = [_text_cuts(numbered, f"_n{i}", cells) if i in texts else row[f"_q{i}"] for i in range(len(columns))]
    return [sorted(set(found or []), key=lambda v: v.encode() if isinstance(v, str) else v) for found in bounds]


def with_cells(df: DataFrame, columns: Sequence[str], bits: int, cuts: Sequence[list] | None = None) -> DataFrame:
    """``df`` with the cell number of each column as ``_b0``, ``_b1``, ...: its place among quantiles of the column."""
    numbered = _numbered(df, columns)
    for i, found in enumerate(cuts or cell_cuts(df, columns, bits)):
        numbered = _with_bucket(numbered, f"_n{i}", f"_b{i}", found, bits)
    return numbered.select(*df.columns, *[f"_b{i}" for i in range(len(columns))])


def with_curve_key(df: DataFrame, columns: Sequence[str], bits: int, curve: str = "hilbert", name: str = "_z") -> DataFrame:
    """Add a binary key along a Hilbert or Morton curve through the columns' cells, of bits x columns bits, however many."""
    if curve not in CURVES:
        raise ValueError(f"unknown curve {curve!r}")
    return _with_key(with_cells(df, columns, bits), len(columns), bits, curve, name).select(*df.columns, name)


def _with_key(placed: DataFrame, columns: int, bits: int, curve: str, name: str = "_z") -> DataFrame:
    cells = [f"_b{i}" for i in range(columns)]
    if curve == "hilbert":
        placed = _hilbert_axes(placed, cells, bits)
    interleaved = [_bit(F.col(c), bit) for bit in range(bits - 1, -1, -1) for c in cells]
    return placed.withColumn(name, _packed(interleaved))


@dataclass(frozen=True)
class Cells:
    """The cells of a table: their bounds, and the rows in each that has any. Layouts along several curves can share them."""

    columns: tuple[str, ...]
    bits: int
    cuts: list[list]
    counts: list[tuple[int, ...]]


def measure_cells(df: DataFrame, columns: Sequence[str], bits: int) -> Cells:
    """Two passes over the named columns alone; one row a cell reaches the driver, at most ``COUNTED_CELLS``."""
    if bits * len(columns) > log2(COUNTED_CELLS):
        raise ValueError(f"more than {COUNTED_CELLS} cells are not counted")
    cuts = cell_cuts(df, columns, bits)
    names = [f"_b{i}" for i in range(len(columns))]
    placed = with_cells(df.select(*columns), columns, bits, cuts)
    return Cells(tuple(columns), bits, cuts, [tuple(r) for r in placed.groupBy(*names).count().collect()])


def _along(df: DataFrame, cells: Cells, files: int, curve: str) -> DataFrame:
    """Each row has a place along the curve, in its cell by a hash of the row: places decide the file, and no range has to be sampled."""
    spark, names = df.sparkSession, [f"_b{i}" for i in range(len(cells.columns))]
    counted = spark.createDataFrame(cells.counts, ", ".join([*[f"{n} int" for n in names], "_rows long"]))
    in_order = _with_key(counted, len(names), cells.bits, curve).orderBy("_z").select(*names, "_rows").collect()
    total = sum(r["_rows"] for r in in_order)
    starts = accumulate((r["_rows"] for r in in_order), initial=0)
    bases = spark.createDataFrame([(*r, start) for r, start in zip(in_order, starts)], f"{counted.schema.simpleString()[7:-1]}, _start long")
    spread = F.xxhash64(*[c for c in df.columns if not has_map(df.schema[c].dataType)])
    # A row whose cell was not counted, since the table has changed meanwhile, is still kept.
    placed = with_cells(df, cells.columns, cells.bits, cells.cuts).join(F.broadcast(bases), names, "left")
    start = F.coalesce(F.col("_start"), F.lit(0))
    rows = placed.withColumns({"_start": start, "_place": start + F.coalesce(F.pmod(spread, F.col("_rows")), F.lit(0))})
    dealt = rows.select(*df.columns, "_start", F.expr(f"cast(_place * {files} div {max(1, total)} as int)").alias("_file"))
    ordered = dealt.repartitionById(files, F.col("_file"))
    return ordered.sortWithinPartitions("_start", *cells.columns).select(*df.columns)


def cluster(
    df: DataFrame, columns: Sequence[str], files: int, curve: str = "hilbert", bits: int | None = None, cells: Cells | None = None
) -> DataFrame:
    """Same rows, clustered along a curve for ``files`` files; the cells are as fine as that number of files needs.

    Up to ``COUNTED_CELLS`` cells are counted (``cells``, if they were before), which makes the files about equal; beyond that the key is
    range partitioned. Either way a row hash comes after the cell, so one heavy cell spreads over several files.
    """
    if curve not in CURVES:
        raise ValueError(f"unknown curve {curve!r}")
    bits = bits or bits_for(files, len(columns))
    if cells or bits * len(columns) <= log2(COUNTED_CELLS):
        return _along(df, cells or measure_cells(df, columns, bits), files, curve)
    keyed = with_curve_key(df, columns, bits, curve)
    spread = F.xxhash64(*[c for c in df.columns if not has_map(df.schema[c].dataType)])
    return keyed.repartitionByRange(files, F.col("_z"), spread).sortWithinPartitions("_z", *columns).drop("_z")


def file_spans(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """(file, row_count, and min and max of each column), one row a file: what decides which files a filter can skip."""
    rows = spark.read.parquet(path)
    spans = [f(c).alias(f"{label}_{c}") for c in columns for f, label in ((F.min, "min"), (F.max, "max"))]
    return rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("row_count"), *spans)


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    return isinstance(kind, T.MapType)


def folder_bytes(spark: SparkSession, path: str) -> int:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(location).getLength()


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = TARGET_FILE_BYTES, file_rows: int = TARGET_FILE_ROWS) -> int:
    """Rewrite a parquet folder into files of about ``file_bytes`` and at most about ``file_rows``; returns how many were asked for.

    Rows keep the order of the files (by name) and their order inside: each row's place in that order, one number, decides its
    file and is what a file is sorted by, so a clustered layout stays clustered, no key can make a file large, and the memory of the
    task that sorts a file follows ``file_rows``, however much there is. What reaches the driver is one row a source file.
    """
    rows = spark.read.parquet(source)
    columns = rows.columns
    named = rows.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    counts = sorted(tuple(r) for r in named.groupBy("_file").count().collect())
    total = sum(n for _, n in counts)
    files = max(1, ceil(folder_bytes(spark, source) / file_bytes), ceil(total / file_rows))
    starts = accumulate((n for _, n in counts), initial=0)
    bases = spark.createDataFrame([(file, start) for (file, _), start in zip(counts, starts)], "_file string, _base long")
    placed = named.join(F.broadcast(bases), "_file").select(*columns, (F.col("_base") + F.col("_row")).alias("_place"))
    ordered = placed.repartitionById(files, F.expr(f"cast(_place * {files} div {max(1, total)} as int)")).sortWithinPartitions("_place")
    ordered.select(*columns).write.mode("overwrite").parquet(target)
    return files
