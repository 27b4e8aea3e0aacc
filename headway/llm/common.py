"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.session import scratch

#: Bytes of an Arrow batch sent to a Python worker: the executor and the worker each hold one whole.
ARROW_BYTES = 4 << 20
_ARROW_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Of Python workers, which outlive a task: memory that a task let go of returns to the
#: system, so one stage's largest arrays are not held on top of the next one's.
WORKER_ENV = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(8 << 20),
}
ROW_BITS = 33  # rows that a file may have in row numbers
MAP_BITS = 15  # rows whose marks are sent as one bitmap
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Let local Python workers import this package whatever their working folder is.

    Also bounds the bytes of the Arrow batches that they are sent; a lower limit stays.
    Settings of the session's own environment come before ``WORKER_ENV``.
    """
    limit = int(spark.conf.get(_ARROW_CONF).rstrip("b"))
    if not 0 < limit <= ARROW_BYTES:
        spark.conf.set(_ARROW_CONF, str(ARROW_BYTES))
    for key, value in WORKER_ENV.items():
        spark.sparkContext.environment.setdefault(key, os.environ.get(key, value))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known]))
    return spark


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name = "_" + name
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a unique row number, and the number's column name.

    Numbers made by a scan depend on how the scan is split, which may change between
    two scans of the same files. A table that has rows of Parquet files, none twice, is
    therefore numbered by a row's file and place in it, which no split changes, and not
    written again; any other is written once with its numbers, and all sides of a later
    join read that. The name is ``_row``, with more leading underscores if ``docs`` has a
    column of that name already, which stays as it is.
    """
    name, path, place = (_free(docs, c) for c in ("_row", "_file", "_place"))
    try:
        placed = docs.select(
            "*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place)
        )
    except AnalysisException:  # not Parquet files
        placed = None
    if placed is not None and "_metadata" not in docs.columns:
        maps = _bitmaps(placed, place, path).select(path, "n", F.bitmap_count("_map").alias("different"))
        files = maps.groupBy(path).agg(F.sum("n"), F.sum("different")).collect()
        if all(n == different for _, n, different in files):
            files = docs.sparkSession.createDataFrame(
                list(enumerate(sorted(f[0] for f in files))), f"{name} bigint, {path} string"
            )
            number = F.shiftleft(name, ROW_BITS).bitwiseOR(F.col(place)).alias(name)
            placed = placed.join(F.broadcast(files), path)
            return placed.select(*[F.col(f"`{c}`") for c in docs.columns], number), name
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def _bitmaps(numbers: DataFrame, row: str, *by: str) -> DataFrame:
    """Numbers as a bit each, in bitmaps ``_map`` of 32,768 by ``_part``; ``n`` rows."""
    part = F.shiftright(row, MAP_BITS).alias("_part")
    place = F.col(row).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    return numbers.groupBy(*by, part).agg(
        F.bitmap_construct_agg(place).alias("_map"), F.count(F.lit(1)).alias("n")
    )


def picked(docs: DataFrame, numbers: DataFrame, row: str, without: bool = False) -> DataFrame:
    """The rows of ``docs`` whose number ``row`` is in ``numbers`` - or is not, ``without`` -
    less the number. Rows are not shuffled: the numbers reach them as bitmaps."""
    part, bits = _free(docs, "_part"), _free(docs, "_map")
    maps = _bitmaps(numbers, row).select(F.col("_part").alias(part), F.col("_map").alias(bits))
    place = F.col(row).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    bit = F.coalesce(F.getbit(byte.cast("long"), place.bitwiseAND(F.lit(7)).cast("int")), F.lit(0))
    rows = docs.withColumn(part, F.shiftright(row, MAP_BITS)).join(F.broadcast(maps), part, "left")
    return rows.filter(bit == (0 if without else 1)).drop(part, bits, row)


def row_number(row: str | None) -> Column:
    """The column ``row`` of a :func:`numbered` table, or else a number of this scan."""
    return F.col(row) if row else F.monotonically_increasing_id()


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranged(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows in global order: partition i holds nothing that belongs behind partition i+1."""
    return df.repartitionByRange(tasks(df.sparkSession), *keys).sortWithinPartitions(*keys)


def partition_id() -> int:
    return TaskContext.get().partitionId()


def bases(local: DataFrame, measures: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Exclusive prefix sums of the totals of each partition ``pid``, per ``by``.

    ``measures`` names the summed column for every base. The result has one row per
    partition (and key), so its size is bounded by the number of partitions.
    """
    totals = local.groupBy(*by, "pid").agg(*[F.sum(c).alias(b) for b, c in measures.items()])
    before = Window.partitionBy(*by).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    return totals.select(
        *by,
        "pid",
        *[F.coalesce(F.sum(b).over(before), F.lit(0)).alias(b) for b in measures],
        *[F.sum(b).over(whole).alias(f"{b}_total") for b in measures],
    )


def batches(frames: Iterator[pa.RecordBatch], limit: int, size_of: str) -> Iterator[pa.Table]:
    """Arrow batches cut and joined to tables with about ``limit`` bytes in one column."""
    held, size = [], 0
    for frame in frames:
        column = frame.column(frame.schema.get_field_index(size_of))
        lengths = np.asarray(
            pc.binary_length(column.cast(pa.large_binary())).fill_null(0), dtype=np.int64
        )
        at = 0
        while at < frame.num_rows:
            fits = int(np.searchsorted(np.cumsum(lengths[at:]), limit - size, side="right"))
            take = max(fits, 0 if held else 1)
            if take:
                held.append(frame.slice(at, take))
                size += int(lengths[at : at + take].sum())
                at += take
            if at < frame.num_rows or size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)
