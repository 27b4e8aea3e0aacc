"""Balanced contiguous shards from global prefix sums of byte sizes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import bases, partition_id, ranged, ready, stage

ROW_BYTES = 8  # what a document costs besides its text


def assign(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Shard and slot of every document; shards are runs of doc_id with near-equal bytes.

    Rows are put in the order of doc_id by a range shuffle (of keys and sizes, not of
    texts), each partition sums its own sizes, and the partitions' totals - one row
    each - give every row its place in the whole. A row belongs to the shard in which
    its middle byte falls, so a shard misses its target by at most one document.

    Result: doc_id, size, text_crc32, shard, slot (gapless from 0 in doc_id order) and
    first_byte, the bytes before the document. Null texts have no bytes but the fixed
    ones; null doc_ids come first; equal doc_ids follow each other. Shards beyond the
    number of rows stay empty. An empty table gives an empty result.
    """
    ready(docs.sparkSession)
    binary = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(binary) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(binary).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )

    def sums(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, bytes_before, rows_before = partition_id(), 0, 0
        for frame in frames:
            size = frame.column(1).to_numpy()
            n, ends = frame.num_rows, bytes_before + np.cumsum(size)
            yield pa.RecordBatch.from_arrays(
                [
                    *frame.columns[:3],
                    pa.array(np.full(n, pid, np.int32)),
                    pa.array(ends - size),
                    pa.array(rows_before + np.arange(n)),
                ],
                ["doc_id", "size", "text_crc32", "pid", "at", "nr"],
            )
            if n:
                bytes_before, rows_before = int(ends[-1]), rows_before + n

    local = stage(
        ranged(rows, "doc_id", "text_crc32", "size", "row").mapInArrow(
            sums, "doc_id bigint, size bigint, text_crc32 bigint, pid int, at bigint, nr bigint"
        ),
        "shards",
    )
    base = bases(
        local.select("pid", "size", F.lit(1).alias("one")), {"bytes": "size", "rows": "one"}
    )
    placed = local.join(F.broadcast(base), "pid").select(
        "doc_id",
        "size",
        "text_crc32",
        (F.col("bytes") + F.col("at")).alias("first_byte"),
        (F.col("rows") + F.col("nr")).alias("position"),
        F.expr(
            f"cast(((2 * (bytes + at) + size) * {shards}L) div (2 * bytes_total) as int)"
        ).alias("shard"),
    )
    starts = placed.groupBy("shard").agg(F.min("position").alias("start"))
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("position") - F.col("start")).alias("slot"),
        "first_byte",
    )


def digest(docs: DataFrame, shards: int = 24) -> DataFrame:
    return assign(docs, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "first_byte",
    )
