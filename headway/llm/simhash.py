"""Near-duplicates by SimHash, with pigeonring filtering of the candidates.

A fingerprint's 64 bits form a ring of 16 segments. If two fingerprints differ in at
most 3 bits, some segment starts a chain around the ring whose first l segments differ
in at most ``3 l / 16`` bits, for every l: so its first 5 segments agree, the first 10
differ in one bit at most, the first 15 in two. Fingerprints meet in buckets by the
start and the 20 bits of its first 5 segments, and by one of the four parts of the 44
other bits, of which one must agree as well. Inside a bucket the chain is checked, then
the distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import numbered, picked, ready, row_number, stage, tasks
from headway.llm.components import components

SHINGLE, SEED, DISTANCE = 3, 42, 3
SEGMENTS, WIDTH = 16, 4
#: Longest chains that may have 0, 1, 2, 3 differing bits.
CHAINS = [max(n for n in range(1, SEGMENTS + 1) if n * DISTANCE // SEGMENTS <= d) for d in range(4)]
PARTS, PART_BITS = 4, 11
BUCKET = 65_536  # different fingerprints that a task compares at once
FEW = 8


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the word shingles, as a signed integer."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[: -SHINGLE].tolist()]
        stops = (ends[SHINGLE - 1 :] - 1).tolist()
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, ``row`` (unique) and ``fp`` of every row; a null text has no words."""
    ready(docs.sparkSession)
    rows = docs.select("doc_id", row_number(row).alias("row"), "text")

    def each(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            prints = [
                fingerprint(text)
                for at in range(0, frame.num_rows, 256)
                for text in frame.column(2).slice(at, 256).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [frame.column(0), frame.column(1), pa.array(prints, pa.int64())],
                ["doc_id", "row", "fp"],
            )

    return rows.mapInArrow(each, "doc_id bigint, row bigint, fp bigint")


def _turned(fp: Column, start: Column) -> Column:
    """The ring read from a segment on."""
    by = start * WIDTH
    turned = F.call_function("shiftleft", fp, by).bitwiseOR(
        F.call_function("shiftrightunsigned", fp, F.lit(64) - by)
    )
    return F.when(start == 0, fp).otherwise(turned)


def _close(differing: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which of these differences (exclusive ors) pass the chain from ``start`` on."""
    by = (start * WIDTH).astype(np.uint64)
    x = (differing << by) | (differing >> ((np.uint64(64) - by) % np.uint64(64)))
    ok = np.ones(len(x), dtype=bool)
    for most, length in enumerate(CHAINS):
        ok &= np.bitwise_count(x >> np.uint64(64 - length * WIDTH)) <= most
    return ok


def _bucket_links(fps: np.ndarray, start: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected in one bucket, one per fingerprint at most."""
    open_, turns = fps.copy(), np.full(len(fps), start)
    while len(open_):
        front, open_ = [open_[0]], open_[1:]
        while front and len(open_):
            one = front.pop()
            near = _close(open_ ^ one, turns[: len(open_)])
            if near.any():
                found = open_[near]
                open_ = open_[~near]
                front.extend(found)
                yield np.full(len(found), one), found


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (u, v) of fingerprints within the distance that connect all such pairs.

    ``prints`` holds different fingerprints ``fp``. Not every close pair is listed: in
    each bucket links form a forest, so a group of n makes n - 1 links and not n * n / 2.
    A bucket with more than ``bucket`` fingerprints is cut in blocks, and each pair of
    blocks is a bucket of its own.
    """
    spark = ready(prints.sparkSession)
    rest = F.col("turned").bitwiseAND(F.lit((1 << PARTS * PART_BITS) - 1))
    rings = prints.select(
        "fp", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("start")
    ).select("fp", "start", _turned(F.col("fp"), F.col("start")).alias("turned"))
    rings = rings.select(
        "fp",
        (
            F.call_function("shiftrightunsigned", F.col("turned"), F.lit(PARTS * PART_BITS)) * 16
            + F.col("start")
        ).alias("chain"),
        rest.alias("rest"),
    )
    crowded = stage(rings.groupBy("chain").count().filter(F.col("count") > bucket), "simhash")
    if crowded.isEmpty():
        rings = rings.withColumn("block", F.lit(0).cast("long"))
    else:
        blocks = F.ceil(F.coalesce("count", F.lit(1)) / bucket).cast("int")
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        rings = (
            rings.join(crowded, "chain", "left")
            .withColumn("blocks", blocks)
            .withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn(
                "block",
                F.least("own", "other").cast("long") * (1 << 20) + F.greatest("own", "other"),
            )
        )
    keyed = rings.select(
        "fp", "chain", "rest", "block", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    ).select(
        (
            (F.col("chain") * PARTS + F.col("part")) * (1 << PART_BITS)
            + F.call_function(
                "shiftrightunsigned", F.col("rest"), (F.lit(PARTS - 1) - F.col("part")) * PART_BITS
            ).bitwiseAND(F.lit((1 << PART_BITS) - 1))
        ).alias("key"),
        "block",
        "fp",
    )

    def found(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(pairs):
            u = np.concatenate([p[0] for p in pairs]).view(np.int64)
            v = np.concatenate([p[1] for p in pairs]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        def work(key, block, fps):
            """Whole buckets: groups of equal key and block."""
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
            edge = np.append(np.flatnonzero(new), len(key))
            size = np.diff(edge)
            start = key // (PARTS << PART_BITS) % 16
            pairs = []
            few = np.repeat(size <= FEW, size)
            group = np.cumsum(new)
            for d in range(1, FEW):
                i = np.flatnonzero((group[d:] == group[:-d]) & few[d:])
                i = i[_close(fps[i] ^ fps[i + d], start[i])]
                if len(i):
                    pairs.append((fps[i], fps[i + d]))
            for g in np.flatnonzero(size > FEW):
                pairs.extend(_bucket_links(fps[edge[g] : edge[g + 1]], int(start[edge[g]])))
            return pairs

        held = None
        for frame in frames:
            now = [frame.column(i).to_numpy() for i in range(3)]
            now[2] = now[2].view(np.uint64)
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            key, block, fps = now
            if not len(key):
                continue
            open_ = np.flatnonzero((key != key[-1]) | (block != block[-1]))
            cut = int(open_[-1]) + 1 if len(open_) else 0
            held = [x[cut:] for x in now]
            if cut and (pairs := work(key[:cut], block[:cut], fps[:cut])):
                yield emit(pairs)
        if held is not None and (pairs := work(*held)):
            yield emit(pairs)

    dealt = keyed.repartition(tasks(spark), "key", "block").sortWithinPartitions("key", "block", "fp")
    return dealt.mapInArrow(found, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, row, fp, component_id and ``kept`` of every row.

    A component holds all rows whose fingerprints are linked, directly or over others;
    component_id is its smallest doc_id. ``kept`` marks one row of each: the one with
    that doc_id, the first such row where rows repeat. Rows without words (null, empty
    or white space only) have fingerprint 0 and are linked like any others. Null doc_ids
    come after all others. An empty table gives an empty result.
    """
    rows = stage(fingerprints(docs, row), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    each = stage(rows.groupBy("fp").agg(first.alias("first")), "simhash")
    rooted = components(links(each.select("fp"))).withColumnRenamed("node", "fp")
    linked = stage(
        each.join(rooted, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"),
        "simhash",
    )
    heads = linked.groupBy("root").agg(F.min("first").alias("head"))
    heads = linked.select("fp", "root").join(heads, "root").select("fp", "head")
    return rows.join(heads, "fp").select(
        "doc_id",
        "row",
        "fp",
        F.col("head.doc_id").alias("component_id"),
        (F.col("row") == F.col("head.row")).alias("kept"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "kept",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, all columns as they are.

    Rows keep the number that :func:`numbered` gives them.
    """
    docs, row = numbered(docs)
    kept = stage(near_duplicates(docs, row).filter("kept").select(F.col("row").alias(row)), "simhash")
    return picked(docs, kept, row)
