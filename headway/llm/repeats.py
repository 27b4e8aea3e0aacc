"""Removal of repeated byte strings by interval expansion on Burrows-Wheeler transforms.

A byte goes if a 100-byte string covers it that also starts earlier. Strings meet by
content: of the 77 24-byte grams in a string the one of least hash is its anchor, so
equal strings have equal anchors, at the same place. Neighbouring strings with one anchor
make a region. A region whose whole content occurs earlier goes as a whole. What is left
to decide are different regions around equal anchors, the edges of repeated passages;
they are gathered by anchor, transformed, and their strings are told apart by common
prefixes of increasing length, up to the minimum: see :func:`classes`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import numbered, ready, row_number, stage, tasks
from headway.llm.hashing import BASE, MASK, SEGMENT, TABLE, mixed, range_hashes

LENGTH = 100
GRAM = 24
HALF = (LENGTH - GRAM) // 2
WINDOW = LENGTH - GRAM + 1  # grams in a string
FLUSH = 8 << 20  # bytes of text whose regions are sent together
BUCKETS = 1024  # groups that regions and documents are dealt to, at least
BUCKET_BYTES = 4 << 20  # text per group where there is more
CHUNK = 1 << 20  # bytes transformed together; a group of regions is never cut

def _gram_hashes(data: np.ndarray) -> np.ndarray:
    one = TABLE[data]
    power, parts = 1, {1: one}
    while power * 2 <= GRAM:
        step = np.uint64(pow(BASE, power, 1 << 64))
        last = parts[power]
        parts[2 * power] = last[:-power] * step + last[power:]
        power *= 2
    done, out = power, parts[power]
    while done < GRAM:
        power = 1 << (GRAM - done).bit_length() - 1
        n = len(data) - done - power + 1
        out = out[:n] * np.uint64(pow(BASE, power, 1 << 64)) + parts[power][done : done + n]
        done += power
    return mixed(out)


def regions(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Regions of one stretch of bytes: gram hash, region hash, first and last string
    start, place of the anchor."""
    n = len(data) - LENGTH + 1
    gram = _gram_hashes(data)
    # places in the low bits: of equal hashes the leftmost is the least
    least = gram & np.uint64(MASK ^ (SEGMENT - 1)) | np.arange(len(gram), dtype=np.uint64)
    span = 1
    while span * 2 <= WINDOW:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = WINDOW - span
    least = np.minimum(least[:n], least[rest : rest + n]) if rest else least[:n]
    anchor = (least & np.uint64(SEGMENT - 1)).astype(np.int64)
    new = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
    first = np.concatenate(([0], new))
    last = np.concatenate((new - 1, [n - 1]))
    whole = range_hashes(data, first, last + LENGTH)
    shape = (anchor[first] - first) * 256 + (last - first)
    return gram[anchor[first]], mixed(whole + shape.astype(np.uint64)), first, last, anchor[first]


def _pack(**columns: np.ndarray) -> bytes:
    """Columns of equal length, each in its own bytes."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in columns.values()))


def _unpack(blobs: list[bytes], **dtypes: str) -> dict[str, np.ndarray]:
    found: dict[str, list] = {k: [] for k in dtypes}
    width = sum(np.dtype(d).itemsize for d in dtypes.values())
    for blob in blobs:
        data = zstandard.ZstdDecompressor().decompress(blob)
        n, at = len(data) // width, 0
        for name, dtype in dtypes.items():
            found[name].append(np.frombuffer(data, dtype, n, at))
            at += n * np.dtype(dtype).itemsize
    return {k: np.concatenate(v) if v else np.array([], dtypes[k]) for k, v in found.items()}


ASK = {"h": "<u8", "r": "<u8", "doc": "<i8", "text": "<u4", "s": "<u4", "e": "u1", "a": "u1"}
NEED = {"h": "<u8", "doc": "<i8", "text": "<u4", "s": "<u4", "e": "u1", "a": "u1"}
GONE = {"doc": "<i8", "text": "<u4", "s": "<u4", "end": "<u4"}
ROWS = "kind int, bucket int, data binary"


def _doc_bucket(doc: np.ndarray, text: np.ndarray, buckets: int) -> np.ndarray:
    return (doc ^ doc >> 17 ^ text.astype(np.int64)) % buckets


def _batch(kind: int, bucket: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch | None:
    """One row per bucket with its part of the columns."""
    order = np.argsort(bucket, kind="stable")
    used, starts = np.unique(bucket[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    parts = [
        _pack(**{k: c[order[a:b]] for k, c in columns.items()})
        for a, b in zip(starts, ends, strict=True)
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind] * len(used), pa.int32()),
            pa.array(used.astype(np.int32)),
            pa.array(parts, pa.binary()),
        ],
        ["kind", "bucket", "data"],
    )


def _firsts(x: dict[str, np.ndarray]) -> tuple[dict, np.ndarray, np.ndarray]:
    """Sorted by gram, region, document and place, each occurrence once; where a gram
    and where a region starts."""
    order = np.lexsort((x["s"], x["text"], x["doc"], x["r"], x["h"]))
    x = {k: c[order] for k, c in x.items()}
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([x[k][1:] != x[k][:-1] for k in ("h", "r", "doc", "text", "s")], axis=0)
    x = {k: c[new] for k, c in x.items()}
    gram = np.ones(len(x["h"]), dtype=bool)
    gram[1:] = x["h"][1:] != x["h"][:-1]
    region = gram.copy()
    region[1:] |= x["r"][1:] != x["r"][:-1]
    return x, gram, region


def _gone(x: dict[str, np.ndarray], which: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Whole regions that occur earlier."""
    part = {k: c[which] for k, c in x.items()}
    end = part["s"] + part["e"].astype(np.uint32) + np.uint32(LENGTH)
    order = np.lexsort((part["s"], part["text"], part["doc"]))
    columns = {
        "doc": part["doc"][order], "text": part["text"][order],
        "s": part["s"][order], "end": end[order].astype("<u4"),
    }
    return _batch(1, _doc_bucket(columns["doc"], columns["text"], buckets), columns)


def _documents(docs: DataFrame, *extra: Column) -> DataFrame:
    """doc_id (null as the smallest integer), text hash and bytes, then ``extra``."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"),
        F.shiftrightunsigned(F.xxhash64(text), 32).alias("hash"),
        text.cast("binary").alias("text"),
        *extra,
    )


def _asked(documents: DataFrame, buckets: int) -> DataFrame:
    def parse(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {k: [] for k in ASK}

        def flush():
            x, _, region = _firsts(
                {k: np.concatenate(v).astype(d) for (k, v), d in zip(held.items(), ASK.values(), strict=True)}
            )
            for v in held.values():
                v.clear()
            if not region.all():
                yield _gone(x, ~region, buckets)
            x = {k: c[region] for k, c in x.items()}
            order = np.lexsort((x["s"], x["doc"]))
            x = {k: c[order] for k, c in x.items()}
            yield _batch(0, (x["h"] % np.uint64(buckets)).astype(np.int64), x)

        size = 0
        for frame in frames:
            doc, hashed = frame.column(0).to_numpy(), frame.column(1).to_numpy()
            for i, text in enumerate(frame.column(2)):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                for at in range(0, len(data) - LENGTH + 1, SEGMENT - LENGTH + 1):
                    h, r, first, last, anchor = regions(data[at : at + SEGMENT])
                    n = len(h)
                    for k, c in (
                        ("h", h), ("r", r), ("doc", np.full(n, doc[i])), ("text", np.full(n, hashed[i])),
                        ("s", first + at), ("e", last - first), ("a", anchor - first),
                    ):
                        held[k].append(c)
                size += len(data)
                if size >= FLUSH and held["h"]:
                    yield from flush()
                    size = 0
        if held["h"]:
            yield from flush()

    return documents.mapInArrow(parse, ROWS)


def _resolved(asked: DataFrame, buckets: int) -> DataFrame:
    """Regions that occur earlier (kind 1) and those to look at closely (kind 2)."""

    def resolve(some: pa.Table) -> pa.Table:
        kind = some["kind"].to_numpy()
        out = [some.filter(pa.array(kind == 1))]
        blobs = [b.as_py() for b in some.filter(pa.array(kind == 0))["data"]]
        if blobs:
            x, gram, region = _firsts(_unpack(blobs, **ASK))
            if not region.all():
                out.append(pa.Table.from_batches([_gone(x, ~region, buckets)]))
            group = np.cumsum(gram) - 1
            open_ = region & (np.bincount(group, region)[group] > 1)
            if open_.any():
                part = {k: x[k][open_] for k in NEED}
                bucket = _doc_bucket(part["doc"], part["text"], buckets)
                out.append(pa.Table.from_batches([_batch(2, bucket, part)]))
        return pa.concat_tables([t.cast(schema) for t in out])

    schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("data", pa.binary())])
    return asked.groupBy("bucket").applyInArrow(resolve, ROWS)


def _sides(h: int, data: bytes, s: int, e: int, a: int):
    """Both halves of a region: strings that reach far to the left, and to the right.

    A string covers either half of the bytes it can have on the left of its anchor or
    half of those on the right, and meets others in the group of those bytes.
    """
    if a >= HALF:
        last = min(e, a - HALF)
        core = data[s + a - HALF : s + a + GRAM]
        yield 0, core, s, last
    if e >= a - HALF + 1:
        first = max(0, a - HALF + 1)
        core = data[s + a : s + a + GRAM + HALF]
        yield 1, core, s + first, e - first


def _contents(documents: DataFrame, needs: DataFrame, buckets: int) -> DataFrame:
    """The bytes of the regions, by anchor and neighbouring bytes."""
    schema = pa.schema(
        [
            ("bucket", pa.int32()), ("key", pa.int64()), ("doc", pa.int64()), ("hash", pa.int64()),
            ("s", pa.int64()), ("content", pa.binary()),
        ]
    )

    def fetch(some: pa.Table, wanted: pa.Table) -> pa.Table:
        x = _unpack([b.as_py() for b in wanted["data"]], **NEED)
        where = {
            k: i for i, k in enumerate(zip(some["doc"].to_pylist(), some["hash"].to_pylist(), strict=True))
        }
        out: list[tuple] = []
        order = np.lexsort((x["text"], x["doc"]))
        before, data = None, b""
        for h, doc, hashed, s, e, a in zip(*(x[k][order].tolist() for k in NEED), strict=True):
            if (doc, hashed) != before:
                before, data = (doc, hashed), some["text"][where[doc, hashed]].as_py()
            for side, core, first, extent in _sides(h, data, s, e, a):
                key = int.from_bytes(hashlib.blake2b(core, digest_size=8, salt=bytes([side])).digest(), "little")
                out.append((key % buckets, key - (1 << 63), doc, hashed, first, data[first : first + extent + LENGTH]))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return (
        documents.groupBy("bucket")
        .cogroup(needs.select("bucket", "data").groupBy("bucket"))
        .applyInArrow(fetch, "bucket int, key bigint, doc bigint, hash bigint, s bigint, content binary")
    )


def _sorted_suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of what starts there, compared over ``depth`` symbols at least."""
    n, reach = len(symbols), 7
    padded = np.concatenate((symbols.astype(np.int64), np.zeros(reach, np.int64)))
    key = np.zeros(n, dtype=np.int64)
    for k in range(reach):
        key = key << 9 | padded[k : k + n]
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if reach >= depth:
            return order
        behind = np.zeros(n, dtype=np.int64)
        behind[: max(n - reach, 0)] = rank[reach:] + 1
        key = rank * (n + 1) + behind
        reach *= 2


def classes(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and for each the class of its first ``length`` symbols.

    Works on the Burrows-Wheeler transform alone. After step l the rows are cut into
    intervals of equal l-prefixes. An interval is extended backward by every symbol in
    it: the first row with that symbol leads to the row where the interval of the longer
    prefix begins, which is a cut of common prefix l. Every row leads to one cut, so all
    steps together do one extension a row; they stop at ``length`` or when nothing is new.
    """
    order = _sorted_suffixes(symbols, length + 1)
    transform = symbols[order - 1]
    by_symbol = np.argsort(transform, kind="stable")
    leads = np.empty(len(order), dtype=np.int64)
    leads[by_symbol] = np.arange(len(order))
    same = transform[by_symbol[1:]] == transform[by_symbol[:-1]]
    before = np.full(len(order), -1)
    before[by_symbol[1:]] = np.where(same, by_symbol[:-1], -1)
    cut = np.zeros(len(order), dtype=bool)
    cut[:1] = True
    open_ = np.arange(len(order))
    for _ in range(length):
        interval = np.cumsum(cut)
        fresh = (before[open_] < 0) | (interval[before[open_]] != interval[open_])
        if not fresh.any():
            break
        cut[leads[open_[fresh]]] = True
        open_ = open_[~fresh]
    return order, np.cumsum(cut) - 1


def repeated(contents: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each content, which of its strings occur earlier in it or in one before it."""
    sizes = np.array([len(c) for c in contents])
    heads = np.cumsum(sizes + 1) - sizes
    flat = np.frombuffer(b"\0" + b"\0".join(contents) + b"\0", np.uint8).astype(np.int16) + 1
    flat[0] = flat[-1] = 0
    flat[heads[1:] - 1] = 0
    order, kind = classes(flat, length)
    full = np.zeros(len(flat), dtype=bool)
    for head, size in zip(heads, sizes, strict=True):
        full[head : head + max(size - length + 1, 0)] = True
    rows = full[order]
    place, kind = order[rows], kind[rows]
    gone = np.zeros(len(flat), dtype=bool)
    if len(place):
        starts = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1])))
        least = np.minimum.reduceat(place, starts)
        gone[place] = place != np.repeat(least, np.diff(np.append(starts, len(place))))
    return [gone[h : h + max(s - length + 1, 0)] for h, s in zip(heads, sizes, strict=True)]


def _edges(contents: DataFrame, buckets: int) -> DataFrame:
    """Strings of the gathered regions that occur earlier (kind 1)."""
    schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("data", pa.binary())])

    def expand(some: pa.Table) -> pa.Table:
        key = some["key"].to_numpy()
        order = np.lexsort((some["s"].to_numpy(), some["hash"].to_numpy(), some["doc"].to_numpy(), key))
        key = key[order]
        new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.array([], bool)
        edge = np.append(np.flatnonzero(new), len(key))
        doc, hashed, s = (some[c].to_numpy()[order] for c in ("doc", "hash", "s"))
        found: list[tuple] = []

        def work(rows: list[int]):
            contents = [some["content"][int(order[i])].as_py() for i in rows]
            for i, gone in zip(rows, repeated(contents), strict=True):
                runs = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                for a, b in zip(runs[::2].tolist(), runs[1::2].tolist(), strict=True):
                    found.append((doc[i], hashed[i], s[i] + a, s[i] + b - 1 + LENGTH))

        rows: list[int] = []
        size = 0
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            if b - a > 1:
                rows.extend(range(a, b))
                size += (b - a) * LENGTH
                if size >= CHUNK:
                    work(rows)
                    rows, size = [], 0
        if rows:
            work(rows)
        if not found:
            return schema.empty_table()
        columns = {
            k: np.array(c).astype(d) for (k, d), c in zip(GONE.items(), zip(*found, strict=True), strict=True)
        }
        batch = _batch(1, _doc_bucket(columns["doc"], columns["text"], buckets), columns)
        return pa.Table.from_batches([batch]).cast(schema)

    return contents.groupBy("bucket").applyInArrow(expand, ROWS)


def _cut(documents: DataFrame, gone: DataFrame) -> DataFrame:
    """doc, number of bytes, removed bytes and runs, and what is left."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
            ("n_spans", pa.int64()), ("kept", pa.binary()), ("row", pa.int64()),
        ]
    )
    fields = ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'bigint'}" for f in schema)

    def cut(some: pa.Table, removed: pa.Table) -> pa.Table:
        x = _unpack([b.as_py() for b in removed["data"]], **GONE)
        order = np.lexsort((x["s"], x["text"], x["doc"]))
        doc, text, s, end = (x[k][order] for k in GONE)
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])
        edge = np.append(np.flatnonzero(new), len(doc))
        where = {
            (int(doc[a]), int(text[a])): (a, b) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)
        }
        out: list[list] = [[] for _ in schema]
        for d, h, row, value in zip(
            some["doc"].to_pylist(), some["hash"].to_pylist(), some["row"].to_pylist(), some["text"], strict=True
        ):
            data = value.as_py()
            kept, spans, at = [], 0, 0
            a, b = where.get((d, h), (0, 0))
            if a < b:
                ends = np.maximum.accumulate(end[a:b].astype(np.int64))
                opens = np.flatnonzero(np.concatenate(([True], s[a:b][1:] > ends[:-1])))
                closes = np.append(opens[1:] - 1, b - a - 1)
                for lo, hi in zip(s[a:b][opens].tolist(), ends[closes].tolist(), strict=True):
                    kept.append(data[at:lo])
                    at, spans = hi, spans + 1
            kept.append(data[at:])
            left = b"".join(kept)
            for column, v in zip(
                out, (None if d == -(1 << 63) else d, len(data), len(data) - len(left), spans, left, row), strict=True
            ):
                column.append(v)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return (
        documents.groupBy("bucket").cogroup(gone.select("bucket", "data").groupBy("bucket")).applyInArrow(cut, fields)
    )


def without_repeats(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, ``kept`` (bytes) and row of every row.

    Removes each byte that a 100-byte string covers which also starts earlier: in a
    smaller doc_id, or earlier in the same document; strings never cross documents and
    are judged on the input. Null doc_ids come first, documents of equal doc_id in the
    order of a hash of their texts; repeated rows of one doc_id and text are one document
    and get the same result. Null texts are empty. Texts below 100 bytes stay whole.
    Texts of 4 GiB and more are not possible in a row. ``row`` is the number that the
    scan gives to the row, so ``docs`` must come from files.
    """
    spark = ready(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(BUCKETS, -(-total // BUCKET_BYTES)) | 1
    documents = _documents(docs)
    resolved = stage(_resolved(_asked(documents, buckets), buckets), "repeats")
    mixed = F.col("doc").bitwiseXOR(F.shiftright("doc", 17)).bitwiseXOR(F.col("hash"))
    bucket = F.pmod(mixed, F.lit(buckets)).cast("int").alias("bucket")
    dealt = _documents(docs, row_number(row).alias("row")).select("*", bucket).repartition(tasks(spark), "bucket")
    edges = _edges(_contents(dealt, resolved.filter("kind = 2"), buckets), buckets)
    gone = resolved.filter("kind = 1").unionByName(edges)
    return _cut(dealt, gone)


def digest(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with what is left of their texts, in the columns of ``docs``.

    Bytes of a character that was cut in two go as well. Documents of which nothing but
    white space is left are dropped; ``n_chars``, where it is a column, is counted anew.
    """

    def decoded(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            texts = [str(memoryview(v.as_buffer()), "utf-8", "ignore") for v in frame.column(1)]
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(texts, pa.string())], ["_row", "_left"])

    docs, row = numbered(docs)
    text = "_left"
    while text in docs.columns:
        text = "_" + text
    left = without_repeats(docs, row).select("row", "kept").mapInArrow(decoded, "_row bigint, _left string")
    left = left.select(F.col("_row").alias(row), F.col("_left").alias(text))
    left = left.filter(F.trim(F.translate(text, "\t\n\r\f\v", "     ")) != "")
    columns = [
        F.col(text).alias(c) if c == "text"
        else F.length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col(c)
        for c in docs.columns
        if c != row
    ]
    return docs.drop("text").join(left, row).select(columns)
