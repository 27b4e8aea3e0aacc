"""Token output as wavelet matrices.

A file holds the tokens of consecutive documents as bit-planes, the highest bit
first; behind each plane the tokens with a 0 there go before those with a 1. Counts
of ones in front of every 512 bits give rank and select, so any token can be read,
counted and located without decoding the file.

File layout, little-endian: ``WVMX``, version, tokens, planes, documents (u32 each),
length of the packed body (u64), then the zstd-packed body: document ids (i64),
document starts in the file (u64, one more than documents), zeros per plane (u64),
the planes (packed bits, padded to 64 bytes), the counts (u32 per 64 bytes and plane).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import bases, partition_id, ranged, ready, stage
from headway.llm.tokens import encoding

MAGIC = b"WVMX"
HEAD = struct.Struct("<4sIIIIQ")
BLOCK = 512  # bits between two counts
FILE_TOKENS = 1 << 20  # a file is closed once it holds so many
PART = 1 << 15  # tokens that are dealt at once: they and their places stay in a core's cache


def _parts(ones: np.ndarray, zeros: int) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """For each part of a plane: its start, where its zeros and its ones go, and their places in it."""
    low, high = 0, zeros
    for at in range(0, len(ones), PART):
        part = ones[at : at + PART]
        lows, highs = np.flatnonzero(~part), np.flatnonzero(part)
        yield at, low, high, lows, highs
        low, high = low + len(lows), high + len(highs)


def build(ids: np.ndarray, doc_ids: np.ndarray, starts: np.ndarray, planes: int = 16) -> bytes:
    """The file of these tokens; ``starts`` has one entry more than ``doc_ids``."""
    n = len(ids)
    blocks = -(-n // BLOCK) or 1
    level, after = ids.astype(np.uint16, copy=True), np.empty(n, dtype=np.uint16)
    zeros = np.zeros(planes, dtype="<u8")
    bits = np.zeros((planes, blocks * BLOCK // 8), dtype=np.uint8)
    for plane in range(planes):
        ones = level & np.uint16(1 << (planes - 1 - plane)) != 0
        packed = np.packbits(ones, bitorder="little")
        bits[plane, : len(packed)] = packed
        zeros[plane] = n - np.count_nonzero(ones)
        for at, low, high, lows, highs in _parts(ones, int(zeros[plane])):
            part = level[at : at + PART]
            part.take(lows, out=after[low : low + len(lows)], mode="clip")
            part.take(highs, out=after[high : high + len(highs)], mode="clip")
        level, after = after, level
    counts = np.bitwise_count(bits).reshape(planes, blocks, BLOCK // 8).sum(axis=2, dtype=np.int64)
    before = (np.cumsum(counts, axis=1) - counts).astype("<u4")
    body = b"".join(
        x.tobytes() for x in (doc_ids.astype("<i8"), starts.astype("<u8"), zeros, bits, before)
    )
    packed = zstandard.ZstdCompressor(level=1).compress(body)
    return HEAD.pack(MAGIC, 1, n, planes, len(doc_ids), len(packed)) + packed


class WaveletFile:
    """Reads one file: ``access``, ``rank``, ``count``, ``select``, ``decode``."""

    def __init__(self, data: bytes):
        magic, version, self.n, self.planes, docs, size = HEAD.unpack_from(data)
        if magic != MAGIC or version != 1:
            raise ValueError("not a wavelet token file")
        body = zstandard.ZstdDecompressor().decompress(data[HEAD.size : HEAD.size + size])
        blocks = -(-self.n // BLOCK) or 1
        at = 0

        def take(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, dtype, count, at)
            at += out.nbytes
            return out

        self.doc_ids = take("<i8", docs)
        self.starts = take("<u8", docs + 1).astype(np.int64)
        self.zeros = take("<u8", self.planes).astype(np.int64)
        self.bits = take("u1", self.planes * blocks * BLOCK // 8).reshape(self.planes, -1)
        self.before = take("<u4", self.planes * blocks).reshape(self.planes, -1)

    def _ones(self, plane: int, at: int) -> int:
        """Ones of a plane in front of bit ``at``."""
        block, rest = divmod(at, BLOCK)
        if block == self.before.shape[1]:
            return self.n - int(self.zeros[plane])
        first = block * (BLOCK // 8)
        full = self.bits[plane, first : first + rest // 8]
        out = int(self.before[plane, block]) + int(np.bitwise_count(full).sum())
        if rest % 8:
            out += (int(self.bits[plane, first + rest // 8]) & ((1 << rest % 8) - 1)).bit_count()
        return out

    def _bit(self, plane: int, at: int) -> int:
        return int(self.bits[plane, at // 8]) >> (at % 8) & 1

    def _down(self, plane: int, bit: int, at: int) -> int:
        ones = self._ones(plane, at)
        return int(self.zeros[plane]) + ones if bit else at - ones

    def access(self, at: int) -> int:
        """The token at a place of the file."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        token = 0
        for plane in range(self.planes):
            bit = self._bit(plane, at)
            at = self._down(plane, bit, at)
            token = token << 1 | bit
        return token

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for plane in range(self.planes):
            bit = token >> (self.planes - 1 - plane) & 1
            lo, hi = self._down(plane, bit, lo), self._down(plane, bit, hi)
        return lo, hi

    def rank(self, token: int, at: int) -> int:
        """Occurrences of the token in front of a place."""
        lo, hi = self._range(token, 0, at)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select_bit(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of this value in a plane."""
        before = self.before[plane].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        part = self.bits[plane, block * (BLOCK // 8) : (block + 1) * (BLOCK // 8)]
        places = np.flatnonzero(np.unpackbits(part, bitorder="little") == bit)
        return block * BLOCK + int(places[k - int(before[block])])

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of the token."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        at = lo + k
        for plane in reversed(range(self.planes)):
            bit = token >> (self.planes - 1 - plane) & 1
            at = self._select_bit(plane, bit, at - int(self.zeros[plane]) if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """All tokens in order: the planes undone from the last to the first."""
        level = np.zeros(self.n, dtype=np.uint16)
        for plane in reversed(range(self.planes)):
            ones = np.unpackbits(self.bits[plane], count=self.n, bitorder="little").view(bool)
            above, bit = np.empty(self.n, dtype=np.uint16), np.uint16(1 << (self.planes - 1 - plane))
            for at, low, high, lows, highs in _parts(ones, int(self.zeros[plane])):
                part = above[at : at + PART]
                part[lows] = level[low : low + len(lows)]
                part[highs] = level[high : high + len(highs)] | bit
            level = above
        return level


def write(
    docs: DataFrame, label: str = "wavelet", end: int = 0, path: str | None = None,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Tokenise ``docs`` and write wavelet files in ascending doc_id order.

    The files go out through Spark's writer, so they can lie in any store it knows: a
    row (``pid``, ``file``, ``before``, ``tokens``, ``data``) is one whole file. ``pid`` and
    ``file`` give their order, ``before`` counts the tokens of the partition's files so far. Documents with equal ids stay next to each other, in the order of
    a hash of their texts; a null doc_id goes first and is kept as the smallest 64-bit integer.
    No row is left out; a null or empty text is a document of the closing id alone. A
    file ends with the document that fills it.
    """
    ready(docs.sparkSession)
    # texts are put in order before they are tokenised: a range shuffle looks at its rows twice
    ordered = ranged(
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie")), "doc_id", "tie"
    )
    rows, encode = encoding(ordered, ["doc_id"], end, path)

    def files(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, file, before, held, ids, size = partition_id(), 0, 0, [], [], 0

        def close() -> pa.RecordBatch:
            starts = np.cumsum([0, *map(len, ids)]) // 2
            data = build(
                np.frombuffer(b"".join(ids), "<u2"), np.array(held, np.int64), starts
            )
            return pa.RecordBatch.from_pydict(
                {
                    "pid": [pid],
                    "file": [file],
                    "before": [before],
                    "tokens": [int(starts[-1])],
                    "data": [data],
                },
                schema=schema,
            )

        schema = pa.schema(
            [
                ("pid", pa.int32()),
                ("file", pa.int32()),
                ("before", pa.int64()),
                ("tokens", pa.int64()),
                ("data", pa.binary()),
            ]
        )
        for frame in encode(frames):
            for doc, tokens in zip(
                frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True
            ):
                held.append(-(1 << 63) if doc is None else doc)
                ids.append(tokens)
                size += len(tokens) // 2
                if size >= file_tokens:
                    yield close()
                    before += size
                    file, held, ids, size = file + 1, [], [], 0
        if held:
            yield close()

    out = rows.mapInArrow(files, "pid int, file int, before bigint, tokens bigint, data binary")
    return stage(out, label)


def read(files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, ``pid``, its ``start`` in that partition,
    ``n_tokens`` and ``ids_crc32`` of its ids as 32-bit integers."""
    ready(files.sparkSession)

    def documents(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for pid, file, before, data in zip(
                *(frame.column(i).to_pylist() for i in range(4)), strict=True
            ):
                one = WaveletFile(data)
                wide, cut = one.decode().astype("<u4"), one.starts
                view = memoryview(wide.tobytes())
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                least = -(1 << 63)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None if d == least else d for d in one.doc_ids.tolist()], pa.int64()),
                        pa.array([pid] * len(crc), pa.int32()),
                        pa.array([file] * len(crc), pa.int32()),
                        pa.array(before + cut[:-1], pa.int64()),
                        pa.array(np.diff(cut), pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "pid", "file", "at", "n_tokens", "ids_crc32"],
                )

    return files.select("pid", "file", "before", "data").mapInArrow(
        documents, "doc_id bigint, pid int, file int, at bigint, n_tokens bigint, ids_crc32 bigint"
    )


def digest(docs: DataFrame) -> DataFrame:
    """Write the files, read them back, and place every document in the whole output."""
    files = write(docs)
    first = bases(files.select("pid", "tokens"), {"first": "tokens"}).select("pid", "first")
    return read(files).join(F.broadcast(first), "pid").select(
        "doc_id",
        (F.col("first") + F.col("at")).alias("start"),
        "n_tokens",
        "ids_crc32",
        "pid",
        "file",
    )
