"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of its documents' tokens in doc_id order. Every window takes
from each queue the tokens that it owes: after w windows a queue with rate r has given
the rounded share of w windows, and the rounding - the deficit, below one token or the
few that ties decide - goes into the next window. What a queue has given by window w
follows from w alone (token i of a queue with rate r is due at ``(i + 1/2) / r``, and a
window takes the 2048 tokens due next), so any partition can start at any window with
the deficits that the windows before it have left, and nothing runs in sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import bases, partition_id, ranged, ready, stage
from headway.llm.tokens import encoding

QUEUES = 64  # sources beyond the largest ones share the last queue


class Schedule:
    """What every queue has given after any number of tokens."""

    def __init__(self, tokens: np.ndarray, rates: np.ndarray, length: int):
        self.tokens, self.rates, self.length = tokens.astype(np.int64), rates, length
        self.total = int(self.tokens.sum())
        self.windows = -(-self.total // length)
        self.natural = bool(np.all(rates == self.tokens))

    def due(self, time: np.ndarray) -> np.ndarray:
        """Tokens of each queue (columns) due before each time (rows)."""
        given = np.floor(time[:, None] * self.rates + 0.5)
        return np.minimum(given, self.tokens).astype(np.int64)

    def given(self, windows: np.ndarray) -> np.ndarray:
        """Tokens that each queue (columns) has given before each window (rows)."""
        target = np.minimum(windows * self.length, self.total)
        if self.natural:
            slack = len(self.tokens) / 2 + 2
            low = np.maximum(target - slack, 0) / self.total
            high = (target + slack) / self.total
        else:
            low = np.zeros(len(target))
            high = np.full(len(target), float(np.max((self.tokens + 1) / self.rates)))
        while True:
            middle = (low + high) / 2
            inside = (middle > low) & (middle < high)
            if not inside.any():
                break
            below = self.due(middle).sum(axis=1) <= target
            low = np.where(inside & below, middle, low)
            high = np.where(inside & ~below, middle, high)
        at_low = self.due(low)
        room = self.due(high) - at_low
        rest = (target - at_low.sum(axis=1))[:, None]
        taken = np.minimum(np.cumsum(room, axis=1), rest)
        return at_low + np.diff(taken, axis=1, prepend=0)

    def near(self, queue: int, tokens: np.ndarray) -> np.ndarray:
        """A window at most two away from the one that takes each token of the queue."""
        return self.due((tokens + 0.5) / self.rates[queue]).sum(axis=1) // self.length

    def spans(self, queue: int, begin: int, end: int) -> tuple[np.ndarray, ...]:
        """Windows that take tokens [begin, end) of a queue: id, first, last, offset."""
        share = self.length * self.rates[queue] / self.rates.sum()
        if share >= 1:
            first, last = self.near(queue, np.array([begin, end - 1]))
            windows = np.arange(max(first - 2, 0), min(last + 4, self.windows + 1))
        else:
            near = self.near(queue, np.arange(begin, end))
            windows = np.unique((near[:, None] + np.arange(-2, 4)).ravel())
            windows = windows[(windows >= 0) & (windows <= self.windows)]
        given = self.given(windows)
        follow = np.flatnonzero(np.diff(windows) == 1)
        low, high = given[follow, queue], given[follow + 1, queue]
        offset = (given[follow + 1, :queue] - given[follow, :queue]).sum(axis=1)
        used = (high > low) & (high > begin) & (low < end)
        return windows[follow][used], low[used], high[used], offset[used]


def _queues(docs: DataFrame, most: int) -> dict[str, int]:
    """Queue of each of the largest sources; at most ``most - 1`` if there are more."""
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("s")).count()
    rows = counts.orderBy(F.desc("count"), "s").limit(most + 1).collect()
    kept = rows if len(rows) <= most else rows[: most - 1]
    return {r["s"]: i for i, r in enumerate(sorted(kept, key=lambda r: r["s"]))}


def pack(
    docs: DataFrame, length: int = 2048, weights: Mapping[str, float] | None = None,
    end: int = 1, path: str | None = None, queues: int = QUEUES,
) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens; only the last has room left.

    ``weights`` gives target proportions by source (sources left out get the smallest
    given weight); without it they are the sources' own shares, so that all queues end
    together. A queue that has run dry leaves its share to the others. The ``queues - 1``
    largest sources have queues of their own where there are more, others share one.

    Result: doc_id, start, length, ids_crc32 (of the piece's ids as 32-bit integers),
    doc_tokens (with the closing id), sequence_id, offset, queue. A null text is a
    closing id only, a null source counts as the empty one, null doc_ids go first in
    their queue, equal doc_ids follow each other in the order of a hash of their texts.
    """
    spark = ready(docs.sparkSession)
    names = _queues(docs, queues)
    shared = len(names)
    queue = F.lit(shared)
    if names:
        known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
        queue = F.coalesce(F.element_at(known, F.coalesce("source", F.lit(""))), queue)
    # texts are put in order before they are tokenised: a range shuffle looks at its rows twice
    ordered = ranged(
        docs.select("doc_id", "text", queue.alias("queue"), F.xxhash64("text").alias("tie")),
        "queue",
        "doc_id",
        "tie",
    )
    # Tokenised and placed in one pass: a second one would hold a worker more for each task.
    rows, encode = encoding(ordered, ["doc_id", "queue"], end, path)

    def places(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, ends = partition_id(), {}
        for frame in encode(frames):
            at = []
            for q, n in zip(frame.column(1).to_pylist(), frame.column(3).to_pylist(), strict=True):
                at.append(ends.get(q, 0))
                ends[q] = at[-1] + n
            yield pa.RecordBatch.from_arrays(
                [*frame.columns, pa.array([pid] * len(at), pa.int32()), pa.array(at, pa.int64())],
                ["doc_id", "queue", "ids", "n_tokens", "pid", "at"],
            )

    local = stage(
        rows.mapInArrow(
            places, "doc_id bigint, queue int, ids binary, n_tokens bigint, pid int, at bigint"
        ),
        "packing",
    )
    base = bases(local, {"first": "n_tokens"}, ["queue"])
    totals = {r[0]: r[1] for r in base.groupBy("queue").agg(F.max("first_total")).collect()}
    tokens = np.array([totals.get(q, 0) for q in range(shared + 1)], dtype=np.int64)
    rates = tokens.astype(float)
    if weights is not None:
        least = min(weights.values())
        rates = np.array([float(weights.get(s, least)) for s in names] + [float(least)])
        if min(rates) <= 0:
            raise ValueError("weights must be positive")
    schedule = Schedule(tokens, np.where(tokens > 0, rates, 1e-9), length)
    schedule.natural = weights is None and bool(tokens.sum())
    schema = (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
        " sequence_id bigint, offset bigint, queue int"
    )
    names_out = [x.split()[0] for x in schema.split(",")]
    placed = local.join(F.broadcast(base), ["queue", "pid"]).select(
        "doc_id", "queue", "ids", "n_tokens", (F.col("first") + F.col("at")).alias("at")
    )

    def pieces(doc_ids: pa.Array, queue: int, ids: list[bytes], starts: np.ndarray):
        wide = np.frombuffer(b"".join(ids), "<u2").astype("<u4")
        view, begin = memoryview(wide.tobytes()), int(starts[0])
        end = begin + len(wide)
        windows, low, high, offset = schedule.spans(queue, begin, end)
        cuts = np.unique(np.concatenate((starts, low[low > begin])))
        sizes = np.diff(cuts, append=end)
        doc = np.searchsorted(starts, cuts, side="right") - 1
        at = np.searchsorted(low, cuts, side="right") - 1
        if np.any(cuts + sizes > high[at]):
            raise RuntimeError("a token belongs to no window")
        crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(cuts - begin, cuts - begin + sizes, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                doc_ids.take(pa.array(doc)),
                pa.array(cuts - starts[doc]),
                pa.array(sizes),
                pa.array(crc, pa.int64()),
                pa.array(np.diff(starts, append=end)[doc]),
                pa.array(windows[at]),
                pa.array(offset[at] + cuts - low[at]),
                pa.array(np.full(len(cuts), queue, np.int32)),
            ],
            names_out,
        )

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            queue, at, n = (frame.column(i).to_numpy() for i in (1, 4, 3))
            # runs of one queue without a gap, and not too long
            new = (np.diff(queue) != 0) | (at[1:] != at[:-1] + n[:-1])
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), frame.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                for lo in range(a, b, 256):
                    part = frame.slice(lo, min(256, b - lo))
                    yield pieces(
                        part.column(0), int(queue[lo]), part.column(2).to_pylist(),
                        at[lo : lo + part.num_rows],
                    )

    if not schedule.total:
        return spark.createDataFrame([], schema)
    return placed.mapInArrow(cut, schema)
