"""Quality by perplexity: interpolated modified Kneser-Ney over bytes.

The model is trained on trusted documents. All its tables are joins and sums of n-gram
counts; documents are scored by joining what n-grams each chunk of documents has with
the model, in shards of n-grams, so no task holds the whole model. A document is kept
unless its perplexity lies beyond a fence made of quantiles of the trusted documents of
its language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.common import numbered, picked, ready, row_number, stage
from headway.operators.skew import lookup

ORDER = 5
SHARDS = 128
CHUNK_BITS = 12  # 4,096 consecutive rows of a scan's task are scored together
CHUNKS_A_SHARD = 512  # chunks that one copy of a model shard serves
PAD = b"\x02" * (ORDER - 1)
BINS = 512  # steps in one nat of the quantiles' histogram
FOLDS = 5  # one fold of the trusted documents is not trained on, but measured for the fences
MIDDLE, UPPER, REACH = 0.5, 0.95, 8.0  # fence: upper + reach * (upper - middle)
PRIOR = 64  # bytes of middle perplexity that are added to a document before it is judged
LEAST = 20  # trusted documents that a language needs for a fence of its own
BLOCK = 1 << 20


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all n-grams of highest order that end at the texts' bytes; bytes per text.

    A key is the n-gram's bytes as a number behind a leading 1, so every order has keys
    of its own.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    flat = np.frombuffer(b"".join([PAD + r for r in raw]), np.uint8).astype(np.int64)
    key = np.full(max(len(flat) - ORDER + 1, 0), 1, dtype=np.int64)
    for k in range(ORDER):
        key = key << 8 | flat[k : k + len(key)]
    inside = np.ones(len(flat), dtype=bool)
    heads = np.cumsum(sizes + ORDER - 1) - sizes - ORDER + 1
    for k in range(ORDER - 1):
        inside[heads + k] = False
    return key[inside[ORDER - 1 :]], sizes


def _slices(texts: pa.Array | pa.ChunkedArray) -> Iterator[list]:
    """The texts in lists of about one block of bytes; a longer text makes a list alone."""
    held, size = [], 0
    for at in range(0, len(texts), 64):
        for text in texts.slice(at, 64).to_pylist():
            held.append(text)
            size += len(text or "")
            if size >= BLOCK:
                yield held
                held, size = [], 0
    if held:
        yield held


def _packed(values: np.ndarray) -> bytes:
    """Numbers as bytes for a shuffle: bytes of one place lie next to each other, then zstd."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes, dtype: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _shard(context: np.ndarray) -> np.ndarray:
    """Shard of n-grams by the last two bytes of their context."""
    return (context & 0xFFFF) * 40503 % 65521 % SHARDS


def _shard_column(context: Column) -> Column:
    return (context.bitwiseAND(F.lit(0xFFFF)) * 40503 % 65521 % SHARDS).cast("int")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled good and not toxic, and whether their fold is held out."""
    good = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    return good.select("doc_id", held_out.alias("held_out")).distinct()


def only(docs: DataFrame, ids: DataFrame, row: str | None = None) -> DataFrame:
    """The texts of all rows of ``docs`` whose doc_id is among ``ids``, without a shuffle of texts.

    Numbers and ids alone are joined; the rows found go to the texts as one bit each
    (:func:`picked`). Both scans belong to one plan, so their numbers agree.
    """
    numbers = docs.select("doc_id", row_number(row).alias("_n")).join(ids, "doc_id", "left_semi")
    return picked(docs.select(row_number(row).alias("_n"), "text"), numbers, "_n")


def counts(docs: DataFrame) -> DataFrame:
    """``key`` and ``c`` of the n-grams of highest order."""
    ready(docs.sparkSession)

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.array([], np.int64), np.array([], np.int64)
        for frame in frames:
            for texts in _slices(frame.column(0)):
                new, n = np.unique(_grams(texts)[0], return_counts=True)
                both = np.concatenate((keys, new))
                keys, at = np.unique(both, return_inverse=True)
                sums = np.bincount(at, np.concatenate((sums, n)), len(keys)).astype(np.int64)
                if len(keys) > 4 * BLOCK:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["key", "c"])
                    keys, sums = keys[:0], sums[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["key", "c"])

    return (
        docs.select("text")
        .mapInArrow(count, "key bigint, c bigint")
        .groupBy("key")
        .agg(F.sum("c").alias("c"))
    )


def _discounts(grams: DataFrame) -> list[float]:
    """Discounts of counts 1, 2 and above, from the numbers of n-grams seen 1 to 4 times.

    Where these give no discount above 0, as few n-grams of a low order may, a context
    could be left without mass for unseen bytes: then fixed discounts serve.
    """
    n = grams.agg(*[F.count(F.when(F.col("c") == k, 1)) for k in range(1, 5)]).first()
    if all(n):
        y = n[0] / (n[0] + 2 * n[1])
        found = [k - (k + 1) * y * n[k] / n[k - 1] for k in range(1, 4)]
        if min(found) > 0:
            return found
    return [0.5, 1.0, 1.5]


def train(docs: DataFrame) -> DataFrame:
    """The model: ``kind`` 0 log probabilities of n-grams, 1 log back-off weights of
    contexts; ``key``, ``value``, ``shard`` (null where every shard needs the row)."""
    tables = {ORDER: stage(counts(docs), "kneser")}
    for n in range(ORDER - 1, 0, -1):
        top = 1 << 8 * n
        suffix = F.col("key").bitwiseAND(F.lit(top - 1)).bitwiseOR(F.lit(top))
        tables[n] = stage(
            tables[n + 1].groupBy(suffix.alias("key")).agg(F.count(F.lit(1)).alias("c")), "kneser"
        )
    lower, parts = None, []
    for n in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(tables[n])
        c = F.col("c")
        grams = tables[n].withColumn("h", F.shiftright("key", 8))
        contexts = grams.groupBy("h").agg(
            F.sum("c").alias("total"),
            F.sum(F.when(c == 1, d1).when(c == 2, d2).otherwise(d3)).alias("mass"),
        )
        off = F.when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        joined = grams.join(contexts, "h")
        if n == 1:
            below = F.lit(1 / 256)
        else:
            top = 1 << 8 * (n - 1)
            joined = joined.withColumn(
                "s", F.col("key").bitwiseAND(F.lit(top - 1)).bitwiseOR(F.lit(top))
            ).join(lower.select(F.col("key").alias("s"), F.col("p").alias("below")), "s")
            below = F.col("below")
        lower = stage(
            joined.select("key", ((c - off + F.col("mass") * below) / F.col("total")).alias("p")),
            "kneser",
        )
        wide = n >= 3
        parts.append(
            lower.select(
                F.lit(0).alias("kind"),
                "key",
                F.log("p").alias("value"),
                (_shard_column(F.shiftright("key", 8)) if wide else F.lit(None).cast("int")).alias("shard"),
            )
        )
        parts.append(
            contexts.select(
                F.lit(1).alias("kind"),
                F.col("h").alias("key"),
                F.log(F.col("mass") / F.col("total")).alias("value"),
                (_shard_column(F.col("h")) if wide else F.lit(None).cast("int")).alias("shard"),
            )
        )
    model = parts[0]
    for part in parts[1:]:
        model = model.unionByName(part)
    return stage(model, "kneser")


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def log_probabilities(wanted: np.ndarray, grams: tuple, contexts: tuple) -> np.ndarray:
    """Log probability of each n-gram's last byte behind the bytes before it."""
    weight = np.zeros(len(wanted))
    out = np.full(len(wanted), np.nan)
    for n in range(ORDER, 0, -1):
        top = 1 << 8 * n
        key = wanted & (top - 1) | top
        found = _find(*grams, key, np.nan)
        out = np.where(np.isnan(out), found + weight, out)
        weight = weight + _find(*contexts, key >> 8, 0.0)
    return np.where(np.isnan(out), weight - math.log(256), out)


def _unique(texts) -> np.ndarray:
    keys = np.array([], np.int64)
    for part in _slices(texts):
        keys = np.union1d(keys, _grams(part)[0])
    return keys


def scores(docs: DataFrame, model: DataFrame, row_column: str | None = None) -> DataFrame:
    """doc_id, row, lang, n_bytes and ``nll`` (nats a byte; null for empty texts)."""
    spark = ready(docs.sparkSession)
    row = row_number(row_column)
    rows = docs.select(
        F.shiftright(row, CHUNK_BITS).alias("chunk"), "doc_id", row.alias("row"), "lang", "text"
    )
    chunks = rows.select("chunk").distinct().count()
    copies = -(-chunks // CHUNKS_A_SHARD) or 1

    def ask(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def asked(chunk: int, texts: list) -> pa.RecordBatch:
            keys = _unique(pa.chunked_array(texts))
            shard = _shard(keys >> 8)
            order = np.argsort(shard, kind="stable")
            used, starts = np.unique(shard[order], return_index=True)
            parts = np.split(keys[order], starts[1:]) if len(used) else []
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), chunk)),
                    pa.array(used.astype(np.int32)),
                    pa.array([_packed(np.diff(p, prepend=0)) for p in parts], pa.binary()),
                ],
                ["chunk", "shard", "keys"],
            )

        now, held = None, []
        for frame in frames:
            # A task may read files in any order: runs of one chunk, not sorted chunks.
            chunk = frame.column(0).to_numpy()
            runs = np.flatnonzero(np.diff(chunk, prepend=chunk[:1] - 1, append=chunk[-1:] + 1))
            for lo, hi in pairwise(runs.tolist()):
                c = int(chunk[lo])
                if c != now and held:
                    yield asked(now, held)
                    held = []
                now = c
                held.append(frame.column(1).slice(lo, hi - lo))
        if held:
            yield asked(now, held)

    salt = F.pmod(F.xxhash64("chunk"), F.lit(copies)).cast("int")
    wanted = (
        rows.select("chunk", "text")
        .mapInArrow(ask, "chunk bigint, shard int, keys binary")
        .withColumn("copy", salt)
    )
    every = F.sequence(F.lit(0), F.lit(SHARDS - 1))
    dealt = model.select(
        "kind",
        "key",
        "value",
        F.explode(F.when(F.col("shard").isNull(), every).otherwise(F.array("shard"))).alias("shard"),
    ).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        kind, key, value = (known[c].to_numpy() for c in ("kind", "key", "value"))
        order = np.argsort(key)
        kind, key, value = kind[order], key[order], value[order]
        tables = [(key[kind == k], value[kind == k]) for k in (0, 1)]
        # A chunk whose file was cut into splits asks once a split: it is answered once, for all its keys.
        parts: dict[int, list[bytes]] = {}
        for chunk, keys in zip(asked["chunk"].to_pylist(), asked["keys"].to_pylist(), strict=True):
            parts.setdefault(chunk, []).append(keys)
        out = []
        for some in parts.values():
            keys = reduce(np.union1d, [np.cumsum(_unpacked(k, "<i8")) for k in some])
            out.append(_packed(log_probabilities(keys, *tables).astype("<f4")))
        return pa.table(
            [
                pa.array(list(parts), pa.int64()),
                asked["shard"].slice(0, len(parts)),
                pa.array(out, pa.binary()),
            ],
            ["chunk", "shard", "values"],
        )

    answers = (
        wanted.groupBy("shard", "copy")
        .cogroup(dealt.groupBy("shard", "copy"))
        .applyInArrow(answer, "chunk bigint, shard int, values binary")
    )

    def score(some: pa.Table, known: pa.Table) -> pa.Table:
        keys = _unique(some["text"])
        shard = _shard(keys >> 8)
        value = np.zeros(len(keys))
        for s, v in zip(known["shard"].to_pylist(), known["values"].to_pylist(), strict=True):
            value[shard == s] = _unpacked(v, "<f4")
        sizes, sums = [], []
        for texts in _slices(some["text"]):
            grams, size = _grams(texts)
            ends = np.concatenate(([0.0], np.cumsum(value[np.searchsorted(keys, grams)])))
            at = np.concatenate(([0], np.cumsum(size)))
            sizes.append(size)
            sums.append(ends[at[1:]] - ends[at[:-1]])
        size = np.concatenate(sizes) if sizes else np.array([], np.int64)
        total = np.concatenate(sums) if sums else np.array([], float)
        nll = -total / np.maximum(size, 1)
        return pa.table(
            [
                some["doc_id"], some["row"], some["lang"], pa.array(size),
                pa.array(nll, pa.float64(), mask=size == 0),
            ],
            ["doc_id", "row", "lang", "n_bytes", "nll"],
        )

    return (
        rows.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(score, "doc_id bigint, row bigint, lang string, n_bytes bigint, nll double")
    )


def _fences(trusted: DataFrame) -> DataFrame:
    """``lang``, ``middle`` and ``fence`` from quantiles of ``nll``; the pooled fence has lang null."""
    bins = trusted.groupBy(
        F.coalesce("lang", F.lit("")).alias("lang"), F.ceil(F.col("nll") * BINS).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    pooled = bins.groupBy("bin").agg(F.sum("n").alias("n")).select(
        F.lit(None).cast("string").alias("lang"), "bin", "n"
    )
    by = Window.partitionBy("lang")
    shares = bins.unionByName(pooled).select(
        "lang",
        "bin",
        F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(by).alias("all"),
    )

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("bin"))) / BINS

    return (
        shares.groupBy("lang")
        .agg(F.max("all").alias("n"), quantile(MIDDLE).alias("middle"), quantile(UPPER).alias("upper"))
        .filter((F.col("n") >= LEAST) | F.col("lang").isNull())
        .select(
            "lang",
            "middle",
            (F.col("upper") + REACH * (F.col("upper") - F.col("middle"))).alias("fence"),
        )
    )


def classify(docs: DataFrame, labels: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, row, lang, n_bytes, perplexity (a byte), threshold and ``keep`` of every row.

    Trained on all documents that ``labels`` calls good and not toxic but for one fold of
    five; the fences come from that fold, all of it. A document is kept if its perplexity
    - drawn to the language's middle one as 64 more bytes would, for short texts say
    little - is no higher than its language's
    fence; languages with few trusted documents, and null ones, use the fence of all. Without
    any trusted document everything with text is kept. Empty and null texts have no
    perplexity and are not kept. Repeated rows are judged alike; long texts are read
    whole. ``docs`` must come from files: its rows are numbered by the scan.
    """
    spark = ready(docs.sparkSession)
    trusted = stage(trusted_ids(labels), "kneser")
    model = train(only(docs, trusted.filter("not held_out").select("doc_id"), row))
    scored = stage(scores(docs, model, row), "kneser")
    measured = scored.filter("nll is not null").join(trusted.filter("held_out"), "doc_id", "left_semi")
    fences = stage(_fences(measured), "kneser")
    pooled = fences.filter("lang is null").first()
    middle, fence = (0.0, float("inf")) if pooled is None else (pooled["middle"], pooled["fence"])
    own = fences.filter("lang is not null").withColumnRenamed("lang", "_lang")
    middle, fence = F.coalesce("middle", F.lit(middle)), F.coalesce("fence", F.lit(fence))
    judged = (F.col("nll") * F.col("n_bytes") + PRIOR * middle) / (F.col("n_bytes") + PRIOR)
    return lookup(scored.withColumn("_lang", F.coalesce("lang", F.lit(""))), own, ["_lang"]).select(
        "doc_id",
        "row",
        "lang",
        "n_bytes",
        F.exp("nll").alias("perplexity"),
        F.exp(fence).alias("threshold"),
        F.coalesce(judged <= fence, F.lit(False)).alias("keep"),
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return classify(docs, labels).drop("row")


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`classify` keeps, all columns as they are."""
    docs, row = numbered(docs)
    rows = stage(classify(docs, labels, row).filter("keep").select(F.col("row").alias(row)), "kneser")
    return picked(docs, rows, row)
