"""Filter interaction audit: what five document filters remove in every order.

Per document, one finite-state pass over the UTF-8 bytes of its text counts words,
capital letters A-Z, code points and symbol bytes, and puts each word span into a
hash table whose equal-hash entries are compared byte by byte (Arrow's), so that
distinct words are counted exactly. The pass runs over whole Arrow batches at once: the
automaton's state after a byte is a function of that byte's class, so each step is a
lookup in the transition table indexed by (class before, class now), evaluated for
all bytes of the batch together.

Exact repeats of a text (filter E) are found by a hash of the whole text, its
smallest doc_id taken per hash (combined on the map side) and looked up again with
heavy hashes split. Documents are then folded to one row per (part, failure mask),
at most 32 per part, and only those rows are expanded over the 120 filter orders.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import batches
from headway.operators.skew import lookup

# Fixed values of the contract.
FILTERS = "ABCDE"
MIN_WORDS = 100
SYMBOLS = b"#$%&*|"
ORDERS = ["".join(p) for p in permutations(FILTERS)]

#: Text bytes scanned at once; memory of the pass is about 30 times this.
SLICE_BYTES = 4 << 20

# Byte classes of the transducer.
SPACE, WORD, CAPITAL, SYMBOL, CONTINUATION = 0, 1, 2, 3, 4


def _byte_classes() -> np.ndarray:
    """Class of every byte value: white space, capital, symbol, UTF-8 continuation, other word byte."""
    table = np.full(256, WORD, dtype=np.uint8)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = SPACE
    table[ord("A") : ord("Z") + 1] = CAPITAL
    table[list(SYMBOLS)] = SYMBOL
    table[0x80:0xC0] = CONTINUATION
    return table


CLASSES = _byte_classes()
#: In a word after a byte of this class?
IN_WORD = np.array([False, True, True, True, True])
#: Transition table: (in word before, class now) -> word starts here.
STARTS = np.zeros((2, 5), dtype=bool)
STARTS[0, [WORD, CAPITAL, SYMBOL, CONTINUATION]] = True
#: (in word before, class now) -> a word ended just before this byte.
ENDS = np.zeros((2, 5), dtype=bool)
ENDS[1, SPACE] = True

def scan(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts of one batch of texts (null is empty): words, distinct, capitals, code points, symbols."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    rows = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=rows + 1, offset=texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    size = len(data)

    cls = CLASSES[data]
    now = cls != SPACE  # IN_WORD of the class
    # The state before each byte: in a word after the byte before it, never across texts.
    before = np.zeros(size, dtype=bool)
    if size:
        before[1:] = now[:-1]
        before[offsets[:-1][np.diff(offsets) > 0]] = False
    starts = STARTS[before.view(np.uint8), cls]

    def per_text(flags: np.ndarray) -> np.ndarray:
        """Set flags a text; the flags counted are rare next to bytes (positions only)."""
        at = np.flatnonzero(flags)
        return np.bincount(np.searchsorted(offsets, at, side="right") - 1, minlength=rows).astype(np.int64)

    return {
        "words": per_text(starts),
        "capitals": per_text(cls == CAPITAL),
        "code_points": np.diff(offsets) - per_text(cls == CONTINUATION),
        "symbols": per_text(cls == SYMBOL),
        "distinct": _distinct_words(data, offsets, now, starts, rows),
    }


def _distinct_words(data, offsets, now, starts, rows) -> np.ndarray:
    """Distinct words per text: word spans put into a hash table that verifies equal hashes.

    The word bytes, without the white space between them, are one contiguous buffer,
    so the spans are an Arrow binary array without copying each word; Arrow's hash
    table (dictionary encoding) compares the bytes of entries whose hashes agree.
    """
    at = np.flatnonzero(starts)
    if len(at) == 0:
        return np.zeros(rows, dtype=np.int64)
    packed = np.ascontiguousarray(data[now])
    before_start = np.cumsum(now, dtype=np.int64)[at] - 1  # place of each word in ``packed``
    bounds = np.append(before_start, len(packed)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(packed)]
    )
    encoded = pc.dictionary_encode(words)
    slot = encoded.indices.to_numpy().astype(np.int64)
    text = np.searchsorted(offsets, at, side="right") - 1
    key = np.sort(text * len(encoded.dictionary) + slot)
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    return np.bincount(key[first] // len(encoded.dictionary), minlength=rows).astype(np.int64)


def _counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Slices of about SLICE_BYTES of text: the pass keeps a few 8-byte numbers a byte.
    for table in batches(frames, SLICE_BYTES, "text"):
        batch = table.combine_chunks().to_batches()[0] if table.num_rows else None
        if batch is None:
            continue
        c = scan(batch.column("text"))
        keep = [n for n in batch.schema.names if n != "text"]
        names = ["words", "distinct", "capitals", "code_points", "symbols"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in keep], *[pa.array(c[k]) for k in names]], names=[*keep, *names]
        )


def flags(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document row: part, failure flags A-E, good, toxic.

    Null text is empty (it fails A); a null lang is the part ''. Repeated rows are
    separate documents; a repeated doc_id with the same text is not "smaller", so
    it does not fail E by its twin. A null doc_id never fails E (it has no order).
    A label counts if any of the document's label rows says 1. Every value rides
    along with its row through the byte pass: no row numbers are joined.
    """
    docs = documents.select(
        F.col("doc_id").alias("_doc"),
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("_key", F.sha2("text", 256))
    counted = docs.mapInArrow(
        _counted,
        "_doc long, part string, _key string, words long, distinct long, capitals long, "
        "code_points long, symbols long",
    )
    firsts = docs.groupBy("_key").agg(F.min("_doc").alias("_first"))
    rows = lookup(counted, firsts, ["_key"])
    marks = labels.groupBy(F.col("doc_id").alias("_doc")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    rows = lookup(rows, marks, ["_doc"])
    w = F.col("words")
    return rows.select(
        "part",
        (w < MIN_WORDS).alias("A"),
        (F.col("distinct") * 100 < w * 80).alias("B"),
        (F.col("capitals") * 100 > F.col("code_points") * 10).alias("C"),
        (F.col("symbols") > 0).alias("D"),
        F.coalesce(F.col("_doc") > F.col("_first"), F.lit(False)).alias("E"),
        F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )


def _bit(position: str) -> str:
    return f"shiftleft(1, instr('{FILTERS}', substr(filter_order, {position}, 1)) - 1)"


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, filter order and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley (see module docstring). All 600 rows of a part come back, zeros
    included; an empty table gives no rows."""
    f = flags(documents, labels)
    mask = sum(F.col(x).cast("int") * (1 << i) for i, x in enumerate(FILTERS))
    masks = f.groupBy("part", mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    orders = F.array(*[F.lit(o) for o in ORDERS])
    steps = masks.select("*", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("step")
    )
    # Filters of the steps before this one (distinct letters: the sum is their union).
    prior = " + ".join(f"CASE WHEN step > {p} THEN {_bit(str(p))} ELSE 0 END" for p in range(1, 5))
    steps = steps.withColumns({"_bit": F.expr(_bit("step")), "_prior": F.expr(prior)})
    fails = (F.col("mask").bitwiseAND(F.col("_bit"))) != 0
    earlier = (F.col("mask").bitwiseAND(F.col("_prior"))) != 0
    here = fails & ~earlier
    count_if = lambda cond, weight="docs": F.sum(F.when(cond, F.col(weight)).otherwise(0)).cast("long")
    table = steps.groupBy("part", "filter_order", "step").agg(
        F.first(F.substring("filter_order", F.col("step"), 1)).alias("filter"),
        count_if(~fails & ~earlier).alias("kept"),
        count_if(here).alias("removed"),
        count_if(fails & earlier).alias("redundant"),
        count_if(F.col("mask") == F.col("_bit")).alias("unique_fails"),
        count_if(here, "good").alias("good_lost"),
        count_if(here, "toxic").alias("toxic_lost"),
    )
    # Small: at most 600 rows a part.
    shapley = table.groupBy("part", "filter").agg(F.sum("removed").cast("long").alias("shapley"))
    return table.join(shapley, ["part", "filter"]).select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        "kept",
        "removed",
        "redundant",
        "unique_fails",
        "good_lost",
        "toxic_lost",
        "shapley",
    )


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(documents, labels)


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, part, t,
         list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM d
), firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
lab AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT w.part,
    (len(ws) < 100)::INT
    + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
    + 4 * (100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 10 * length(w.t))::INT
    + 8 * regexp_matches(w.t, '[#$%&*|]')::INT
    + 16 * coalesce(w.doc_id > firsts.first_id, false)::INT AS mask,
    coalesce(lab.good, 0) AS good, coalesce(lab.toxic, 0) AS toxic
  FROM w JOIN firsts ON w.t = firsts.t LEFT JOIN lab ON w.doc_id = lab.doc_id
), m AS (
  SELECT part, mask, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask
), o AS (
  SELECT a || b || c || d || e AS filter_order
  FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t1(a), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t2(b),
       (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t3(c), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t4(d),
       (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t5(e)
  WHERE a NOT IN (b, c, d, e) AND b NOT IN (c, d, e) AND c NOT IN (d, e) AND d <> e
), s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS filter,
    1 << (instr('ABCDE', substr(filter_order, step, 1)) - 1) AS bit,
    CASE WHEN step > 1 THEN 1 << (instr('ABCDE', substr(filter_order, 1, 1)) - 1) ELSE 0 END
    + CASE WHEN step > 2 THEN 1 << (instr('ABCDE', substr(filter_order, 2, 1)) - 1) ELSE 0 END
    + CASE WHEN step > 3 THEN 1 << (instr('ABCDE', substr(filter_order, 3, 1)) - 1) ELSE 0 END
    + CASE WHEN step > 4 THEN 1 << (instr('ABCDE', substr(filter_order, 4, 1)) - 1) ELSE 0 END AS prior
  FROM o, range(1, 6) r(step)
), t AS (
  SELECT m.part, s.filter_order, s.step::INT AS step, s.filter,
    sum(CASE WHEN (mask & bit) = 0 AND (mask & prior) = 0 THEN docs ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & prior) = 0 THEN docs ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & prior) <> 0 THEN docs ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN docs ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & prior) = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN (mask & bit) <> 0 AND (mask & prior) = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM m, s GROUP BY m.part, s.filter_order, s.step, s.filter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM t
"""
