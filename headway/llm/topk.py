"""Exact top-k inner products over an impact-ordered index.

The index of a block of vectors has a posting segment for every dimension and quantised
value: the vectors whose component lies in that step. For a query a segment has a known
range of impacts (query component times the step). Segments are taken score-at-a-time by
descending quantised impact, a level at once. What is still out can add no more to a
vector than each dimension's next impact, so every level gives an upper bound for all
vectors of the block; those whose bound is below the k-th best exact score known by then
cannot be members. A query stops on the proof that few possible members are left, and
exactly those are rescored with the whole integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import ready, stage

STEP = 4  # integers in one quantised impact
CANDIDATES, QUERIES = 4096, 512  # vectors in a block of the index, queries in a batch
LEVELS = (0.25, 0.0)  # parts of a query's largest impact that end a level


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id and ``v``, the floor of 64 times each component.

    Vectors that are null or hold null or non-finite components are left out.
    """
    ok = F.col("embedding").isNotNull() & F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    return vectors.filter(ok).select(
        "vec_id",
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("long")).alias("v"),
    )


class Index:
    """Posting segments of one block of integer vectors, as membership columns."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        level = np.floor_divide(vectors, STEP)
        self.least = level.min(axis=0)
        self.levels = level.max(axis=0) - self.least + 1
        self.first = np.concatenate(([0], np.cumsum(self.levels)))
        n, dims = vectors.shape
        self.dim = np.repeat(np.arange(dims), self.levels)
        self.low = (np.arange(self.first[-1]) - self.first[self.dim] + self.least[self.dim]) * STEP
        self.member = np.zeros((n, self.first[-1]), dtype=np.float32)
        columns = level - self.least + self.first[:-1]
        self.member[np.repeat(np.arange(n), dims), columns.ravel()] = 1

    def impacts(self, queries: np.ndarray) -> np.ndarray:
        """Upper end of the impact of each segment (columns) for each query (rows)."""
        part = queries[:, self.dim]
        return np.maximum(part * self.low, part * (self.low + STEP - 1)).astype(np.float32)

    def bounds(self, impacts: np.ndarray, level: np.ndarray) -> np.ndarray:
        """Upper bounds of all scores once all segments above ``level`` are in."""
        seen = impacts > level[:, None]
        left = np.where(seen, -np.inf, impacts)
        following = np.maximum.reduceat(left, self.first[:-1], axis=1)
        weights = np.where(seen, impacts, following[:, self.dim])
        return weights.astype(np.float32) @ self.member.T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def search(index: Index, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int):
    """For each query the places in the index and scores of its k best, own id left out.

    Bounds are sums of at most 2**24 in size, which 32-bit floats hold exactly; blocks
    with larger values skip the bounds and rescore every vector.
    """
    vectors, n = index.vectors, len(ids)
    out: list = [None] * len(queries)
    exact = np.abs(queries).max(initial=0) * max(
        np.abs(index.low).max(initial=0) + STEP, 1
    ) * vectors.shape[1] < (1 << 24)
    small = max(4 * k, n // 16)
    active = np.arange(len(queries))
    impacts = index.impacts(queries) if exact else None
    top = impacts.max(axis=1) if exact else None
    for nr, part in enumerate(LEVELS if exact and n > small else (None,)):
        final = part is None or nr == len(LEVELS) - 1
        if part is not None:
            bound = index.bounds(impacts[active], top[active] * part)
        left = []
        for row, q in enumerate(active):
            if part is None:
                members = np.arange(n)
            else:
                tried = np.argpartition(-bound[row], k + 1)[: k + 2]
                tried = tried[ids[tried] != own[q]]
                known = np.sort(vectors[tried] @ queries[q])[::-1]
                limit = known[k - 1] if len(known) >= k else -np.inf
                members = np.flatnonzero(bound[row] >= limit)
                if not final and len(members) > small:
                    left.append(q)
                    continue
            members = members[ids[members] != own[q]]
            scores = vectors[members] @ queries[q]
            order = best(scores, ids[members], k)
            out[q] = members[order], scores[order]
        active = np.array(left, dtype=int)
        if not len(active):
            break
    return out


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    flat = column.combine_chunks()
    lengths = np.asarray(pc.list_value_length(flat), dtype=np.int64)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = np.asarray(flat.flatten())
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The k vectors of highest inner product with each query, but those of its own id.

    Both tables hold vec_id and integer vectors ``v`` (components below 2**28). Queries
    and vectors are dealt in blocks: every block of queries meets every block of vectors
    in a task of its own and keeps k rows per query, and the few best of these are the
    result: query_id, rank, vec_id, score. Equal scores go to smaller vec_ids. Repeated
    rows are vectors of their own; a repeated query gets its rows as often.
    """
    spark = ready(vectors.sparkSession)
    vectors = stage(vectors.select("vec_id", "v"), "topk")
    queries = stage(
        queries.select("vec_id", "v").withColumn("row", F.monotonically_increasing_id()), "topk"
    )
    n, m = vectors.count(), queries.count()
    sides = (-(-n // CANDIDATES) or 1, -(-m // QUERIES) or 1)

    def block(column: str, count: int):
        return F.pmod(F.xxhash64(column, "v"), F.lit(count)).cast("int")

    left = vectors.withColumn("cb", block("vec_id", sides[0])).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(sides[1] - 1)))
    )
    right = queries.withColumn("qb", block("row", sides[1])).withColumn(
        "cb", F.explode(F.sequence(F.lit(0), F.lit(sides[0] - 1)))
    )
    schema = pa.schema(
        [("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
    )

    def meet(some: pa.Table, asked: pa.Table) -> pa.Table:
        if not some.num_rows or not asked.num_rows:
            return schema.empty_table()
        width = max(
            pc.max(pc.list_value_length(t["v"])).as_py() for t in (some, asked)
        )
        if not width:
            some_v, asked_v = np.zeros((some.num_rows, 1), int), np.zeros((asked.num_rows, 1), int)
        else:
            some_v, asked_v = _matrix(some["v"], width), _matrix(asked["v"], width)
        out = [[], [], [], []]
        own, rows = asked["vec_id"].to_numpy(), asked["row"].to_numpy()
        every = some["vec_id"].to_numpy()
        # a block that holds many copies of one vector is still cut to size
        for at in range(0, len(every), 2 * CANDIDATES):
            ids, part = every[at : at + 2 * CANDIDATES], some_v[at : at + 2 * CANDIDATES]
            index = Index(part)
            for lo in range(0, len(own), QUERIES):
                found = search(index, ids, asked_v[lo : lo + QUERIES], own[lo : lo + QUERIES], k)
                for q, (places, scores) in enumerate(found, start=lo):
                    out[0].append(np.full(len(places), rows[q]))
                    out[1].append(np.full(len(places), own[q]))
                    out[2].append(ids[places])
                    out[3].append(scores)
        return pa.table([np.concatenate(x) for x in out], schema=schema)

    found = (
        left.groupBy("cb", "qb")
        .cogroup(right.groupBy("cb", "qb"))
        .applyInArrow(meet, "row bigint, query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def digest(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    integers = quantised(vectors)
    return top_k(integers, integers.filter(F.col("vec_id") % every == 0), k)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
