"""Embedding whitening with MLlib block matrices.

Rows are centred, numbered once and written down, so that every later pass sees
the same numbering. Their scatter matrix is one block product (transpose times
matrix, computed block by block over the cluster); only the small d x d result
reaches the driver, where it is decomposed. The whitening matrix (d x k) is then
multiplied with the distributed row blocks, and the covariance of the result is
measured the same way to report how close it is to the identity.

What reaches the driver is bounded by the dimension d, never by the row count.
"""

from __future__ import annotations

import numpy as np
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRow, IndexedRowMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import stage

#: Components reported at most.
COMPONENTS = 32
#: Offset added to every quantised entry.
SHIFT = 1_000_000
#: Rows of one block of the distributed matrix.
ROWS_PER_BLOCK = 4096
#: Eigenvalues at or below this share of the largest carry no direction to whiten.
RANK_TOLERANCE = 1e-12


def quantised(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key`` and ``x`` = floor(64 * c) + SHIFT per entry, for rows fit to use.

    A row takes no part if its vector is null or empty, holds a null, NaN or infinite
    entry, or its length differs from the longest remaining length (the dimension).
    Rows with a null key take no part either. Repeated rows stay as separate rows.
    """
    c = F.col(vector)
    finite = F.forall(
        c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) != F.lit(float("inf")))
    )
    rows = embeddings.select(F.col(key).alias("vec_id"), c.alias("_v")).filter(
        F.col("vec_id").isNotNull() & F.col("_v").isNotNull() & (F.size("_v") > 0) & finite
    )
    x = F.transform("_v", lambda v: (F.floor(v.cast("double") * 64) + SHIFT).cast("long"))
    return rows.select("vec_id", x.alias("x"))


def _indexed(rows: DataFrame) -> DataFrame:
    """Rows with a dense number 0..n-1, written to the shared folder once."""
    spark = rows.sparkSession
    schema = T.StructType([*rows.schema.fields, T.StructField("idx", T.LongType(), False)])
    numbered = rows.rdd.zipWithIndex().map(lambda p: (*p[0], p[1]))
    return stage(spark.createDataFrame(numbered, schema), "whiten-rows")


def _blocks(rows: DataFrame, column: str, dims: int, shift: list[float] | None = None) -> BlockMatrix:
    """The vectors of ``column`` (minus ``shift``) as a block matrix, row i = idx i."""
    mean = np.asarray(shift if shift is not None else np.zeros(dims), dtype=np.float64)

    def row(r):
        return IndexedRow(r["idx"], np.asarray(r[column], dtype=np.float64) - mean)

    return IndexedRowMatrix(rows.select("idx", column).rdd.map(row)).toBlockMatrix(ROWS_PER_BLOCK, dims)


def _gram(blocks: BlockMatrix) -> np.ndarray:
    """Transpose times matrix, computed on the cluster; the d x d result is local."""
    return blocks.transpose().multiply(blocks).toLocalMatrix().toArray()


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every usable row on its leading components.

    Returns vec_id, component (1 = largest eigenvalue), n, deviation, whitened,
    explained, identity_error (see :func:`digest`). Directions whose eigenvalue is
    not above ``RANK_TOLERANCE`` times the largest cannot be whitened and are not
    reported, so fewer than ``components`` rows per vector come back when the rank
    is lower; with fewer than two distinct vectors nothing comes back. An empty or
    fully unusable table gives no rows.
    """
    rows = quantised(embeddings)
    dims = rows.agg(F.max(F.size("x"))).first()[0]
    if dims is None:
        return _empty(rows.sparkSession)
    rows = _indexed(rows.filter(F.size("x") == dims))

    # Exact sums per dimension, combined on the map side; d numbers reach the driver.
    sums = rows.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(F.sum("v").alias("s"))
    got = {r["d"]: int(r["s"]) for r in sums.collect()}
    n = rows.count()
    if n == 0:
        return _empty(rows.sparkSession)
    S = [got[d] for d in range(dims)]

    centred = _blocks(rows, "x", dims, [s / n for s in S])
    V = _gram(centred) / n
    e, U = np.linalg.eigh(V)
    order = np.argsort(e)[::-1]
    e, U = e[order], U[:, order]
    trace = float(np.trace(V))
    keep = [i for i in range(min(components, dims)) if e[i] > RANK_TOLERANCE * max(e[0], 0.0) and e[i] > 0]
    if not keep:
        return _empty(rows.sparkSession)
    k = len(keep)
    W = U[:, keep] / np.sqrt(e[keep])
    sc = rows.sparkSession.sparkContext
    # One d x k block, copied to each block row by the product.
    w = BlockMatrix(sc.parallelize([((0, 0), Matrices.dense(dims, k, W.flatten(order="F").tolist()))]), dims, k)
    projected = centred.multiply(w)
    cov = _gram(projected) / n
    identity_error = float(np.max(np.abs(cov - np.eye(k))))

    spark = rows.sparkSession
    out = spark.createDataFrame(
        projected.toIndexedRowMatrix().rows.map(lambda r: (int(r.index), r.vector.toArray().tolist())),
        "idx long, w array<double>",
    )
    S_col = F.array(*[F.lit(s).cast("decimal(38,0)") for s in S])
    gap = F.transform("x", lambda v, i: F.lit(n).cast("decimal(38,0)") * v.cast("decimal(38,0)") - S_col[i])
    deviation = F.aggregate(
        F.transform(gap, lambda g: g * g),
        F.lit(0).cast("decimal(38,0)"),
        lambda acc, t: acc + t,
    )
    per_row = rows.select("idx", "vec_id", deviation.cast("long").alias("deviation"))
    explained = F.array(*[F.lit(float(e[i] / trace)) for i in keep])
    return (
        out.join(per_row, "idx")
        .select("vec_id", "deviation", F.posexplode("w").alias("p", "whitened"))
        .select(
            "vec_id",
            (F.col("p") + 1).cast("int").alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            explained[F.col("p")].alias("explained"),
            F.lit(identity_error).alias("identity_error"),
        )
    )


def _empty(spark) -> DataFrame:
    return spark.createDataFrame(
        [],
        "vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double",
    )


def digest(embeddings: DataFrame) -> DataFrame:
    """The contract's rows: one per usable vector and component (at most 32)."""
    return whiten(embeddings)
