"""Guards against keys that hold a large share of all rows.

Every guard rests on one pre-pass: count rows per key (combined on the map side,
one column read) and keep only keys above a limit. There can be no more such keys
than rows divided by the limit, which bounds whatever is broadcast for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEAVY_ROWS = 10_000_000
HEAVY_ROWS_CONF = "spark.headway.heavyRows"


def heavy_rows(spark: SparkSession) -> int:
    """Rows of one key that a single task may still sort (session setting)."""
    return int(spark.conf.get(HEAVY_ROWS_CONF, str(HEAVY_ROWS)))


def estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def heavy_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The keys with more than :func:`heavy_rows` rows, or None if there are none.

    Rows are counted, whatever size the data has on disk.
    """
    spark = df.sparkSession
    counts = df.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    found = counts.filter(F.col("n") > heavy_rows(spark)).select(*keys)
    rows = found.collect()
    return spark.createDataFrame(rows, found.schema) if rows else None


def fits_broadcast(df: DataFrame) -> bool:
    """Is Catalyst's size estimate within the session's own broadcast threshold?"""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= estimated_bytes(df) <= limit


def small_side(df: DataFrame) -> DataFrame | None:
    """``df`` if its size estimate allows a broadcast, else None.

    Estimates behind joins are far too high; Spark's adaptive execution then still
    broadcasts a side whose measured bytes are within the session's threshold.
    """
    return df if fits_broadcast(df) else None


def lookup(
    df: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left", spread: str | None = None
) -> DataFrame:
    """Join ``df`` with ``dim`` (unique on ``keys``) without a hot task.

    A small ``dim`` is broadcast. A large one is joined by shuffle; then the heavy
    keys of ``df`` take the few ``dim`` rows they need by broadcast (one per heavy
    key), and null keys are spread over all tasks by the ``spread`` column instead
    of meeting in one. A stream is joined as it comes: its micro-batches are small.
    """
    keys = list(keys)
    if df.isStreaming:
        return df.join(dim, keys, how)
    small = small_side(dim)
    if small is not None:
        return df.join(small, keys, how)
    heavy = heavy_keys(df, keys)
    if heavy is None:
        return _shuffled(df, dim, keys, how, spread)
    heavy = F.broadcast(heavy)
    hot_dim = dim.join(heavy, keys, "left_semi")
    hot = df.join(heavy, keys, "left_semi").join(F.broadcast(hot_dim), keys, how)
    rest = _shuffled(df.join(heavy, keys, "left_anti"), dim, keys, how, spread)
    return rest.unionByName(hot)


def _shuffled(df, dim, keys, how, spread):
    if spread is None or how in ("inner", "left_semi"):
        return df.join(dim, keys, how)
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    salt = F.when(has_null, F.pmod(F.xxhash64(spread), F.lit(1024))).otherwise(F.lit(0).cast("long"))
    joined = df.withColumn("_salt", salt).join(
        dim.withColumn("_salt", F.lit(0).cast("long")), [*keys, "_salt"], how
    )
    return joined.drop("_salt")
