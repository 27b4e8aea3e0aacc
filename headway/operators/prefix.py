"""State before each event: ordered prefix values per key.

The event-log operators ask, for every event, what its vehicle's (or person's)
earlier events left behind: the latest value set, a running total, the total at
the latest mark. On ordinary keys that is one window per key, ordered by ``seq``.

A key with more rows than one task should sort is cut into *chunks* of
consecutive ``seq`` values. Each chunk is worked on by its own task, a one-row
summary per chunk is carried forward over the (few) chunks of the key, and the
carried value completes the rows of the next chunks. Results are the same; no
task sees more than one chunk of rows.

:func:`by_range` needs no count of keys beforehand: rows are range-partitioned by
(key, seq) with sampled, row-balanced cuts, and each partition is a chunk. Only a
key that spans two or more partitions needs a carry; such a key is the last key of
one partition and the first of the next, so there are fewer of them than
partitions, and their summaries (one row per key and partition) are broadcast.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.operators.skew import heavy_keys, heavy_rows
from headway.session import stage

CHUNK = "_chunk"


def carried(events: DataFrame) -> list[str]:
    """The chunk column of events landed in chunks, to be kept by a selection."""
    return [CHUNK] if CHUNK in events.columns else []


@dataclass(frozen=True)
class Ordered:
    """Events grouped by ``key`` and ordered by ``seq``; ``chunked`` for heavy keys."""

    df: DataFrame
    key: str
    chunked: bool = False
    #: Keys whose rows lie in more than one chunk (range-partitioned rows only); None: all.
    spans: DataFrame | None = None

    def with_columns(self, columns: Mapping[str, Column]) -> "Ordered":
        return replace(self, df=self.df.withColumns(dict(columns)))

    def before(
        self,
        last: Mapping[str, Column] | None = None,
        total: Mapping[str, Column] | None = None,
        at_mark: Mapping[str, tuple[str, Column]] | None = None,
        overall: Mapping[str, Column] | None = None,
    ) -> "Ordered":
        """Add columns that describe the rows *before* each row.

        ``last``: the latest non-null value. ``total``: the sum (0 at the start).
        ``at_mark``: ``name -> (total name, condition)``, that total as it stood at
        the latest row where the condition held. ``overall``: the sum over all
        rows of the key, later ones included.
        """
        last, total, at_mark, overall = last or {}, total or {}, at_mark or {}, overall or {}
        groups = [self.key, CHUNK] if self.chunked else [self.key]
        whole = Window.partitionBy(*groups)
        earlier = whole.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)

        inputs = {f"_last_{n}": c for n, c in last.items()}
        inputs |= {f"_add_{n}": c for n, c in {**total, **overall}.items()}
        inputs |= {f"_mark_{n}": cond for n, (_, cond) in at_mark.items()}
        df = self.df.withColumns(inputs)
        df = df.withColumns(
            {n: F.last(f"_last_{n}", ignorenulls=True).over(earlier) for n in last}
            | {n: F.coalesce(F.sum(f"_add_{n}").over(earlier), F.lit(0)) for n in total}
        )
        if overall:
            df = df.withColumns({n: F.sum(f"_add_{n}").over(whole) for n in overall})
        if at_mark:
            df = df.withColumns(
                {
                    n: F.last(F.when(F.col(f"_mark_{n}"), F.col(t)), ignorenulls=True).over(earlier)
                    for n, (t, _) in at_mark.items()
                }
            )
        if self.chunked and not (self.spans is not None and self.spans.isEmpty()):
            df = self._carry(df, list(last), list(total), {n: t for n, (t, _) in at_mark.items()}, list(overall))
        return replace(self, df=df.drop(*inputs))

    def _carry(self, df, last, total, at_mark, overall):
        """Complete chunk-local values with what the key's earlier chunks left."""
        spanning = df if self.spans is None else df.join(F.broadcast(self.spans), self.key, "left_semi")
        summary = spanning.groupBy(self.key, CHUNK).agg(
            *[
                F.max_by(f"_last_{n}", F.when(F.col(f"_last_{n}").isNotNull(), F.col("seq"))).alias(n)
                for n in last
            ],
            *[F.sum(f"_add_{n}").alias(n) for n in [*total, *overall]],
            *[
                F.max_by(t, F.when(F.col(f"_mark_{n}"), F.col("seq"))).alias(f"_at_{n}")
                for n, t in at_mark.items()
            ],
        )
        over_key = Window.partitionBy(self.key)
        earlier = over_key.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carry = summary.withColumns(
            {f"_in_{n}": F.last(n, ignorenulls=True).over(earlier) for n in last}
            | {f"_in_{n}": F.coalesce(F.sum(n).over(earlier), F.lit(0)) for n in total}
            | {f"_in_{n}": F.sum(n).over(over_key) for n in overall}
        )
        carry = carry.withColumns(
            {
                f"_in_{n}": F.last(F.col(f"_at_{n}") + F.col(f"_in_{t}"), ignorenulls=True).over(earlier)
                for n, t in at_mark.items()
            }
        )
        names = [*last, *total, *at_mark, *overall]
        # Written out once: later rounds and the final pass then read these few
        # rows instead of repeating the rounds before them.
        carry = stage(carry.select(self.key, CHUNK, *[f"_in_{n}" for n in names]), "carry")
        if self.spans is None:
            df = df.join(carry, [self.key, CHUNK])
        else:
            # At most two rows a partition: keys of one chunk find no carry and keep their values.
            df = df.join(F.broadcast(carry), [self.key, CHUNK], "left")
        done = {n: F.coalesce(F.col(n), F.col(f"_in_{n}")) for n in last}
        done |= {
            n: F.coalesce(F.col(n) + F.coalesce(F.col(f"_in_{t}"), F.lit(0)), F.col(f"_in_{n}"))
            for n, t in at_mark.items()
        }
        done |= {n: F.col(n) + F.coalesce(F.col(f"_in_{n}"), F.lit(0)) for n in total}
        done |= {n: F.coalesce(F.col(f"_in_{n}"), F.col(n)) for n in overall}
        return df.withColumns(done).drop(*[f"_in_{n}" for n in names])


def by_range(events: DataFrame, key: str, recipe: Callable[[Ordered], DataFrame]) -> DataFrame:
    """Run ``recipe`` on rows range-partitioned by (key, seq): any key size, no pre-pass.

    The partitions (``spark.sql.shuffle.partitions`` of them) are cut at sampled
    quantiles of (key, seq), so they hold about equal numbers of rows whatever the
    keys or the gaps between ``seq`` values are. Each partition is a chunk; the rows
    and their chunk are written once, so every later pass sees the same chunks.
    Each chunk's first and last key (one row a chunk) reach the driver.
    """
    spark = events.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        events.filter(F.col(key).isNotNull())
        .repartitionByRange(parts, key, "seq")
        .withColumn(CHUNK, F.spark_partition_id())
    )
    ranged = stage(ranged, "ranged")
    ends = ranged.groupBy(CHUNK).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
    seen = Counter(k for r in ends for k in {r["lo"], r["hi"]})
    spans = spark.createDataFrame([(k,) for k, c in seen.items() if c > 1], ranged.select(key).schema)
    return recipe(Ordered(ranged, key, chunked=True, spans=spans))


def by_key(
    events: DataFrame,
    key: str,
    recipe: Callable[[Ordered], DataFrame],
    sized_by: DataFrame,
    heavy: DataFrame | None = None,
    ranged: bool | DataFrame = False,
) -> DataFrame:
    """Run ``recipe`` on all keys: ordinary ones in one task each, heavy ones in chunks.

    Heavy keys are looked for in ``sized_by`` (the events before any join), unless
    they are given; an empty frame says that there are none. ``ranged`` takes
    :func:`by_range` instead, which needs neither. A frame in ``ranged`` says that
    ``events`` were landed in chunks already (column ``_chunk``) and lists the keys
    that span chunks.
    """
    if isinstance(ranged, DataFrame):
        return recipe(Ordered(events.filter(F.col(key).isNotNull()), key, chunked=True, spans=ranged))
    if ranged:
        return by_range(events, key, recipe)
    events = events.filter(F.col(key).isNotNull())
    if heavy is None:
        heavy = heavy_keys(sized_by, [key])
    elif heavy.isEmpty():
        heavy = None
    if heavy is None:
        return recipe(Ordered(events, key))
    heavy = F.broadcast(heavy)
    # At most one row per seq value, so a chunk holds at most ``width`` rows.
    width = heavy_rows(events.sparkSession)
    hot = events.join(heavy, key, "left_semi").withColumn(CHUNK, F.floor(F.col("seq") / F.lit(width)))
    parts = [
        Ordered(events.join(heavy, key, "left_anti"), key),
        Ordered(stage(hot, "heavy"), key, chunked=True),
    ]
    return reduce(DataFrame.unionByName, [recipe(part) for part in parts])
