"""Events and records per simulated second."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway import schemas as S


def throughput_counts(events: DataFrame, channel: str = "type") -> DataFrame:
    """Events per (channel, second) and per second over all channels (channel null).

    Counted per (channel, second) first; the totals add up those few rows instead
    of expanding every event twice. A time that is not a number counts as second 0;
    rows without a time or a channel are not counted.
    """
    time, most = F.col("time"), 9.2e18
    second = (
        F.when(F.isnan(time), 0)
        .when(time >= most, (1 << 63) - 1)
        .when(time <= -most, -(1 << 63))
        .otherwise(time.cast("long"))
    )
    known = events.filter(F.col(channel).isNotNull() & time.isNotNull())
    per_channel = known.groupBy(
        F.col(channel).alias("channel"), second.alias("second")
    ).agg(F.count(F.lit(1)).alias("n"))
    overall = per_channel.groupBy("second").agg(F.sum("n").alias("n"))
    return per_channel.unionByName(overall, allowMissingColumns=True)


def record_throughput(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Records per (table name, second of the event that completes them), and overall.

    The tables are record tables of the operators with ``emitted=True``.
    """
    timed = [t.select(F.lit(name).alias("channel"), F.col(S.EMITTED_AT).alias("time")) for name, t in tables.items()]
    return throughput_counts(reduce(DataFrame.unionByName, timed), "channel")


def throughput_peaks(counts: DataFrame) -> DataFrame:
    """The busiest second per channel and overall; the earliest wins a tie."""
    return (
        counts.groupBy("channel")
        .agg(F.max(F.struct(F.col("n"), (-F.col("second")).alias("back"))).alias("top"))
        .select("channel", (-F.col("top.back")).alias("second"), F.col("top.n").alias("n"))
    )
