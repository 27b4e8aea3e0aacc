"""Arrival and departure delay of buses at stops."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import emission
from headway.operators.events import bus_events, vehicle_events
from headway.operators.prefix import Ordered, by_key, carried


def delay_log(events: DataFrame, buses: DataFrame, *extra: str) -> DataFrame:
    return (
        bus_events(events, buses, S.ARRIVES, S.DEPARTS)
        .filter((F.col("type") == S.DEPARTS) | F.col("facility").isNotNull())
        .select("seq", "type", "bus", "facility", F.coalesce("delay", F.lit(float("nan"))).alias("delay"), *extra)
    )


def bus_stop_delays(
    events: DataFrame,
    buses: DataFrame,
    heavy: DataFrame | None = None,
    emitted: bool = False,
    ranged: bool | DataFrame = False,
) -> DataFrame:
    """Pair each departure from a stop with the bus's arrival just before it.

    Arrivals that name no facility are not seen at all. A departure right after
    another departure has no arrival to pair with.
    ``emitted`` adds the time of departure; ``ranged`` orders by range partitions.
    """
    log = delay_log(events, buses, *(["time"] if emitted else []), *carried(events))
    sized_by = vehicle_events(events, S.ARRIVES, S.DEPARTS)
    return by_key(log, "bus", partial(_pairs, emitted), sized_by, heavy, ranged)


def _pairs(emitted: bool, log: Ordered) -> DataFrame:
    previous = F.struct("type", "facility", "delay")
    rows = log.before(last={"prev": previous}).df
    return rows.filter((F.col("type") == S.DEPARTS) & (F.col("prev.type") == S.ARRIVES)).select(
        F.col("prev.facility").alias("stop_id"),
        F.col("prev.delay").alias("arrival_delay"),
        F.col("delay").alias("depart_delay"),
        *emission(emitted),
    )
