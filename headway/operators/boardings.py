"""Passengers boarding buses."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import emission
from headway.operators.events import bus_events, vehicle_events
from headway.operators.prefix import Ordered, by_key, carried

_TYPES = (S.DRIVER_STARTS, S.PERSON_ENTERS, S.LEAVES_TRAFFIC)


def boarding_log(events: DataFrame, buses: DataFrame, *extra: str) -> DataFrame:
    return bus_events(events, buses, *_TYPES).select(
        "seq", "type", "bus", "person", F.col("driverId").alias("starting"), *extra
    )


def bus_boardings(
    events: DataFrame,
    buses: DataFrame,
    heavy: DataFrame | None = None,
    emitted: bool = False,
    ranged: bool | DataFrame = False,
) -> DataFrame:
    """One row per person who boards a bus under a registered driver, the driver excepted.

    The driver is the latest one to start on the bus since it last left traffic.
    ``emitted`` adds the time of boarding; ``ranged`` orders by range partitions.
    """
    log = boarding_log(events, buses, *(["time"] if emitted else []), *carried(events))
    return by_key(log, "bus", partial(_boardings, emitted), vehicle_events(events, *_TYPES), heavy, ranged)


def _boardings(emitted: bool, log: Ordered) -> DataFrame:
    kind = F.col("type")
    in_charge = F.when(
        (kind == S.DRIVER_STARTS) & F.col("starting").isNotNull(),
        F.struct(F.col("starting").alias("id")),
    ).when(kind == S.LEAVES_TRAFFIC, F.struct(F.lit(None).cast("string").alias("id")))
    rows = log.before(last={"driver": in_charge}).df
    return rows.filter((kind == S.PERSON_ENTERS) & (F.col("person") != F.col("driver.id"))).select(
        F.col("person").alias("person_id"), F.col("bus").alias("bus_id"), *emission(emitted)
    )
