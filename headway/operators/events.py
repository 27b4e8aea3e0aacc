"""Row-level operators on the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway import schemas as S
from headway.operators.skew import heavy_keys, lookup


def rejects(events: DataFrame) -> DataFrame:
    """Events without a numeric time or without a type."""
    return events.filter(F.col("time").isNull() | F.col("type").isNull())


def valid_events(events: DataFrame, prefix: bool = False) -> DataFrame:
    """Drop reject rows; with ``prefix`` also everything after the first of them."""
    if prefix:
        first_bad = rejects(events).agg(F.min("seq"))
        end = F.coalesce(first_bad.scalar(), F.lit(2**63 - 1))
        events = events.filter(F.col("seq") < end)
    return events.filter(F.col("time").isNotNull() & F.col("type").isNotNull())


def last_iteration(events: DataFrame, target: int | None = None) -> DataFrame:
    """Events of the target iteration, by default the last one in the log."""
    wanted = F.lit(target) if target is not None else events.agg(F.max("iteration")).scalar()
    return events.filter(F.col("iteration") == wanted)


def non_driver_events(events: DataFrame) -> DataFrame:
    """Person events of everyone but transit drivers."""
    return events.filter(F.col("person").isNotNull() & ~F.col("person").startswith(S.DRIVER_PREFIX))


def vehicle_events(events: DataFrame, *types: str) -> DataFrame:
    """Events of the given types with the id of the vehicle they are about in ``bus``."""
    about = F.when(F.col("type") == S.DRIVER_STARTS, F.col("vehicleId")).otherwise(F.col("vehicle"))
    return events.filter(F.col("type").isin(*types)).withColumn("bus", about)


def heavy_vehicles(events: DataFrame) -> DataFrame:
    """Vehicles with too many events for one task, to be found once for several operators."""
    about = vehicle_events(events, *S.VEHICLE_EVENTS).select("bus")
    heavy = heavy_keys(about, ["bus"])
    return about.sparkSession.createDataFrame([], about.schema) if heavy is None else heavy


def bus_events(events: DataFrame, buses: DataFrame, *types: str) -> DataFrame:
    """:func:`vehicle_events` restricted to buses (``buses``: column ``vehicle_id``)."""
    ids = buses.select(F.col("vehicle_id").alias("bus"))
    return lookup(vehicle_events(events, *types), ids, ["bus"], "left_semi")
