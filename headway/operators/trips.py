"""Door-to-door trips of persons."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import emission
from headway.operators.events import non_driver_events
from headway.operators.prefix import Ordered, by_key, carried
from headway.operators.skew import lookup


def _trip_events(events: DataFrame) -> DataFrame:
    kind = F.col("type")
    return (
        non_driver_events(events)
        .filter(
            ((kind == S.DEPARTURE) & F.col("computationalRoutingMode").isNotNull())
            | ((kind == S.PERSON_ENTERS) & F.col("vehicle").isNotNull())
            | ((kind == S.ACTIVITY_START) & (F.col("actType") != S.INTERIM_ACTIVITY))
        )
        .select(
            "seq",
            "time",
            "type",
            "person",
            F.col("computationalRoutingMode").alias("mode"),
            F.when(kind == S.PERSON_ENTERS, F.col("vehicle")).alias("vehicle"),
            *carried(events),
        )
    )


def trip_log(events: DataFrame, blacklist: DataFrame) -> DataFrame:
    """The events that open, fill and close trips; ``banned`` marks blacklisted boardings."""
    banned = blacklist.select(F.col("vehicle_id").alias("vehicle"), F.lit(True).alias("banned"))
    return lookup(_trip_events(events), banned, ["vehicle"], "left", "seq")


def person_trips(
    events: DataFrame, blacklist: DataFrame, emitted: bool = False, ranged: bool | DataFrame = False
) -> DataFrame:
    """Trips from a departure to the next real activity, with the vehicles boarded.

    Trips that used no vehicle, or only blacklisted ones, are left out.
    ``emitted`` adds the time of arrival; ``ranged`` orders by range partitions.
    """
    recipe = partial(_trips, emitted)
    return by_key(trip_log(events, blacklist), "person", recipe, _trip_events(events), ranged=ranged)


def _trips(emitted: bool, log: Ordered) -> DataFrame:
    opens, boards, closes = (
        F.col("type") == t for t in (S.DEPARTURE, S.PERSON_ENTERS, S.ACTIVITY_START)
    )
    ends = F.when(closes, 1).otherwise(0).cast("long")
    rows = log.before(
        last={"open": F.when(opens, True).when(closes, False)},
        total={"trip": ends},
        overall={"all_ends": ends},
    ).df
    # Rows after a person's last activity belong to no finished trip, and boardings
    # outside an open trip to none at all: neither reaches the aggregation.
    rows = rows.filter((F.col("trip") < F.col("all_ends")) & (opens | F.col("open")))
    first = F.min_by(F.struct("time", "mode"), F.when(opens, F.col("seq")))
    trips = rows.groupBy("person", "trip").agg(
        first.alias("start"),
        F.max(F.when(closes, F.col("time"))).alias("end"),
        F.bool_or(boards & F.col("banned").isNull()).alias("kept"),
        F.collect_list(F.when(boards, F.struct("seq", "vehicle"))).alias("boarded"),
    )
    return trips.filter("kept").select(
        F.col("person").alias("person_id"),
        F.col("start.time").alias("start_time"),
        (F.col("end") - F.col("start.time")).alias("travel_time"),
        F.col("start.mode").alias("main_mode"),
        F.array_sort("boarded")["vehicle"].alias("veh_list"),
        *emission(emitted, "end"),
    )


def trips_not_blacklisted(trips: DataFrame, blacklist: DataFrame, trip_id: str) -> DataFrame:
    """Keep trips that used at least one vehicle outside the blacklist.

    Works on finished trip tables; ``trip_id`` is a unique column.
    """
    used = trips.select(trip_id, F.explode("veh_list").alias("vehicle_id"))
    allowed = lookup(used, blacklist.select("vehicle_id"), ["vehicle_id"], "left_anti")
    return trips.join(allowed.select(trip_id).distinct(), [trip_id], "left_semi")
