"""The eight record-table metrics, from one fused aggregate per table.

Each record table is aggregated once into a few *facts*; emptiness counts ride
along. All metrics are then arithmetic on a single row - or on one row per run,
where ``by`` names the columns that tell runs apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import schemas as S
from headway.config import Params
from headway.functions.columns import finite_or_zero, is_finite, zero_to_null
from headway.operators.skew import lookup

# --- fixed values: stand-ins for missing averages and sums --------------------
NO_TRANSIT_SECONDS = 1e9
NO_CAR_SECONDS = 1.0
NO_DISTANCE_KM = 1e9
# ------------------------------------------------------------------------------

COUNTS = (
    "n_pax",
    "passengers",
    "n_delays",
    "timed",
    "on_time",
    "n_bus_trips",
    "n_trips",
    "pt_trips",
    "pt_multi",
    "transfers",
)
SUMS = (
    "service_seconds",
    "revenue_seconds",
    "km",
    "finite_km",
    "loaded_km",
    "pt_seconds",
    "car_seconds",
)


def pax_facts(pax: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return pax.groupBy(*by).agg(
        F.countDistinct("person_id").alias("passengers"), F.count(F.lit(1)).alias("n_pax")
    )


def delay_facts(delays: DataFrame, params: Params, by: Sequence[str] = ()) -> DataFrame:
    arrival = F.col("arrival_delay")
    punctual = arrival.between(
        -60.0 * params.early_headway_tolerance, 60.0 * params.late_headway_tolerance
    )
    return delays.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_delays"),
        F.count(arrival).alias("timed"),
        F.count_if(punctual).alias("on_time"),
    )


def bus_trip_facts(bus_trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    length, loaded = F.col("link_length"), F.col("have_passenger")
    return bus_trips.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_bus_trips"),
        F.sum("travel_time").alias("service_seconds"),
        F.sum(F.when(loaded, F.col("travel_time"))).alias("revenue_seconds"),
        F.sum(length).alias("km"),
        F.sum(F.when(is_finite(length), length)).alias("finite_km"),
        F.sum(F.when(is_finite(length), F.when(loaded, length).otherwise(0.0))).alias("loaded_km"),
    )


def trip_facts(trips: DataFrame, by: Sequence[str] = (), *extra: Column) -> DataFrame:
    pt, car = F.col("main_mode") == S.TRANSIT_MODE, F.col("main_mode") == S.CAR_MODE
    return trips.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_trips"),
        F.count_if(pt).alias("pt_trips"),
        F.count_if(pt & (F.size("veh_list") >= 2)).alias("pt_multi"),
        F.avg(F.when(pt, F.col("travel_time"))).alias("pt_seconds"),
        F.avg(F.when(car, F.col("travel_time"))).alias("car_seconds"),
        *extra,
    )


def trip_and_transfer_facts(trips: DataFrame, buses: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """:func:`trip_facts` with ``transfers``: transit trips that change from one bus straight
    to another, 0 where there are trips but no such change. One way for fleets of any size."""
    parts = trip_facts(trips, by).unionByName(transfer_facts(trips, buses, by), allowMissingColumns=True)
    names = [c for c in parts.columns if c not in by]
    return parts.groupBy(*by).agg(
        *[
            F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) if c == "transfers" else F.max(c).alias(c)
            for c in names
        ]
    )


def transfer_facts(trips: DataFrame, buses: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Transfers for a fleet of any size.

    Trips with the same vehicle list are counted together first. Each list is
    then followed by its digest, so the list itself is not copied per pair.
    """
    several = trips.filter((F.col("main_mode") == S.TRANSIT_MODE) & (F.size("veh_list") >= 2))
    lists = several.groupBy(*by, "veh_list").agg(F.count(F.lit(1)).alias("n"))
    v = F.col("veh_list")
    legs = F.transform(
        F.sequence(F.lit(1), F.size(v) - 1),
        lambda i: F.struct(F.get(v, i - 1).alias("a"), F.get(v, i).alias("b")),
    )
    digest = F.sha2(F.to_json(v), 256).alias("list")
    pairs = (
        lists.select(*by, "n", digest, F.array_distinct(legs).alias("legs"))
        .select(*by, "n", "list", F.inline("legs"))
    )
    for side in ("a", "b"):
        pairs = lookup(pairs, buses.select(F.col("vehicle_id").alias(side)), [side], "left_semi")
    changed = pairs.select(*by, "list", "n").distinct()
    return changed.groupBy(*by).agg(F.sum("n").alias("transfers"))


def facts(
    records: dict[str, DataFrame], buses: DataFrame, params: Params, by: Sequence[str] = ()
) -> DataFrame:
    """All facts in one row (per ``by``); the record tables may lack some keys."""
    parts = [
        pax_facts(records["bus_pax_records"], by),
        delay_facts(records["bus_delay_records"], params, by),
        bus_trip_facts(records["bus_trip_records"], by),
        trip_and_transfer_facts(records["trip_records"], buses, by),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.groupBy(*by).agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in COUNTS],
        *[F.max(c).alias(c) for c in SUMS],
    )


# Metrics as expressions on the fact columns. A null inside an exponent counts as
# zero where the divisor was zero passengers; any other null or non-finite
# result makes the metric zero.


def _guarded(value: Column, *sources: str) -> Column:
    filled = F.lit(True)
    for source in sources:
        filled = filled & (F.col(source) > 0)
    return F.when(filled, finite_or_zero(value)).otherwise(F.lit(0.0))


def ridership(population: Column) -> Column:
    return _guarded(F.try_divide(F.col("passengers"), population), "n_pax")


def on_time() -> Column:
    return _guarded(F.try_divide("on_time", "timed"), "n_delays")


def travel_time(params: Params) -> Column:
    seconds = F.coalesce("pt_seconds", F.lit(NO_TRANSIT_SECONDS))
    return _guarded(F.exp(-F.try_divide(seconds, F.lit(60.0 * params.travel_time_baseline))), "n_trips")


def transit_auto_ratio() -> Column:
    pt = F.coalesce("pt_seconds", F.lit(NO_TRANSIT_SECONDS))
    car = F.coalesce("car_seconds", F.lit(NO_CAR_SECONDS))
    return _guarded(F.exp(-F.try_divide(pt, car)), "n_trips")


def service_hours() -> Column:
    return F.coalesce(F.col("service_seconds") / 3600.0, F.lit(0.0))


def revenue_hours() -> Column:
    return F.coalesce(F.col("revenue_seconds") / 3600.0, F.lit(0.0))


def productivity(params: Params) -> Column:
    per_passenger = F.coalesce(service_hours() / zero_to_null(F.col("passengers")), F.lit(0.0))
    return _guarded(F.exp(-params.productivity_baseline * per_passenger), "n_bus_trips", "n_pax")


def bus_efficiency() -> Column:
    distance = F.coalesce("km", F.lit(NO_DISTANCE_KM))
    per_passenger = F.coalesce(distance / zero_to_null(F.col("passengers")), F.lit(0.0))
    return _guarded(F.exp(-per_passenger), "n_bus_trips", "n_pax")


def effective_distance() -> Column:
    return _guarded(F.col("loaded_km") / zero_to_null(F.col("finite_km")), "n_bus_trips")


def bus_transfer_rate() -> Column:
    """One minus the share of transit trips with a bus-to-bus change.

    Zero where no transit trip used two vehicles.
    """
    share = F.col("transfers") / zero_to_null(F.col("pt_trips"))
    return _guarded(F.when(F.col("pt_multi") > 0, 1.0 - share), "n_trips")
