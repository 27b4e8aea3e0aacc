"""Scenario metadata: vehicle classes, bus lines, route share, spatial coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import contains_any


def classify_vehicles(transit_vehicles: DataFrame, markers: Sequence[str]) -> DataFrame:
    """Transit vehicles with ``is_bus``: the type id contains one of the markers."""
    is_bus = F.coalesce(contains_any(F.col("type_id"), markers), F.lit(False))
    return transit_vehicles.select("vehicle_id", is_bus.alias("is_bus"))


def buses(transit_vehicles: DataFrame, markers: Sequence[str]) -> DataFrame:
    return classify_vehicles(transit_vehicles, markers).filter("is_bus").select("vehicle_id").distinct()


def blacklist(transit_vehicles: DataFrame, markers: Sequence[str]) -> DataFrame:
    """Transit vehicles that are no buses."""
    return classify_vehicles(transit_vehicles, markers).filter("NOT is_bus").select("vehicle_id").distinct()


def link_km(links: DataFrame) -> DataFrame:
    return links.select("link_id", (F.col("length_m") / 1000.0).alias("km"))


def bus_lines(route_parts: DataFrame, modes: Sequence[str]) -> DataFrame:
    """Lines with at least one route of a listed mode (from routes, or route links or stops)."""
    return route_parts.filter(F.col("transport_mode").isin(*modes)).select("line_id").distinct()


def covered_links(route_links: DataFrame, modes: Sequence[str], routes: DataFrame | None = None) -> DataFrame:
    """Distinct links on any route of a kept line, whatever that route's own mode.

    ``routes`` names the mode of every route, also of those without inner links; if it
    is not given, lines are told from the routes in ``route_links`` alone.
    """
    return _of_kept_lines(route_links, modes, "link_id", routes=routes).select("link_id").distinct()


def bus_stops(route_stops: DataFrame, modes: Sequence[str], routes: DataFrame | None = None) -> DataFrame:
    """Distinct stops of kept lines with their coordinates."""
    place = F.min(F.struct("x", "y")).alias("at")
    kept = _of_kept_lines(route_stops, modes, "stop_id", place, routes=routes)
    return kept.groupBy("stop_id").agg(F.min("at").alias("at")).select("stop_id", "at.x", "at.y")


def stop_places(route_stops: DataFrame, modes: Sequence[str], routes: DataFrame | None = None) -> DataFrame:
    """Distinct coordinates of the stops of kept lines: all that coverage needs."""
    kept = _of_kept_lines(route_stops.withColumn("at", F.struct("x", "y")), modes, "at", routes=routes)
    return kept.select("at").distinct().select("at.x", "at.y")


def _of_kept_lines(
    route_parts: DataFrame, modes: Sequence[str], item: str, *extra, routes: DataFrame | None = None
) -> DataFrame:
    """Items of kept lines, once per line: repeats go before anything meets by line."""
    if routes is not None:
        items = route_parts.groupBy("line_id", item).agg(*extra) if extra else route_parts.select("line_id", item).distinct()
        return items.join(bus_lines(routes, modes), ["line_id"], "left_semi")
    listed = F.bool_or(F.col("transport_mode").isin(*modes)).alias("listed")
    items = route_parts.groupBy("line_id", item).agg(listed, *extra)
    kept = items.filter("listed").select("line_id").distinct()
    return items.join(kept, ["line_id"], "left_semi")


def transit_route_ratio(
    links: DataFrame, route_links: DataFrame, modes: Sequence[str], routes: DataFrame | None = None
) -> DataFrame:
    """Length of covered links over the length of all links, one row.

    Covered links unknown to the network add nothing. An empty network gives NaN.
    """
    covered = covered_links(route_links, modes, routes).withColumn("covered", F.lit(True))
    flagged = links.select("link_id", "length_m").join(covered, ["link_id"], "left")
    sums = flagged.agg(
        F.coalesce(F.sum(F.when(F.col("covered"), F.col("length_m"))), F.lit(0.0)).alias("part"),
        F.coalesce(F.sum("length_m"), F.lit(0.0)).alias("total"),
    )
    return sums.select(
        F.coalesce(F.try_divide("part", "total"), F.lit(float("nan"))).alias("transit_route_ratio")
    )


def person_home(activities: DataFrame) -> DataFrame:
    """Every person with the place of the first home activity of the selected plan.

    Persons without one keep null coordinates.
    """
    home_seq = F.when(F.col("selected") & (F.col("act_type") == S.HOME), F.col("act_seq"))
    homes = activities.groupBy("person_id").agg(*[F.min_by(c, home_seq).alias(c) for c in ("x", "y")])
    return homes.select("person_id", "x", "y")


def home_places(homes: DataFrame) -> DataFrame:
    """Distinct home places with the number of ``persons`` who live there."""
    return homes.groupBy("x", "y").agg(F.count(F.lit(1)).alias("persons"))


def covered_places(places: DataFrame, stops: DataFrame, radius: float) -> DataFrame:
    """The places within ``radius`` of a stop (``stops``: best without repeated coordinates).

    Places and stops meet on a grid whose cells are a little shorter in diagonal
    than the radius. A cell with a stop covers all its places, so it needs one row
    whatever the number of stops. Places in other cells meet the stops of the 24
    cells around theirs; there the distance decides, and the semi-join is done
    with a place at the first stop in reach. A crowded cell is split at run time
    (adaptive skew join: places on the left of a semi-join may be divided freely).
    """
    side = 0.7 * radius
    cell = {"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)}
    places = places.dropna(subset=["x", "y"]).withColumns(cell)
    spots = stops.select("x", "y").dropna().withColumns(cell)
    occupied = spots.select("cx", "cy").distinct()
    steps = F.sequence(F.lit(-2), F.lit(2))
    around = (
        spots.select(F.col("x").alias("sx"), F.col("y").alias("sy"), "cx", "cy", F.explode(steps).alias("i"))
        .withColumn("j", F.explode(steps))
        .filter("i <> 0 OR j <> 0")
        .select("sx", "sy", (F.col("cx") + F.col("i")).alias("cx"), (F.col("cy") + F.col("j")).alias("cy"))
        .join(occupied, ["cx", "cy"], "left_anti")
    )
    targets = around.unionByName(occupied, allowMissingColumns=True)
    dx, dy = F.col("x") - F.col("sx"), F.col("y") - F.col("sy")
    in_reach = F.col("sx").isNull() | (dx * dx + dy * dy <= radius * radius)
    met = targets.withColumnsRenamed({"cx": "tx", "cy": "ty"})
    meets = (F.col("cx") == F.col("tx")) & (F.col("cy") == F.col("ty")) & in_reach
    return places.join(met, meets, "left_semi").select("x", "y", "persons")


def service_coverage(activities: DataFrame, stops: DataFrame, radius: float) -> DataFrame:
    """Share of the population that lives within ``radius`` of a stop, one row."""
    places = home_places(person_home(activities))
    reached = covered_places(places, stops, radius)
    sums = (
        places.agg(F.sum("persons").alias("population"))
        .unionByName(reached.agg(F.sum("persons").alias("covered")), allowMissingColumns=True)
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("covered", "population")])
    )
    return sums.select(
        "covered",
        "population",
        F.coalesce(F.try_divide("covered", "population"), F.lit(float("nan"))).alias("service_coverage"),
    )


def population(activities: DataFrame) -> DataFrame:
    """Persons, with or without a plan."""
    return activities.agg(F.countDistinct("person_id").alias("population"))


def network_bounds(nodes: DataFrame, stops: DataFrame, pad: float = 1.0) -> DataFrame:
    """Padded bounding box of network nodes and stops."""
    return (
        nodes.select("x", "y")
        .unionByName(stops.select("x", "y"))
        .agg(
            (F.min("x") - pad).alias("min_x"),
            (F.min("y") - pad).alias("min_y"),
            (F.max("x") + pad).alias("max_x"),
            (F.max("y") + pad).alias("max_y"),
        )
    )
