"""End to end: event log and scenario tables in, record tables and score out."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from headway.config import Params, Weights
from headway.operators import scenario as sc
from headway.operators.boardings import bus_boardings
from headway.operators.delays import bus_stop_delays
from headway.operators.events import heavy_vehicles, valid_events
from headway.operators.traversals import bus_link_traversals
from headway.operators.trips import person_trips
from headway.plans.metrics import facts
from headway.plans.score import scenario_facts, score
from headway.plans.store import EventStore, land_events
from headway.session import stage
from headway.sources.records import read_table, write_table


@dataclass(frozen=True)
class Scenario:
    links: DataFrame
    nodes: DataFrame
    route_links: DataFrame
    route_stops: DataFrame
    transit_vehicles: DataFrame
    activities: DataFrame
    #: Modes of all routes; without it a line is known by its route links and stops.
    routes: DataFrame | None = None

    def written(self) -> Scenario:
        """The same with links and vehicles worked out once, so each use reads a table of known size."""
        return replace(
            self, links=stage(self.links, "links"), transit_vehicles=stage(self.transit_vehicles, "vehicles")
        )

    def buses(self, params: Params) -> DataFrame:
        return sc.buses(self.transit_vehicles, params.bus_types)

    def blacklist(self, params: Params) -> DataFrame:
        return sc.blacklist(self.transit_vehicles, params.bus_types)

    def facts(self, params: Params) -> DataFrame:
        stops = sc.stop_places(self.route_stops, params.bus_modes, self.routes)
        return scenario_facts(
            sc.service_coverage(self.activities, stops, params.coverage_radius),
            sc.transit_route_ratio(self.links, self.route_links, params.bus_modes, self.routes),
        )


def extract_records(
    events: DataFrame, scenario: Scenario, params: Params, store: EventStore | None = None
) -> dict[str, DataFrame]:
    """The four record tables of an event log, or of the log landed in ``store``."""
    if store is not None:
        buses, km = scenario.buses(params), sc.link_km(scenario.links)
        vehicles, by_bus = store.vehicles()
        persons, by_person = store.persons()
        return {
            "bus_pax_records": bus_boardings(vehicles, buses, ranged=by_bus),
            "bus_delay_records": bus_stop_delays(vehicles, buses, ranged=by_bus),
            "bus_trip_records": bus_link_traversals(vehicles, buses, km, ranged=by_bus),
            "trip_records": person_trips(persons, scenario.blacklist(params), ranged=by_person),
        }
    events = valid_events(events)
    buses, km = scenario.buses(params), sc.link_km(scenario.links)
    heavy = heavy_vehicles(events)
    return {
        "bus_pax_records": bus_boardings(events, buses, heavy),
        "bus_delay_records": bus_stop_delays(events, buses, heavy),
        "bus_trip_records": bus_link_traversals(events, buses, km, heavy),
        "trip_records": person_trips(events, scenario.blacklist(params)),
    }


def score_records(
    records: dict[str, DataFrame], scenario: Scenario, params: Params, weights: Weights, record: bool = True
) -> DataFrame:
    return score(
        facts(records, scenario.buses(params), params), scenario.facts(params), params, weights, record
    )


def analyse(
    events: DataFrame,
    scenario: Scenario,
    out: str,
    params: Params = Params(),
    weights: Weights = Weights(),
    format: str = "columnar",
    record: bool = True,
    landed: bool = True,
) -> DataFrame:
    """Write the four record tables below ``out`` and score what was written.

    ``record`` works out metrics of weight zero as well, for the score record.
    ``landed``: the raw log is read once into an event store that all four
    extractors share (:mod:`headway.plans.store`); the store is dropped afterwards.
    The scenario's links and vehicles, which every extractor asks for, are written once.
    """
    spark = events.sparkSession
    scenario = scenario.written()
    store = land_events(events) if landed else None
    written = {}
    try:
        for name, table in extract_records(events, scenario, params, store).items():
            base = f"{out.rstrip('/')}/{name}"
            write_table(table, base, format, mode="overwrite")
            written[name] = read_table(spark, name, base, format)
    finally:
        if store is not None:
            store.drop()
    return score_records(written, scenario, params, weights, record)
