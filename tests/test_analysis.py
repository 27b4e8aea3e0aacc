"""From an XML event log to a score."""

import logs
import pytest

from headway.config import Params, Weights
from headway.plans.analysis import Scenario, analyse, extract_records
from headway.sources import xml

KM = {"a": 0.5, "b": 1.5, "c": 2.5}


@pytest.fixture(scope="module")
def scenario(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return Scenario(
        links=make([(k, "n1", "n2", v * 1000) for k, v in KM.items()], "link_id string, from_node string, to_node string, length_m double"),
        nodes=make([("n1", 0.0, 0.0), ("n2", 900.0, 0.0)], "node_id string, x double, y double"),
        route_links=make([("L", "R", "bus", 0, "a")], "line_id string, route_id string, transport_mode string, link_seq int, link_id string"),
        route_stops=make([("L", "R", "bus", 0, "s1", 0.0, 0.0)], "line_id string, route_id string, transport_mode string, stop_seq int, stop_id string, x double, y double"),
        transit_vehicles=make([("v0", "Bus"), ("v1", "minibus"), ("v2", "tram")], "vehicle_id string, type_id string"),
        activities=make(
            [("p0", True, 0, "home", 300.0, 0.0), ("p1", True, 0, "home", 500.0, 0.0)],
            "person_id string, selected boolean, act_seq int, act_type string, x double, y double",
        ),
    )


def test_records_of_heavy_vehicles(spark, scenario, skewed):
    log = logs.random_log(19, 400)
    got = extract_records(logs.frame(spark, log), scenario, Params())
    assert got["bus_pax_records"].count() == len(logs.boardings(log, ["v0", "v1"]))
    assert got["bus_delay_records"].count() == len(logs.delays(log, ["v0", "v1"]))
    assert got["bus_trip_records"].count() == len(logs.traversals(log, ["v0", "v1"], KM)[0])
    assert got["trip_records"].count() == len(logs.trips(log, ["v2"]))


@pytest.mark.parametrize("format", ["columnar", "csv"])
def test_xml_to_score(spark, scenario, tmp_path, format):
    log = logs.random_log(19, 400)
    with open(tmp_path / "events.xml", "w") as f:
        f.write("<events>\n")
        for e in log:
            given = {k: v for k, v in e.items() if v is not None and v == v}
            f.write("<event " + " ".join(f'{k}="{v}"' for k, v in given.items()) + "/>\n")
        f.write("</events>\n")
    events = xml.land_events(spark, str(tmp_path / "events.xml"), str(tmp_path / "events"))
    out = str(tmp_path / "out")
    (row,) = analyse(events, scenario, out, Params(productivity_baseline=1.0), Weights(), format).collect()
    assert row.service_coverage == 0.5 and row.transit_route_ratio == pytest.approx(0.5 / 4.5)
    boarded = {p for p, _ in logs.boardings(log, ["v0", "v1"])}
    assert row.ridership == pytest.approx(len(boarded) / 2)
    moved = logs.traversals(log, ["v0", "v1"], KM)[0]
    assert row.bus_effective_travel_distance == pytest.approx(sum(m[2] for m in moved if m[4]) / sum(m[2] for m in moved))


def test_event_store_needs_no_exchange_by_vehicle(spark):
    """Landed once, the events reach the windows of all bus operators without a shuffle by bus."""
    from headway.plans.store import land_events
    from workload import queries as Q
    from workload import tables as T

    sf = "/root/testdata/sf0.001"
    events, scenario = T.event_log(spark, sf), Q._log_scenario(spark, sf)
    store = land_events(events)
    try:
        got = extract_records(events, scenario, Q.PARAMS, store)
        want = extract_records(events, scenario, Q.PARAMS)
        for name in got:
            assert sorted(map(repr, got[name].collect())) == sorted(map(repr, want[name].collect()))
        for name in ("bus_pax_records", "bus_delay_records"):
            plan = got[name]._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(bus" not in plan and "rangepartitioning" not in plan
            assert store.table in plan
    finally:
        store.drop()
