"""XML scans, record tables in both formats, score files."""

import gzip
import math

import pytest

from headway import schemas as S
from headway.operators.events import valid_events
from headway.operators.scenario import covered_links, person_home
from headway.sources import records as io
from headway.sources import xml

EVENTS = [
    '<event time="1.0" type="TransitDriverStarts" vehicleId="a&amp;b" driverId="pt_1" />',
    '<event time="1.0" type="PersonEntersVehicle" person="p1" vehicle="a&amp;b"/>',
    '<event time="2.5" type="VehicleArrivesAtFacility" vehicle="a&amp;b" facility="s" delay="oops"></event>',
    '<event time="later" type="departure" person="p1"/>',
    '<event time="9" person="p1"/>',
    '<event time="1e1" type="left link" vehicle="x" link="l" extra="ignored"/>',
]


def document(events):
    return '<?xml version="1.0" encoding="utf-8"?>\n<events version="1.0">\n' + "\n".join(events) + "\n</events>\n"


@pytest.mark.parametrize("lines", [False, True])
@pytest.mark.parametrize("name", ["log.xml", "log.xml.gz"])
def test_event_scan(spark, tmp_path, name, lines):
    path = tmp_path / name
    text = document(EVENTS).encode()
    path.write_bytes(gzip.compress(text) if name.endswith("gz") else text)
    log = xml.scan_event_log(spark, str(path), one_per_line=lines)
    assert log.columns == S.EVENTS.names
    got = log.orderBy("seq").collect()
    assert [r.type for r in got] == [
        "TransitDriverStarts", "PersonEntersVehicle", "VehicleArrivesAtFacility", "departure", None, "left link",
    ]
    assert got[0].vehicleId == "a&b" and got[5].time == 10.0 and got[3].time is None
    assert math.isnan(got[2].delay) and math.isnan(got[5].delay)
    assert valid_events(log).count() == 4
    assert valid_events(log, prefix=True).count() == 3


def test_events_on_one_line(spark, tmp_path):
    (tmp_path / "log.xml").write_text("<events>" + "".join(EVENTS) + "</events>")
    assert xml.scan_event_log(spark, str(tmp_path / "log.xml")).count() == 6


@pytest.mark.parametrize("lines", [False, True])
def test_seq_follows_files_and_splits(spark, tmp_path, lines):
    n = 0
    for part in ("a", "b b", "c"):
        body = []
        for _ in range(200):
            body.append(f'<event time="{n}" type="left link" vehicle="v" link="l{n}"/>')
            n += 1
        (tmp_path / f"{part}.xml").write_text(document(body))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        log = xml.scan_event_log(spark, str(tmp_path), one_per_line=lines)
        if lines:
            assert log.rdd.getNumPartitions() > 3
        got = [r.time for r in log.orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [float(i) for i in range(n)]


def test_land_events(spark, tmp_path):
    (tmp_path / "log.xml").write_text(document(EVENTS))
    landed = xml.land_events(spark, str(tmp_path / "log.xml"), str(tmp_path / "landed"))
    assert landed.count() == 6 and landed.columns == S.EVENTS.names


def test_network_schedule_vehicles_population(spark, tmp_path):
    (tmp_path / "net.xml").write_text(
        '<network><nodes><node id="1" x="0.0" y="1.5"/><node id="2" x="3" y="4"/></nodes>'
        '<links><link id="l1" from="1" to="2" length="250.0" freespeed="8"/></links></network>'
    )
    links, nodes = xml.scan_network(spark, str(tmp_path / "net.xml"))
    assert [tuple(r) for r in links.collect()] == [("l1", "1", "2", 250.0)]
    assert sorted(tuple(r) for r in nodes.collect()) == [("1", 0.0, 1.5), ("2", 3.0, 4.0)]

    (tmp_path / "schedule.xml").write_text(
        '<transitSchedule><transitStops><stopFacility id="s1" x="1" y="2" linkRefId="l1"/>'
        '<stopFacility id="s2" x="3" y="4" linkRefId="l4"/></transitStops>'
        '<transitLine id="L"><transitRoute id="R"><transportMode>bus</transportMode>'
        '<routeProfile><stop refId="s1" departureOffset="00:00:00"/><stop refId="s2" arrivalOffset="00:05:00"/></routeProfile>'
        '<route><link refId="l1"/><link refId="l2"/><link refId="l3"/><link refId="l4"/></route>'
        '<departures><departure id="1" departureTime="06:00:00" vehicleRefId="v"/></departures></transitRoute></transitLine>'
        "</transitSchedule>"
    )
    inner, stops = xml.scan_schedule(spark, str(tmp_path / "schedule.xml"))
    assert inner.columns == S.SCENARIO["route_links"].names and stops.columns == S.SCENARIO["route_stops"].names
    assert [tuple(r) for r in inner.orderBy("link_seq").collect()] == [
        ("L", "R", "bus", 1, "l2"), ("L", "R", "bus", 2, "l3"),
    ]
    every, _ = xml.scan_schedule(spark, str(tmp_path / "schedule.xml"), include_terminal_links=True)
    assert every.count() == 4
    assert [tuple(r) for r in stops.orderBy("stop_seq").collect()] == [
        ("L", "R", "bus", 0, "s1", 1.0, 2.0), ("L", "R", "bus", 1, "s2", 3.0, 4.0),
    ]

    (tmp_path / "vehicles.xml").write_text(
        '<vehicleDefinitions><vehicleType id="City-BUS"><length meter="12"/></vehicleType>'
        '<vehicle id="v1" type="City-BUS"/><vehicle id="v2" type="Tram"/></vehicleDefinitions>'
    )
    assert sorted(tuple(r) for r in xml.scan_transit_vehicles(spark, str(tmp_path / "vehicles.xml")).collect()) == [
        ("v1", "City-BUS"), ("v2", "Tram"),
    ]

    plans = (
        '<population><person id="p1"><plan selected="no"><{a} type="home" x="9" y="9"/></plan>'
        '<plan selected="yes"><{a} type="work" x="1" y="1"/><leg mode="pt"/><{a} type="home" x="2" y="3"/></plan></person>'
        '<person id="p2"><plan selected="yes"><{a} type="work" x="1" y="1"/></plan></person></population>'
    )
    for element in ("activity", "act"):
        path = tmp_path / f"{element}.xml"
        path.write_text(plans.format(a=element))
        homes = person_home(xml.scan_population(spark, str(path), element))
        assert sorted(map(tuple, homes.collect())) == [("p1", 2.0, 3.0), ("p2", None, None)]


TRIPS = [
    ("p1", 0.0, 1.5, "pt", []),
    ("p,2", 0.1, 2.0, "car", ["v1"]),
    ("p\"3", 1e-7, float("inf"), "pt", ["v 1", "v,2", 'v"3', "[x]"]),
]


@pytest.mark.parametrize("format", ["csv", "columnar"])
def test_record_round_trip(spark, tmp_path, format):
    for name, rows in {
        "trip_records": TRIPS,
        "bus_delay_records": [("s1", float("nan"), -3.25), ("s2", 1.0, float("nan"))],
        "bus_trip_records": [("v", "l", 0.1 + 0.2, 3.0, True), ("v", "l", 1.0, 0.0, False)],
        "bus_pax_records": [("p", "v")],
    }.items():
        table = spark.createDataFrame(rows, S.RECORDS[name])
        base = str(tmp_path / name)
        assert io.write_table(table, base, format).endswith(io.EXTENSIONS[format])
        back = io.read_table(spark, name, base, format)
        assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows))


@pytest.mark.parametrize("format", ["csv", "columnar"])
def test_empty_table_keeps_its_schema(spark, tmp_path, format):
    for name, schema in S.RECORDS.items():
        io.write_table(spark.createDataFrame([], schema), str(tmp_path / name), format)
        back = io.read_table(spark, name, str(tmp_path / name), format)
        assert back.columns == schema.names and back.count() == 0


def test_bare_lists_are_read_too(spark, tmp_path):
    (tmp_path / "trip_records.csv").write_text(
        "person_id,start_time,travel_time,main_mode,veh_list\n"
        'a,0.0,1.0,pt,"[v1, v2]"\nb,0.0,1.0,pt,[]\nc,0.0,1.0,pt,[7]\nd,0.0,1.0,pt,"[x-1, 7]"\n'
    )
    back = io.read_table(spark, "trip_records", str(tmp_path / "trip_records"), "csv")
    assert {r.person_id: r.veh_list for r in back.collect()} == {
        "a": ["v1", "v2"], "b": [], "c": ["7"], "d": ["x-1", "7"],
    }


def test_conversion_names_its_output(spark, tmp_path):
    source = io.write_table(spark.createDataFrame(TRIPS, S.RECORDS["trip_records"]), str(tmp_path / "trip_records"))
    assert io.columnar_to_csv(spark, source) == str(tmp_path / "trip_records.csv")
    assert io.read_table(spark, "trip_records", str(tmp_path / "trip_records"), "csv").count() == 3


def test_score_file_keeps_odd_numbers(spark, tmp_path):
    score = spark.createDataFrame([(float("nan"), float("inf"), 0.5)], "a double, b double, c double")
    io.write_score(score, str(tmp_path / "score"), history=str(tmp_path / "history"))
    io.write_score(score, str(tmp_path / "score2"), history=str(tmp_path / "history"))
    row = io.read_score(spark, str(tmp_path / "score"), score.schema).collect()[0]
    assert math.isnan(row.a) and row.b == float("inf") and row.c == 0.5
    assert spark.read.parquet(str(tmp_path / "history")).count() == 2


def test_two_link_bus_route_keeps_its_line(spark, tmp_path):
    route = (
        '<transitRoute id="{0}"><transportMode>{1}</transportMode><route>{2}</route></transitRoute>'
    )
    links = lambda ids: "".join(f'<link refId="{i}"/>' for i in ids)
    (tmp_path / "schedule.xml").write_text(
        '<transitSchedule><transitLine id="L">' + route.format("R1", "bus", links("ab"))
        + route.format("R2", "train", links("acdb")) + "</transitLine></transitSchedule>"
    )
    path = str(tmp_path / "schedule.xml")
    routes = xml.scan_routes(spark, path)
    assert sorted(tuple(r) for r in routes.collect()) == [("L", "R1", "bus"), ("L", "R2", "train")]
    inner, _ = xml.scan_schedule(spark, path)
    covered = covered_links(inner, ["bus"], routes)
    assert sorted(r.link_id for r in covered.collect()) == ["c", "d"]
    assert covered_links(inner, ["bus"]).count() == 0


@pytest.mark.parametrize(
    "body",
    [
        "".join(EVENTS[:2]),  # two events on one line
        '<event time="1" type="left link"\n vehicle="x" link="l"/>',  # one event over two lines
        '<events><event time="1" type="left link" vehicle="x" link="l"/>',  # after another element
    ],
)
def test_line_mode_refuses_a_broken_promise(spark, tmp_path, body):
    """Line mode never drops an event: a log that is not one event a line stops the scan."""
    from pyspark.errors import PySparkException

    (tmp_path / "log.xml").write_text(document([body]))
    with pytest.raises((PySparkException, Exception), match="not one event a line"):
        xml.scan_event_log(spark, str(tmp_path / "log.xml"), one_per_line=True).collect()
    assert xml.scan_event_log(spark, str(tmp_path / "log.xml")).count() >= 1  # element mode reads it


def test_seq_beyond_33_and_40_bits_keeps_order(spark, tmp_path):
    """seq packs file rank above bit 40; a second file's events follow all of the first's."""
    for name, t in (("a.xml", 0), ("b.xml", 1)):
        (tmp_path / name).write_text(document([f'<event time="{t}" type="left link" vehicle="v" link="l"/>'] * 3))
    got = xml.scan_event_log(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r.time for r in got] == [0.0] * 3 + [1.0] * 3
    assert got[3].seq >= 1 << 40 > got[2].seq and all(r.seq < 1 << 41 for r in got)
