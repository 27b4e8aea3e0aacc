"""One Spark query per operator, all over the whole derived tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas as S
from headway.config import Params, Weights
from headway.functions.columns import to_double_or_nan
from headway.operators import events as ev
from headway.operators import scenario as sc
from headway.operators import throughput as tp
from headway.operators import traversals as tv
from headway.operators import trips as tr
from headway.operators.boardings import bus_boardings
from headway.operators.delays import bus_stop_delays
from headway.plans import metrics as M
from headway.plans import score as SC
from headway.plans.analysis import Scenario, analyse, score_records
from headway.session import scratch
from headway.sources import records as io
from headway.sources import xml
from headway.streaming import jobs as st
from workload import tables as T

PARAMS = Params(productivity_baseline=1.0)
WEIGHTS = Weights()
# Two metrics switched off, their weight moved to others.
GATED = Weights(ridership=0.0, productivity=0.0, travel_time=0.2, service_coverage=0.2)


def _buses(spark, sf) -> DataFrame:
    """Buses among the vehicles of the event log."""
    return sc.buses(T.log_vehicles(spark, sf), PARAMS.bus_types)


def _blacklist(spark, sf) -> DataFrame:
    return sc.blacklist(T.log_vehicles(spark, sf), PARAMS.bus_types)


def _km(spark, sf) -> DataFrame:
    return sc.link_km(T.links(spark, sf))


def _record_buses(spark, sf) -> DataFrame:
    """Buses among the vehicles of the record tables."""
    return sc.buses(T.transit_vehicles(spark, sf), PARAMS.bus_types)


def _text(items="veh_list") -> Column:
    return F.array_join(items, ",").alias("veh_list")


def _trip_rows(trips: DataFrame) -> DataFrame:
    return trips.select(
        "person_id", "start_time", F.round("travel_time", 6).alias("travel_time"), "main_mode", _text()
    )


def _traversal_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "bus_id", "link_id", "link_length", F.round("travel_time", 6).alias("travel_time"), "have_passenger"
    )


def _delay_rows(rows: DataFrame) -> DataFrame:
    """NaN shown as null plus a flag."""
    return rows.select(
        "stop_id",
        *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("arrival_delay", "depart_delay")],
        F.isnan("arrival_delay").alias("missing"),
    )


# --- scans and sinks -----------------------------------------------------------


def event_log(spark, sf):
    return T.event_log(spark, sf)


def _xml_log(spark, sf) -> str:
    """The event log written as XML files whose order is the order of ``seq``."""
    path = scratch(spark, "xml-log")
    log = T.event_log(spark, sf)
    attributes = log.select(
        "seq", *[F.col(c).cast("string").alias(f"_{c}") for c in ("time", "type", *S.EVENT_ATTRIBUTES)]
    )
    ordered = attributes.repartitionByRange("seq").sortWithinPartitions("seq").drop("seq")
    ordered.write.format("xml").option("rootTag", "events").option("rowTag", "event").save(path)
    return path


def scan_event_log(spark, sf):
    return xml.scan_event_log(spark, _xml_log(spark, sf)).drop("seq")


def scan_event_lines(spark, sf):
    """Parallel line scan; a record table shows that file order was kept."""
    log = xml.land_events(spark, _xml_log(spark, sf), scratch(spark, "landed"), one_per_line=True)
    return bus_boardings(log, _buses(spark, sf))


def event_valid_prefix(spark, sf):
    return ev.valid_events(T.flawed_log(spark, sf), prefix=True).select("seq", "time", "type", "person", "vehicle")


def event_quarantine(spark, sf):
    return ev.valid_events(T.flawed_log(spark, sf)).select("seq", "time", "type", "person", "vehicle")


def event_rejects(spark, sf):
    return ev.rejects(T.flawed_log(spark, sf)).select("seq", "time", "type")


def _stored(spark, sf, name: str, format: str) -> DataFrame:
    """A record table written and read back."""
    table = T.records(spark, sf)[name].select(S.RECORDS[name].names)
    base = f"{scratch(spark, 'records')}/{name}"
    io.write_table(table, base, format)
    return io.read_table(spark, name, base, format)


def scan_records_csv(spark, sf):
    return _stored(spark, sf, "bus_trip_records", "csv")


def scan_records_columnar(spark, sf):
    return _stored(spark, sf, "bus_trip_records", "columnar")


def sink_columnar_roundtrip(spark, sf):
    return _delay_rows(_stored(spark, sf, "bus_delay_records", "columnar"))


def sink_csv_nan(spark, sf):
    return _delay_rows(_stored(spark, sf, "bus_delay_records", "csv"))


def sink_csv_roundtrip(spark, sf):
    return _trip_rows(_stored(spark, sf, "trip_records", "csv"))


def convert_columnar_to_csv(spark, sf):
    base = f"{scratch(spark, 'convert')}/bus_pax_records"
    io.columnar_to_csv(spark, io.write_table(T.bus_pax(spark, sf).drop("run_id"), base))
    return io.read_table(spark, "bus_pax_records", base, "csv")


def _attributes(df: DataFrame, **names: str) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(f"_{a}") for a, c in names.items()])


def _write_xml(df: DataFrame, root: str, row: str) -> str:
    path = scratch(df.sparkSession, row)
    df.write.format("xml").option("rootTag", root).option("rowTag", row).save(path)
    return path


def _network(spark, sf) -> tuple[DataFrame, DataFrame]:
    links = _attributes(
        T.links(spark, sf), **{"id": "link_id", "from": "from_node", "to": "to_node", "length": "length_m"}
    )
    nodes = _attributes(T.nodes(spark, sf), id="node_id", x="x", y="y")
    return (
        xml.scan_network(spark, _write_xml(links, "links", "link"))[0],
        xml.scan_network(spark, _write_xml(nodes, "nodes", "node"))[1],
    )


def scan_network(spark, sf):
    return _network(spark, sf)[0]


def scan_network_nodes(spark, sf):
    return _network(spark, sf)[1]


def _schedule(spark, sf) -> list[str]:
    """Files of a schedule with one line of two routes per supplier, six links each."""
    key = F.col("s_suppkey")

    def route(number: int) -> Column:
        at = lambda i, step: ((key * 31 + F.lit(number * 5) + i * step) % 200).cast("string")
        return F.struct(
            F.concat_ws("-", key.cast("string"), F.lit(number)).alias("_id"),
            F.when((key + number) % 3 == 0, "bus").otherwise("train").alias("transportMode"),
            F.struct(F.array(F.struct(F.concat(F.lit("s"), key.cast("string")).alias("_refId"))).alias("stop")).alias(
                "routeProfile"
            ),
            F.struct(
                F.transform(
                    F.sequence(F.lit(0), F.lit(5)), lambda i: F.struct(F.concat(F.lit("l"), at(i, 7)).alias("_refId"))
                ).alias("link")
            ).alias("route"),
        )

    suppliers = T.raw(spark, sf, "supplier")
    lines = suppliers.select(key.cast("string").alias("_id"), F.array(route(0), route(1)).alias("transitRoute"))
    stops = suppliers.select(
        T.tag("s", "s_suppkey").alias("_id"),
        ((key * 6151) % 10007).cast("double").alias("_x"),
        ((key * 3571) % 10009).cast("double").alias("_y"),
    )
    paths = [_write_xml(lines, "transitSchedule", "transitLine"), _write_xml(stops, "transitStops", "stopFacility")]
    return [f"{p}/*" for p in paths]


def scan_schedule(spark, sf):
    return xml.scan_schedule(spark, _schedule(spark, sf))[0]


def scan_schedule_stops(spark, sf):
    return xml.scan_schedule(spark, _schedule(spark, sf))[1]


def scan_routes(spark, sf):
    return xml.scan_routes(spark, _schedule(spark, sf))


def covered_links_by_routes(spark, sf):
    """Lines are kept by their routes, though the links of bus routes are not given."""
    paths = _schedule(spark, sf)
    links = xml.scan_schedule(spark, paths)[0].filter("transport_mode <> 'bus'")
    return sc.covered_links(links, PARAMS.bus_modes, xml.scan_routes(spark, paths))


def scan_transit_vehicles(spark, sf):
    rows = _attributes(T.transit_vehicles(spark, sf), id="vehicle_id", type="type_id")
    return xml.scan_transit_vehicles(spark, _write_xml(rows, "vehicleDefinitions", "vehicle"))


def scan_population(spark, sf):
    """Homes found in a population file with a selected and a rejected plan each."""
    key = F.col("c_custkey")
    x = ((key * 7919) % 10007).cast("double")
    y = ((key * 104729) % 10009).cast("double")
    act = lambda kind, dx: F.struct(F.lit(kind).alias("_type"), (x + dx).alias("_x"), y.alias("_y"))
    plan = lambda chosen, *acts: F.struct(F.lit(chosen).alias("_selected"), F.array(*acts).alias("activity"))
    people = T.raw(spark, sf, "customer").select(
        T.tag("p", "c_custkey").alias("_id"),
        F.array(
            plan("no", act("home", 900.0)), plan("yes", act("work", 50.0), act("home", 0.0), act("home", 5000.0))
        ).alias("plan"),
    )
    return sc.person_home(xml.scan_population(spark, _write_xml(people, "population", "person")))


# --- projections and filters -----------------------------------------------------


def attr_cast_nan(spark, sf):
    seq = F.col("seq")
    text = F.when(seq % 7 == 0, "n/a").when(seq % 5 != 0, F.col("delay").cast("string"))
    parsed = to_double_or_nan(text)
    return T.event_log(spark, sf).select(
        "seq", F.isnan(parsed).alias("missing"), F.when(~F.isnan(parsed), parsed).alias("delay")
    )


def link_length_km(spark, sf):
    return _km(spark, sf)


def classify_vehicles(spark, sf):
    return sc.classify_vehicles(T.transit_vehicles(spark, sf), PARAMS.bus_types)


def bus_lines_any_route(spark, sf):
    return sc.bus_lines(T.route_links(spark, sf), PARAMS.bus_modes)


def non_driver_events(spark, sf):
    return ev.non_driver_events(T.event_log(spark, sf)).select("seq", "person")


def last_iteration_events(spark, sf):
    log = T.event_log(spark, sf).withColumn("iteration", (F.col("seq") % 3).cast("int"))
    return ev.last_iteration(log).select("seq", "iteration", "type")


def last_iteration_boardings(spark, sf):
    log = T.event_log(spark, sf).withColumn("iteration", (F.col("seq") % 3).cast("int"))
    return bus_boardings(ev.last_iteration(log), _buses(spark, sf))


def person_home(spark, sf):
    return sc.person_home(T.activities(spark, sf))


def bus_events(spark, sf):
    kinds = sorted(set(T.KINDS) - {S.DEPARTURE, S.ACTIVITY_START})
    return ev.bus_events(T.event_log(spark, sf), _buses(spark, sf), *kinds).select("seq", "type", "bus")


def trips_not_blacklisted(spark, sf):
    banned = sc.blacklist(T.transit_vehicles(spark, sf), PARAMS.bus_types)
    kept = tr.trips_not_blacklisted(T.trips(spark, sf), banned, "trip_id")
    return kept.select("trip_id", "person_id", _text())


# --- state machines ---------------------------------------------------------------


def boardings(spark, sf):
    return bus_boardings(T.event_log(spark, sf), _buses(spark, sf))


def stop_delays(spark, sf):
    return bus_stop_delays(T.event_log(spark, sf), _buses(spark, sf))


def active_state(spark, sf):
    return tv.bus_active_state(T.event_log(spark, sf), _buses(spark, sf))


def occupancy(spark, sf):
    return tv.bus_occupancy(T.event_log(spark, sf), _buses(spark, sf), _km(spark, sf))


def traversals(spark, sf):
    return _traversal_rows(tv.bus_link_traversals(T.event_log(spark, sf), _buses(spark, sf), _km(spark, sf)))


def violations(spark, sf):
    return tv.occupancy_violations(T.event_log(spark, sf), _buses(spark, sf), _km(spark, sf)).drop("time")


def person_trips(spark, sf):
    return _trip_rows(tr.person_trips(T.event_log(spark, sf), _blacklist(spark, sf)))


# The same four state machines by the range-partitioned prefix scan, on a log whose
# order column has wide, uneven gaps (as byte offsets of a text log have).


def _sparse_log(spark, sf) -> DataFrame:
    seq = F.col("seq")
    return T.event_log(spark, sf).withColumn("seq", seq * 1_000_003 + F.pmod(seq, F.lit(13)))


def boardings_chunked(spark, sf):
    return bus_boardings(_sparse_log(spark, sf), _buses(spark, sf), ranged=True)


def stop_delays_chunked(spark, sf):
    return bus_stop_delays(_sparse_log(spark, sf), _buses(spark, sf), ranged=True)


def traversals_chunked(spark, sf):
    log = _sparse_log(spark, sf)
    return _traversal_rows(tv.bus_link_traversals(log, _buses(spark, sf), _km(spark, sf), ranged=True))


def person_trips_chunked(spark, sf):
    return _trip_rows(tr.person_trips(_sparse_log(spark, sf), _blacklist(spark, sf), ranged=True))


# --- scenario ----------------------------------------------------------------------


def transit_route_ratio(spark, sf):
    ratio = sc.transit_route_ratio(T.links(spark, sf), T.route_links(spark, sf), PARAMS.bus_modes)
    return ratio.select(F.round("transit_route_ratio", 9).alias("transit_route_ratio"))


def distinct_covered_links(spark, sf):
    return sc.covered_links(T.route_links(spark, sf), PARAMS.bus_modes)


def distinct_bus_stops(spark, sf):
    return sc.bus_stops(T.route_stops(spark, sf), PARAMS.bus_modes)


def _coverage(spark, sf) -> DataFrame:
    stops = sc.stop_places(T.route_stops(spark, sf), PARAMS.bus_modes)
    return sc.service_coverage(T.activities(spark, sf), stops, PARAMS.coverage_radius)


def service_coverage(spark, sf):
    return _coverage(spark, sf).withColumn("service_coverage", F.round("service_coverage", 9))


def covered_places(spark, sf):
    places = sc.home_places(sc.person_home(T.activities(spark, sf)))
    stops = sc.stop_places(T.route_stops(spark, sf), PARAMS.bus_modes)
    return sc.covered_places(places, stops, PARAMS.coverage_radius)


def network_bounds(spark, sf):
    return sc.network_bounds(T.nodes(spark, sf), sc.bus_stops(T.route_stops(spark, sf), PARAMS.bus_modes))


def population(spark, sf):
    return sc.population(T.activities(spark, sf))


# --- throughput ----------------------------------------------------------------------


def _totals_named(counts: DataFrame) -> DataFrame:
    return counts.fillna("(all)", ["channel"])


def throughput_counts(spark, sf):
    return _totals_named(tp.throughput_counts(T.event_log(spark, sf)))


def _record_counts(spark, sf) -> DataFrame:
    """Records of the four tables per second of the event that completes them."""
    events, buses = T.event_log(spark, sf), _buses(spark, sf)
    return tp.record_throughput(
        {
            "bus_pax_records": bus_boardings(events, buses, emitted=True),
            "bus_delay_records": bus_stop_delays(events, buses, emitted=True),
            "bus_trip_records": tv.bus_link_traversals(events, buses, _km(spark, sf), emitted=True),
            "trip_records": tr.person_trips(events, _blacklist(spark, sf), emitted=True),
        }
    )


def record_throughput_counts(spark, sf):
    return _totals_named(_record_counts(spark, sf))


def record_throughput_peaks(spark, sf):
    return _totals_named(tp.throughput_peaks(_record_counts(spark, sf)))


def throughput_peaks(spark, sf):
    return _totals_named(tp.throughput_peaks(tp.throughput_counts(T.event_log(spark, sf))))


# --- metrics ---------------------------------------------------------------------------


def _one(facts: DataFrame, name: str, metric: Column) -> DataFrame:
    return facts.select(F.round(metric, 9).alias(name))


def _population(spark, sf) -> Column:
    return sc.population(T.activities(spark, sf)).scalar()


def _pax_and_bus_trips(spark, sf) -> DataFrame:
    rows = M.pax_facts(T.bus_pax(spark, sf)).unionByName(
        M.bus_trip_facts(T.bus_trip(spark, sf)), allowMissingColumns=True
    )
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def m_ridership(spark, sf):
    return _one(M.pax_facts(T.bus_pax(spark, sf)), "ridership", M.ridership(_population(spark, sf)))


def m_on_time(spark, sf):
    return _one(M.delay_facts(T.bus_delay(spark, sf), PARAMS), "on_time_perf", M.on_time())


def m_travel_time(spark, sf):
    return _one(M.trip_facts(T.trips(spark, sf)), "travel_time", M.travel_time(PARAMS))


def m_transit_auto_ratio(spark, sf):
    return _one(M.trip_facts(T.trips(spark, sf)), "transit_auto_time_ratio", M.transit_auto_ratio())


def m_productivity(spark, sf):
    return _one(_pax_and_bus_trips(spark, sf), "productivity", M.productivity(PARAMS))


def m_bus_efficiency(spark, sf):
    return _one(_pax_and_bus_trips(spark, sf), "bus_efficiency", M.bus_efficiency())


def m_effective_distance(spark, sf):
    return _one(M.bus_trip_facts(T.bus_trip(spark, sf)), "bus_effective_travel_distance", M.effective_distance())


def m_bus_transfer(spark, sf):
    facts = M.trip_and_transfer_facts(T.trips(spark, sf), _record_buses(spark, sf))
    return _one(facts, "bus_transfer_rate", M.bus_transfer_rate())


def m_bus_transfer_joined(spark, sf):
    """The form for fleets too large for a set in the expression."""
    trips = T.trips(spark, sf)
    rows = M.trip_facts(trips).unionByName(
        M.transfer_facts(trips, _record_buses(spark, sf)), allowMissingColumns=True
    )
    facts = rows.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("n_trips", "pt_trips", "pt_multi", "transfers")])
    return _one(facts, "bus_transfer_rate", M.bus_transfer_rate())


def m_revenue_hours(spark, sf):
    return M.bus_trip_facts(T.bus_trip(spark, sf)).select(F.round(M.revenue_hours(), 6).alias("service_hours"))


# --- scores ------------------------------------------------------------------------------


def _rounded(score: DataFrame, *by: str) -> DataFrame:
    return score.select(*by, *[F.round(c, 9).alias(c) for c in SC.SCORE_COLUMNS])


def _score(spark, sf, weights=WEIGHTS, record=True, **swap) -> DataFrame:
    tables = {**T.records(spark, sf), **swap}
    return score_records(tables, T.scenario(spark, sf), PARAMS, weights, record)


def score_record(spark, sf):
    return _rounded(_score(spark, sf))


def final_score(spark, sf):
    return _score(spark, sf).select(F.round("final_score", 9).alias("final_score"))


def score_gated(spark, sf):
    return _rounded(_score(spark, sf, GATED, record=False))


def score_empty_source(spark, sf):
    """No boardings at all: no line item carries this flag."""
    orders = T.raw(spark, sf, "orders")
    none = T.raw(spark, sf, "lineitem").filter("l_returnflag = '?'").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    empty = none.select(T.tag("p", "o_custkey").alias("person_id"), T.tag("v", "l_suppkey").alias("bus_id"))
    return _rounded(_score(spark, sf, bus_pax_records=empty))


def _run_scores(spark, sf) -> DataFrame:
    scenario = T.scenario(spark, sf)
    facts = M.facts(T.records(spark, sf), scenario.buses(PARAMS), PARAMS, ["run_id"])
    return SC.score(facts, scenario.facts(PARAMS), PARAMS, WEIGHTS, by=["run_id"])


def scores_by_run(spark, sf):
    return _rounded(_run_scores(spark, sf), "run_id")


def weights_check(spark, sf):
    return SC.check_weights(T.weights_by_run(spark, sf), ["run_id"]).withColumn("total", F.round("total", 9))


def weighted_scores(spark, sf):
    scores = SC.weighted_scores(_run_scores(spark, sf), T.weights_by_run(spark, sf), ["run_id"])
    return scores.select("run_id", F.round("final_score", 9).alias("final_score"))


def sink_score_json(spark, sf):
    path = scratch(spark, "score")
    score = _run_scores(spark, sf)
    io.write_score(score, path)
    return _rounded(io.read_score(spark, path, score.schema), "run_id")


def _log_scenario(spark, sf) -> Scenario:
    base = T.scenario(spark, sf)
    return Scenario(**{**vars(base), "transit_vehicles": T.log_vehicles(spark, sf)})


def analysis(spark, sf):
    """Event log to score, through written record tables."""
    score = analyse(T.event_log(spark, sf), _log_scenario(spark, sf), scratch(spark, "analysis"), PARAMS, WEIGHTS)
    return _rounded(score)


def analysis_csv(spark, sf):
    out = scratch(spark, "analysis")
    return _rounded(analyse(T.event_log(spark, sf), _log_scenario(spark, sf), out, PARAMS, WEIGHTS, "csv"))


# --- streams -----------------------------------------------------------------------------


def _streamed(spark: SparkSession, job, lateness: str = st.LATENESS) -> DataFrame:
    """Run ``job(ends, lateness)`` to the end of the log."""
    out, ends = scratch(spark, "stream"), scratch(spark, "ends")
    stream = job(st.end_marks(spark, ends), lateness)
    st.run_to_end(stream, out, ends)
    return spark.read.schema(stream.schema).parquet(out)


def stream_bus_boardings(spark, sf):
    log, buses = T.event_stream(spark, sf), _buses(spark, sf)
    return st.records(_streamed(spark, lambda *w: st.stream_bus_boardings(log, buses, *w)))


def stream_out_of_order(spark, sf):
    """The log in files whose order of arrival has nothing to do with time."""
    path = scratch(spark, "log")
    log = T.event_log(spark, sf)
    part = F.pmod(F.floor(F.col("seq") / 500) * 7, F.lit(4))
    for i in (2, 0, 3, 1):
        log.filter(part == i).write.mode("append").parquet(path)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(path)
    buses = _buses(spark, sf)
    return st.records(_streamed(spark, lambda *w: st.stream_bus_boardings(stream, buses, *w), "60 days"))


def stream_bus_stop_delays(spark, sf):
    log, buses = T.event_stream(spark, sf), _buses(spark, sf)
    return st.records(_streamed(spark, lambda *w: st.stream_bus_stop_delays(log, buses, *w)))


def stream_bus_link_traversals(spark, sf):
    log, buses, km = T.event_stream(spark, sf), _buses(spark, sf), _km(spark, sf)
    return _traversal_rows(st.records(_streamed(spark, lambda *w: st.stream_bus_link_traversals(log, buses, km, *w))))


def stream_person_trips(spark, sf):
    log, banned = T.event_stream(spark, sf), _blacklist(spark, sf)
    return _trip_rows(st.records(_streamed(spark, lambda *w: st.stream_person_trips(log, banned, *w))))


def stream_throughput(spark, sf):
    out = scratch(spark, "throughput")
    st.start_throughput(st.stream_throughput(T.event_stream(spark, sf)), out).awaitTermination()
    return st.read_throughput(spark, out)


def stream_iteration_filter(spark, sf):
    stream = T.event_stream(spark, sf).withColumn("iteration", (F.col("seq") % 3).cast("int"))
    log, buses = st.stream_iteration_filter(stream, 2), _buses(spark, sf)
    return st.records(_streamed(spark, lambda *w: st.stream_bus_boardings(log, buses, *w)))


def _fan_out(spark, sf) -> dict[str, DataFrame]:
    out, ends = scratch(spark, "fanout"), scratch(spark, "ends")
    for last in (False, True):
        if last:
            st.mark_end(spark, ends)
        queries = st.start_fan_out(
            T.event_stream(spark, sf), _buses(spark, sf), _blacklist(spark, sf), _km(spark, sf), out,
            st.end_marks(spark, ends),
        )
        for query in queries.values():
            query.awaitTermination()
    return {name: st.records(spark.read.parquet(f"{out}/{name}"), emitted=True) for name in queries}


def stream_fanout(spark, sf):
    counts = [
        table.agg(F.lit(name).alias("record_table"), F.count(F.lit(1)).alias("n"))
        for name, table in _fan_out(spark, sf).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def stream_record_throughput(spark, sf):
    """Records of the streamed tables per second of the event that completes them."""
    return _totals_named(tp.record_throughput(_fan_out(spark, sf)))


QUERIES = {
    # scans and sinks
    "event_log": event_log,
    "scan_event_log": scan_event_log,
    "scan_event_lines": scan_event_lines,
    "event_valid_prefix": event_valid_prefix,
    "event_quarantine": event_quarantine,
    "event_rejects": event_rejects,
    "scan_records_csv": scan_records_csv,
    "scan_records_columnar": scan_records_columnar,
    "scan_network": scan_network,
    "scan_network_nodes": scan_network_nodes,
    "scan_schedule": scan_schedule,
    "scan_schedule_stops": scan_schedule_stops,
    "scan_routes": scan_routes,
    "covered_links_by_routes": covered_links_by_routes,
    "scan_transit_vehicles": scan_transit_vehicles,
    "scan_population": scan_population,
    "sink_columnar_roundtrip": sink_columnar_roundtrip,
    "sink_csv_nan": sink_csv_nan,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "convert_columnar_to_csv": convert_columnar_to_csv,
    # projections and filters
    "attr_cast_nan": attr_cast_nan,
    "link_length_km": link_length_km,
    "classify_vehicles": classify_vehicles,
    "bus_lines_any_route": bus_lines_any_route,
    "non_driver_events": non_driver_events,
    "last_iteration_events": last_iteration_events,
    "last_iteration_boardings": last_iteration_boardings,
    "person_home": person_home,
    "bus_events": bus_events,
    "trips_not_blacklisted": trips_not_blacklisted,
    # state machines
    "bus_boardings": boardings,
    "bus_stop_delays": stop_delays,
    "bus_active_state": active_state,
    "bus_occupancy": occupancy,
    "bus_link_traversals": traversals,
    "bus_boardings_chunked": boardings_chunked,
    "bus_stop_delays_chunked": stop_delays_chunked,
    "bus_link_traversals_chunked": traversals_chunked,
    "person_trips_chunked": person_trips_chunked,
    "occupancy_violations": violations,
    "person_trips": person_trips,
    # scenario
    "transit_route_ratio": transit_route_ratio,
    "distinct_covered_links": distinct_covered_links,
    "distinct_bus_stops": distinct_bus_stops,
    "service_coverage": service_coverage,
    "covered_places": covered_places,
    "network_bounds": network_bounds,
    "population": population,
    # throughput
    "throughput_counts": throughput_counts,
    "throughput_peaks": throughput_peaks,
    "record_throughput_counts": record_throughput_counts,
    "record_throughput_peaks": record_throughput_peaks,
    # metrics
    "m_ridership": m_ridership,
    "m_on_time": m_on_time,
    "m_travel_time": m_travel_time,
    "m_transit_auto_ratio": m_transit_auto_ratio,
    "m_productivity": m_productivity,
    "m_bus_efficiency": m_bus_efficiency,
    "m_effective_distance": m_effective_distance,
    "m_bus_transfer": m_bus_transfer,
    "m_bus_transfer_joined": m_bus_transfer_joined,
    "m_revenue_hours": m_revenue_hours,
    # scores
    "score_record": score_record,
    "final_score": final_score,
    "score_gated": score_gated,
    "score_empty_source": score_empty_source,
    "scores_by_run": scores_by_run,
    "weights_check": weights_check,
    "weighted_scores": weighted_scores,
    "sink_score_json": sink_score_json,
    "analysis": analysis,
    "analysis_csv": analysis_csv,
    # streams
    "stream_bus_boardings": stream_bus_boardings,
    "stream_bus_stop_delays": stream_bus_stop_delays,
    "stream_bus_link_traversals": stream_bus_link_traversals,
    "stream_person_trips": stream_person_trips,
    "stream_throughput": stream_throughput,
    "stream_iteration_filter": stream_iteration_filter,
    "stream_fanout": stream_fanout,
    "stream_out_of_order": stream_out_of_order,
    "stream_record_throughput": stream_record_throughput,
}
