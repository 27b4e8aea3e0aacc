"""The same queries as SQL for DuckDB, written against the raw tables.

The state machines are plain windows per vehicle or person here; nothing is
shared with the Spark side but the derivation rules of the data.
"""

from __future__ import annotations

import re

# Named subqueries; each may use the ones it names.
CTES = {
    "base": """
        SELECT event_id AS seq, epoch_us(ts) / CAST(1000000 AS DOUBLE) - 1704067200 AS time,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) % 20 AS k,
               user_id, user_id // 5 AS vn, value, event_type
        FROM events""",
    "log": """
        SELECT *,
               CASE WHEN k IN (9, 10, 11, 12, 13) AND value > 60 THEN 'pt_v' || vn ELSE 'p' || user_id END AS person,
               CASE k WHEN 0 THEN 'TransitDriverStarts' WHEN 1 THEN 'vehicle enters traffic'
                      WHEN 2 THEN 'vehicle enters traffic' WHEN 3 THEN 'entered link' WHEN 4 THEN 'entered link'
                      WHEN 5 THEN 'entered link' WHEN 6 THEN 'left link' WHEN 7 THEN 'left link' WHEN 8 THEN 'left link'
                      WHEN 9 THEN 'PersonEntersVehicle' WHEN 10 THEN 'PersonEntersVehicle'
                      WHEN 11 THEN 'PersonEntersVehicle' WHEN 12 THEN 'PersonLeavesVehicle'
                      WHEN 13 THEN 'PersonLeavesVehicle' WHEN 14 THEN 'vehicle leaves traffic'
                      WHEN 15 THEN 'VehicleArrivesAtFacility' WHEN 16 THEN 'VehicleArrivesAtFacility'
                      WHEN 17 THEN 'VehicleDepartsAtFacility' WHEN 18 THEN 'departure' ELSE 'actstart' END AS type,
               'v' || vn AS vehicle, 'pt_v' || vn AS driverId,
               CASE WHEN seq % 11 = 0 THEN NULL WHEN seq % 13 = 0 THEN 'l_missing' ELSE 'l' || (seq % 200) END AS link,
               CASE WHEN seq % 17 <> 0 THEN 's' || (seq % 50) END AS facility,
               value AS delay,
               CASE WHEN event_type = 'error' THEN 'pt interaction' ELSE event_type END AS actType,
               CASE WHEN event_type = 'purchase' THEN 'car' WHEN event_type <> 'signup' THEN 'pt' END AS mode
        FROM base""",
    "flawed": """
        SELECT seq, CASE WHEN seq % 997 <> 500 THEN time END AS time,
               CASE WHEN seq % 991 <> 700 THEN type END AS type, person, vehicle FROM log""",
    "buslog": "SELECT * FROM log WHERE vn % 3 <> 0",
    "km": "SELECT 'l' || p_partkey AS link_id, p_size * CAST(250 AS DOUBLE) / CAST(1000 AS DOUBLE) AS km FROM part",
    "charge": """
        SELECT *, last_value(CASE WHEN k = 0 THEN driverId WHEN k = 14 THEN '' END IGNORE NULLS)
                  OVER (PARTITION BY vehicle ORDER BY seq ROWS UNBOUNDED PRECEDING) AS driver
        FROM buslog""",
    "boardings": """
        SELECT person AS person_id, vehicle AS bus_id, time FROM charge
        WHERE k IN (9, 10, 11) AND driver <> '' AND person <> driver""",
    "charge2": """
        SELECT *, last_value(CASE WHEN k = 0 THEN driverId WHEN k = 14 THEN '' END IGNORE NULLS)
                  OVER (PARTITION BY vehicle ORDER BY seq ROWS UNBOUNDED PRECEDING) AS driver
        FROM buslog WHERE seq % 3 = 2""",
    "boardings2": """
        SELECT person AS person_id, vehicle AS bus_id FROM charge2
        WHERE k IN (9, 10, 11) AND driver <> '' AND person <> driver""",
    "stops_seen": """
        SELECT *, lag(k) OVER w AS pk, lag(facility) OVER w AS pf, lag(delay) OVER w AS pd
        FROM buslog WHERE k = 17 OR (k IN (15, 16) AND facility IS NOT NULL)
        WINDOW w AS (PARTITION BY vehicle ORDER BY seq)""",
    "delays": """
        SELECT pf AS stop_id, pd AS arrival_delay, delay AS depart_delay FROM stops_seen
        WHERE k = 17 AND pk IN (15, 16)""",
    "w3a": """
        SELECT *, k IN (1, 2) AND link IS NOT NULL AS joins,
               k IN (1, 2, 3, 4, 5) AND link IS NOT NULL AS on_link,
               coalesce(last_value(CASE WHEN k IN (1, 2) AND link IS NOT NULL THEN 1 WHEN k = 14 THEN 0 END IGNORE NULLS)
                   OVER (PARTITION BY vehicle ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS active,
               sum(CASE WHEN k IN (1, 2) AND link IS NOT NULL THEN 1 ELSE 0 END)
                   OVER (PARTITION BY vehicle ORDER BY seq ROWS UNBOUNDED PRECEDING) AS seg
        FROM buslog""",
    "w3b": """
        SELECT *, last_value(CASE WHEN on_link THEN link END IGNORE NULLS)
                  OVER (PARTITION BY vehicle, seg ORDER BY seq ROWS UNBOUNDED PRECEDING) AS here,
               last_value(CASE WHEN on_link THEN time END IGNORE NULLS)
                  OVER (PARTITION BY vehicle, seg ORDER BY seq ROWS UNBOUNDED PRECEDING) AS since
        FROM w3a""",
    "w3c": """
        SELECT w3b.*, km,
               last_value(CASE WHEN k = 0 THEN driverId WHEN k = 14 AND active = 1 AND km IS NOT NULL THEN '' END IGNORE NULLS)
                  OVER (PARTITION BY vehicle ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS driver
        FROM w3b LEFT JOIN km ON here = link_id""",
    "w3d": """
        SELECT *, CAST(sum(CASE WHEN active = 1 AND (driver IS NULL OR person <> driver)
                           THEN CASE WHEN k IN (9, 10, 11) THEN 1 WHEN k IN (12, 13) THEN -1 ELSE 0 END ELSE 0 END)
                  OVER (PARTITION BY vehicle, seg ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS pending
        FROM w3c""",
    "w3e": """
        SELECT *, last_value(CASE WHEN joins THEN 0 WHEN on_link THEN pending END IGNORE NULLS)
                  OVER (PARTITION BY vehicle, seg ORDER BY seq ROWS UNBOUNDED PRECEDING) AS pax,
               coalesce(lag(pending) OVER (PARTITION BY vehicle, seg ORDER BY seq), 0) AS pending_before
        FROM w3d""",
    "traversals": """
        SELECT vehicle AS bus_id, here AS link_id, km AS link_length, time - since AS travel_time, pax > 0 AS have_passenger
        FROM w3e WHERE k IN (6, 7, 8, 14) AND active = 1 AND km IS NOT NULL""",
    "w4a": """
        SELECT *, k = 19 AND actType <> 'pt interaction' AS closes, k = 18 AND mode IS NOT NULL AS opens
        FROM log WHERE person NOT LIKE 'pt%'""",
    "w4b": """
        SELECT *, coalesce(sum(CASE WHEN closes THEN 1 ELSE 0 END)
            OVER (PARTITION BY person ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM w4a""",
    "w4c": """
        SELECT *, min(CASE WHEN opens THEN seq END) OVER (PARTITION BY person, seg) AS opener FROM w4b""",
    "ptrips": """
        SELECT person AS person_id, min(CASE WHEN seq = opener THEN time END) AS start_time,
               max(CASE WHEN closes THEN time END) AS end_time,
               max(CASE WHEN seq = opener THEN mode END) AS main_mode,
               list('v' || vn ORDER BY seq) FILTER (WHERE k IN (9, 10, 11) AND seq > opener) AS veh_list,
               seg
        FROM w4c WHERE opener IS NOT NULL GROUP BY person, seg
        HAVING bool_or(closes AND seq > opener) AND bool_or(k IN (9, 10, 11) AND seq > opener AND vn % 3 <> 0)""",
    "pax": """
        SELECT l_orderkey % 4 AS run_id, 'p' || o_custkey AS person_id, 'v' || l_suppkey AS bus_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "bdelay": """
        SELECT l_orderkey % 4 AS run_id, 's' || l_suppkey AS stop_id,
               CASE WHEN l_linenumber <> 7 THEN (l_quantity - 25) * 15 END AS arrival_delay,
               CASE WHEN l_linenumber <> 7 THEN (l_quantity - 25) * 15 + l_linenumber END AS depart_delay
        FROM lineitem""",
    "btrip": """
        SELECT l_orderkey % 4 AS run_id, 'v' || l_suppkey AS bus_id, 'l' || l_partkey AS link_id,
               p_size / CAST(1024 AS DOUBLE) AS link_length, l_quantity * 2 AS travel_time,
               l_returnflag <> 'N' AS have_passenger
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "trip_lines": """
        SELECT *, lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey) AS next_supp
        FROM lineitem""",
    "trip_lists": """
        SELECT l_orderkey, list('v' || l_suppkey ORDER BY l_linenumber, l_suppkey, l_partkey) AS veh_list,
               count(*) AS n_veh, bool_or(l_suppkey % 3 <> 2) AS any_bus,
               bool_or(coalesce(l_suppkey % 3 <> 2 AND next_supp % 3 <> 2, FALSE)) AS changes
        FROM trip_lines GROUP BY l_orderkey""",
    "trips": """
        SELECT o_orderkey % 4 AS run_id, o_orderkey AS trip_id, 'p' || o_custkey AS person_id, CAST(0 AS DOUBLE) AS start_time,
               CAST(o_orderkey % 3600 + 600 AS DOUBLE) AS travel_time,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'car' WHEN '5-LOW' THEN 'walk' ELSE 'pt' END AS main_mode,
               veh_list, n_veh, any_bus, changes
        FROM trip_lists JOIN orders ON l_orderkey = o_orderkey""",
    "rlinks": """
        SELECT CAST(l_suppkey AS VARCHAR) AS line_id, l_suppkey, l_returnflag, 'l' || l_partkey AS link_id,
               CASE WHEN l_suppkey % 50 = 0 AND l_returnflag = 'R' THEN 'bus'
                    WHEN l_suppkey % 50 = 1 AND l_returnflag = 'A' THEN 'pt' ELSE 'train' END AS mode
        FROM lineitem""",
    "kept": "SELECT DISTINCT line_id FROM rlinks WHERE mode IN ('bus', 'pt')",
    "clinks": "SELECT DISTINCT link_id FROM rlinks WHERE line_id IN (SELECT line_id FROM kept)",
    "bstops": """
        SELECT 's' || s_suppkey AS stop_id, CAST(s_suppkey * 6151 % 10007 AS DOUBLE) AS x,
               CAST(s_suppkey * 3571 % 10009 AS DOUBLE) AS y
        FROM supplier WHERE CAST(s_suppkey AS VARCHAR) IN (SELECT line_id FROM kept)""",
    "homes": """
        SELECT 'p' || c_custkey AS person_id, CAST(c_custkey * 7919 % 10007 AS DOUBLE) AS x,
               CAST(c_custkey * 104729 % 10009 AS DOUBLE) AS y FROM customer""",
    "covered": """
        SELECT * FROM homes h WHERE EXISTS (SELECT 1 FROM bstops s
            WHERE (h.x - s.x) * (h.x - s.x) + (h.y - s.y) * (h.y - s.y) <= 160000)""",
    "scn": """
        SELECT (SELECT count(*) FROM homes) AS population,
               (SELECT count(*) FROM covered) / CAST((SELECT count(*) FROM homes) AS DOUBLE) AS service_coverage,
               (SELECT sum(p_size * CAST(250 AS DOUBLE)) FROM part WHERE 'l' || p_partkey IN (SELECT link_id FROM clinks))
                 / (SELECT sum(p_size * CAST(250 AS DOUBLE)) FROM part) AS transit_route_ratio""",
    "counts": """
        SELECT type AS channel, CAST(trunc(time) AS BIGINT) AS second, count(*) AS n FROM log GROUP BY 1, 2
        UNION ALL SELECT '(all)', CAST(trunc(time) AS BIGINT), count(*) FROM log GROUP BY 2""",
    "emitted": """
        SELECT 'bus_pax_records' AS channel, time FROM boardings
        UNION ALL SELECT 'bus_delay_records', time FROM stops_seen WHERE k = 17 AND pk IN (15, 16)
        UNION ALL SELECT 'bus_trip_records', time FROM w3e WHERE k IN (6, 7, 8, 14) AND active = 1 AND km IS NOT NULL
        UNION ALL SELECT 'trip_records', end_time FROM ptrips""",
    "rcounts": """
        SELECT channel, CAST(trunc(time) AS BIGINT) AS second, count(*) AS n FROM emitted GROUP BY 1, 2
        UNION ALL SELECT '(all)', CAST(trunc(time) AS BIGINT), count(*) FROM emitted GROUP BY 2""",
    "weights": """
        SELECT run_id, name, n / CAST(sum(n) OVER (PARTITION BY run_id) AS DOUBLE) AS weight FROM (
            SELECT o_orderkey % 4 AS run_id,
                   CASE o_custkey % 10 WHEN 0 THEN 'bus_effective_travel_distance' WHEN 1 THEN 'bus_efficiency'
                     WHEN 2 THEN 'bus_transfer_rate' WHEN 3 THEN 'on_time_perf' WHEN 4 THEN 'productivity'
                     WHEN 5 THEN 'ridership' WHEN 6 THEN 'service_coverage' WHEN 7 THEN 'transit_auto_time_ratio'
                     WHEN 8 THEN 'transit_route_ratio' ELSE 'travel_time' END AS name,
                   count(*) AS n FROM orders GROUP BY 1, 2)""",
}

METRICS = {
    "ridership": "passengers / CAST(population AS DOUBLE)",
    "travel_time": "exp(-coalesce(pt_seconds, 1e9) / (60 * CAST(54.121 AS DOUBLE)))",
    "transit_auto_time_ratio": "exp(-coalesce(pt_seconds, 1e9) / coalesce(car_seconds, CAST(1 AS DOUBLE)))",
    "on_time_perf": "on_time / CAST(timed AS DOUBLE)",
    "productivity": "exp(-coalesce(hours / nullif(passengers, 0), 0))",
    "bus_efficiency": "exp(-coalesce(km / nullif(passengers, 0), 0))",
    "bus_effective_travel_distance": "loaded_km / nullif(km, 0)",
    "bus_transfer_rate": "CASE WHEN pt_multi > 0 THEN 1 - transfers / CAST(pt_trips AS DOUBLE) ELSE 0 END",
}
SCENARIO_METRICS = ("transit_route_ratio", "service_coverage")
NAMES = [*SCENARIO_METRICS, *METRICS]


def _facts(pax: str, delay: str, btrip: str, trips: str, trip_changes: str, by_run: bool = False) -> str:
    """Record facts, one row or one per run."""
    key, group = ("run_id, ", "GROUP BY run_id") if by_run else ("", "")
    parts = [
        f"SELECT {key}count(DISTINCT person_id) AS passengers, count(*) AS n_pax FROM {pax} {group}",
        f"SELECT {key}count(*) AS timed, count(CASE WHEN arrival_delay >= -180 AND arrival_delay <= 180 THEN 1 END)"
        f" AS on_time FROM {delay} {group}",
        f"SELECT {key}sum(travel_time) / CAST(3600 AS DOUBLE) AS hours, sum(link_length) AS km,"
        f" sum(CASE WHEN have_passenger THEN link_length ELSE 0 END) AS loaded_km, count(*) AS n_bus FROM {btrip} {group}",
        f"SELECT {key}avg(travel_time) FILTER (WHERE main_mode = 'pt') AS pt_seconds,"
        f" avg(travel_time) FILTER (WHERE main_mode = 'car') AS car_seconds,"
        f" count(*) FILTER (WHERE main_mode = 'pt') AS pt_trips,"
        f" count(*) FILTER (WHERE main_mode = 'pt' AND len(veh_list) >= 2) AS pt_multi,"
        f" count(*) FILTER (WHERE main_mode = 'pt' AND {trip_changes}) AS transfers, count(*) AS n_trips"
        f" FROM {trips} {group}",
    ]
    joined = f"({parts[0]}) a"
    for name, part in zip("bcd", parts[1:]):
        joined += f" JOIN ({part}) {name} " + ("USING (run_id)" if by_run else "ON TRUE")
    return f"SELECT * FROM {joined} JOIN scn ON TRUE"


RECORD_FACTS = _facts("pax", "bdelay", "btrip", "trips", "changes")
RUN_FACTS = _facts("pax", "bdelay", "btrip", "trips", "changes", by_run=True)
NO_PAX_FACTS = _facts("(SELECT * FROM pax WHERE bus_id IS NULL)", "bdelay", "btrip", "trips", "changes")
LOG_FACTS = _facts("boardings", "delays", "traversals", "log_trips", "changes")
CTES["log_trips"] = """
    SELECT *, end_time - start_time AS travel_time FROM ptrips LEFT JOIN (
        SELECT DISTINCT person_id, seg, TRUE AS changes FROM (
            SELECT person_id, seg, v, lead(v) OVER (PARTITION BY person_id, seg ORDER BY pos) AS nv FROM (
                SELECT person_id, seg, unnest(veh_list) AS v, unnest(range(len(veh_list))) AS pos FROM ptrips))
        WHERE CAST(substr(v, 2) AS INTEGER) % 3 <> 0 AND CAST(substr(nv, 2) AS INTEGER) % 3 <> 0)
    USING (person_id, seg)"""


def _score(facts: str, zero: tuple[str, ...] = (), weights: dict | None = None, key: str = "") -> str:
    weights = {n: 0.1 for n in NAMES} | (weights or {})
    values = {n: n for n in SCENARIO_METRICS} | {
        n: "CAST(0 AS DOUBLE)" if n in zero else f"coalesce({e}, 0)" for n, e in METRICS.items()
    }
    inner = f"SELECT {key}" + ", ".join(f"{e} AS {n}" for n, e in values.items()) + f" FROM ({facts})"
    total = " + ".join(f"CAST({weights[n]} AS DOUBLE) * {n}" for n in NAMES)
    return f"SELECT {key}" + ", ".join(f"round({n}, 9) AS {n}" for n in NAMES) + f", round({total}, 9) AS final_score FROM ({inner})"


def _metric(name: str) -> str:
    return f"SELECT round({METRICS[name]}, 9) AS {name} FROM ({RECORD_FACTS})"


EVENT_COLUMNS = (
    "time, type, person, vehicle, vehicle AS vehicleId, driverId, link, facility, delay, actType,"
    " mode AS computationalRoutingMode"
)
DELAY_ROWS = "SELECT stop_id, arrival_delay, depart_delay, arrival_delay IS NULL AS missing FROM"
TRIP_ROWS = "SELECT person_id, start_time, travel_time, main_mode, array_to_string(veh_list, ',') AS veh_list FROM trips"
PTRIP_ROWS = (
    "SELECT person_id, start_time, round(end_time - start_time, 6) AS travel_time, main_mode,"
    " array_to_string(veh_list, ',') AS veh_list FROM ptrips"
)
TRAVERSAL_ROWS = (
    "SELECT bus_id, link_id, link_length, round(travel_time, 6) AS travel_time, have_passenger FROM traversals"
)
BOARDING_ROWS = "SELECT person_id, bus_id FROM boardings"
BTRIP_ROWS = "SELECT bus_id, link_id, link_length, travel_time, have_passenger FROM btrip"
NODES = (
    "SELECT 'n' || p_partkey AS node_id, CAST(p_partkey * 7919 % 10007 AS DOUBLE) AS x,"
    " CAST(p_partkey * 104729 % 10009 AS DOUBLE) AS y FROM part"
)
VEHICLES = (
    "SELECT 'v' || s_suppkey AS vehicle_id, CASE s_suppkey % 3 WHEN 0 THEN 'City-BUS' WHEN 1 THEN 'minibus'"
    " ELSE 'Tram' END AS type_id FROM supplier"
)
ROUTES = (
    "SELECT CAST(s_suppkey AS VARCHAR) AS line_id, s_suppkey || '-' || r AS route_id,"
    " CASE WHEN (s_suppkey + r) % 3 = 0 THEN 'bus' ELSE 'train' END AS transport_mode, s_suppkey, r"
    " FROM supplier, (SELECT unnest([0, 1]) AS r)"
)
PEAKS = (
    "SELECT channel, second, n FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY n DESC, second) AS rn"
    " FROM counts) WHERE rn = 1"
)

BODIES = {
    "event_log": f"SELECT seq, {EVENT_COLUMNS} FROM log",
    "scan_event_log": f"SELECT {EVENT_COLUMNS} FROM log",
    "scan_event_lines": BOARDING_ROWS,
    "event_valid_prefix": "SELECT * FROM flawed WHERE seq < (SELECT coalesce(min(seq), 9223372036854775807) FROM flawed"
    " WHERE time IS NULL OR type IS NULL)",
    "event_quarantine": "SELECT * FROM flawed WHERE time IS NOT NULL AND type IS NOT NULL",
    "event_rejects": "SELECT seq, time, type FROM flawed WHERE time IS NULL OR type IS NULL",
    "scan_records_csv": BTRIP_ROWS,
    "scan_records_columnar": BTRIP_ROWS,
    "scan_network": "SELECT 'l' || p_partkey AS link_id, 'n' || p_partkey AS from_node, 'n' || (p_partkey + 1) AS to_node,"
    " p_size * CAST(250 AS DOUBLE) AS length_m FROM part",
    "scan_network_nodes": NODES,
    "scan_schedule": f"SELECT line_id, route_id, transport_mode, i AS link_seq,"
    f" 'l' || ((s_suppkey * 31 + r * 5 + i * 7) % 200) AS link_id"
    f" FROM ({ROUTES}), (SELECT CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS i)",
    "scan_schedule_stops": f"SELECT line_id, route_id, transport_mode, CAST(0 AS INTEGER) AS stop_seq, 's' || s_suppkey AS stop_id,"
    f" CAST(s_suppkey * 6151 % 10007 AS DOUBLE) AS x, CAST(s_suppkey * 3571 % 10009 AS DOUBLE) AS y FROM ({ROUTES})",
    "scan_routes": f"SELECT line_id, route_id, transport_mode FROM ({ROUTES})",
    "covered_links_by_routes": f"SELECT DISTINCT 'l' || ((s_suppkey * 31 + r * 5 + i * 7) % 200) AS link_id"
    f" FROM ({ROUTES}), (SELECT unnest([1, 2, 3, 4]) AS i) WHERE transport_mode <> 'bus'"
    f" AND line_id IN (SELECT line_id FROM ({ROUTES}) WHERE transport_mode = 'bus')",
    "scan_transit_vehicles": VEHICLES,
    "scan_population": "SELECT * FROM homes",
    "sink_columnar_roundtrip": f"{DELAY_ROWS} bdelay",
    "sink_csv_nan": f"{DELAY_ROWS} bdelay",
    "sink_csv_roundtrip": TRIP_ROWS,
    "convert_columnar_to_csv": "SELECT person_id, bus_id FROM pax",
    "attr_cast_nan": "SELECT seq, seq % 7 = 0 OR seq % 5 = 0 AS missing,"
    " CASE WHEN seq % 7 <> 0 AND seq % 5 <> 0 THEN delay END AS delay FROM log",
    "link_length_km": "SELECT link_id, km FROM km",
    "classify_vehicles": "SELECT 'v' || s_suppkey AS vehicle_id, s_suppkey % 3 <> 2 AS is_bus FROM supplier",
    "bus_lines_any_route": "SELECT line_id FROM kept",
    "non_driver_events": "SELECT seq, person FROM log WHERE person NOT LIKE 'pt%'",
    "last_iteration_events": "SELECT seq, CAST(seq % 3 AS INTEGER) AS iteration, type FROM log"
    " WHERE seq % 3 = (SELECT max(seq % 3) FROM log)",
    "last_iteration_boardings": "SELECT person_id, bus_id FROM boardings2",
    "person_home": "SELECT * FROM homes",
    "bus_events": "SELECT seq, type, vehicle AS bus FROM buslog WHERE k < 18",
    "trips_not_blacklisted": "SELECT trip_id, person_id, array_to_string(veh_list, ',') AS veh_list FROM trips WHERE any_bus",
    "bus_boardings": BOARDING_ROWS,
    "bus_stop_delays": "SELECT * FROM delays",
    "bus_active_state": "SELECT seq, vehicle AS bus_id, active = 1 AS active FROM w3a WHERE k IN (1, 2, 3, 4, 5, 6, 7, 8, 14)",
    "bus_occupancy": "SELECT seq, vehicle AS bus_id, CASE WHEN joins THEN"
    " lag_pending ELSE pending_before END AS on_board FROM (SELECT *,"
    " lag(pending) OVER (PARTITION BY vehicle ORDER BY seq) AS lag_pending FROM w3e) WHERE active = 1 AND k NOT IN (15, 16, 17, 18, 19)",
    "bus_link_traversals": TRAVERSAL_ROWS,
    "occupancy_violations": "SELECT seq, vehicle AS bus_id, pending_before AS on_board FROM w3e"
    " WHERE k = 14 AND active = 1 AND pending_before <> 0",
    "person_trips": PTRIP_ROWS,
    "bus_boardings_chunked": BOARDING_ROWS,
    "bus_stop_delays_chunked": "SELECT * FROM delays",
    "bus_link_traversals_chunked": TRAVERSAL_ROWS,
    "person_trips_chunked": PTRIP_ROWS,
    "transit_route_ratio": "SELECT round(transit_route_ratio, 9) AS transit_route_ratio FROM scn",
    "distinct_covered_links": "SELECT link_id FROM clinks",
    "distinct_bus_stops": "SELECT * FROM bstops",
    "service_coverage": "SELECT CAST((SELECT count(*) FROM covered) AS BIGINT) AS covered, CAST(population AS BIGINT) AS population,"
    " round(service_coverage, 9) AS service_coverage FROM scn",
    "covered_places": "SELECT x, y, count(*) AS persons FROM covered GROUP BY x, y",
    "network_bounds": f"SELECT min(x) - 1 AS min_x, min(y) - 1 AS min_y, max(x) + 1 AS max_x, max(y) + 1 AS max_y"
    f" FROM (SELECT x, y FROM ({NODES}) UNION ALL SELECT x, y FROM bstops)",
    "population": "SELECT count(*) AS population FROM customer",
    "throughput_counts": "SELECT * FROM counts",
    "throughput_peaks": PEAKS,
    "record_throughput_counts": "SELECT * FROM rcounts",
    "record_throughput_peaks": PEAKS.replace("FROM counts", "FROM rcounts"),
    "m_ridership": _metric("ridership"),
    "m_on_time": _metric("on_time_perf"),
    "m_travel_time": _metric("travel_time"),
    "m_transit_auto_ratio": _metric("transit_auto_time_ratio"),
    "m_productivity": _metric("productivity"),
    "m_bus_efficiency": _metric("bus_efficiency"),
    "m_effective_distance": _metric("bus_effective_travel_distance"),
    "m_bus_transfer": _metric("bus_transfer_rate"),
    "m_bus_transfer_joined": _metric("bus_transfer_rate"),
    "m_revenue_hours": "SELECT round(coalesce(sum(travel_time) / CAST(3600 AS DOUBLE), 0), 6) AS service_hours FROM btrip"
    " WHERE have_passenger",
    "score_record": _score(RECORD_FACTS),
    "final_score": f"SELECT final_score FROM ({_score(RECORD_FACTS)})",
    "score_gated": _score(
        RECORD_FACTS,
        zero=("ridership", "productivity"),
        weights={"ridership": 0.0, "productivity": 0.0, "travel_time": 0.2, "service_coverage": 0.2},
    ),
    "score_empty_source": _score(NO_PAX_FACTS, zero=("ridership", "productivity", "bus_efficiency")),
    "scores_by_run": _score(RUN_FACTS, key="run_id, "),
    "sink_score_json": _score(RUN_FACTS, key="run_id, "),
    "weights_check": "SELECT run_id, count(*) AS n_weights, round(sum(weight), 9) AS total,"
    " count(*) = 10 AND abs(sum(weight) - 1) < 1e-9 AS valid FROM weights GROUP BY run_id",
    "weighted_scores": "SELECT run_id, round(sum(value * weight), 9) AS final_score FROM ("
    + " UNION ALL ".join(
        f"SELECT run_id, '{n}' AS name, coalesce({METRICS.get(n, n)}, 0) AS value FROM ({RUN_FACTS})" for n in NAMES
    )
    + ") JOIN weights USING (run_id, name) GROUP BY run_id",
    "analysis": _score(LOG_FACTS),
    "analysis_csv": _score(LOG_FACTS),
    "stream_bus_boardings": BOARDING_ROWS,
    "stream_out_of_order": BOARDING_ROWS,
    "stream_record_throughput": "SELECT * FROM rcounts",
    "stream_bus_stop_delays": "SELECT * FROM delays",
    "stream_bus_link_traversals": TRAVERSAL_ROWS,
    "stream_person_trips": PTRIP_ROWS,
    "stream_throughput": "SELECT * FROM counts WHERE channel <> '(all)'",
    "stream_iteration_filter": "SELECT person_id, bus_id FROM boardings2",
    "stream_fanout": "SELECT 'bus_pax_records' AS record_table, count(*) AS n FROM boardings"
    " UNION ALL SELECT 'bus_delay_records', count(*) FROM delays"
    " UNION ALL SELECT 'bus_trip_records', count(*) FROM traversals"
    " UNION ALL SELECT 'trip_records', count(*) FROM ptrips",
}


def _used(text: str) -> set[str]:
    """Names of the subqueries a text needs, their own needs included."""
    found: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"\b\w+\b", todo.pop()))
        for name in CTES.keys() & words - found:
            found.add(name)
            todo.append(CTES[name])
    return found


def sql(name: str) -> str:
    body = BODIES[name]
    used = _used(body)
    order: list[str] = []

    def place(cte: str) -> None:
        if cte in order:
            return
        for other in re.findall(r"\b\w+\b", CTES[cte]):
            if other in CTES and other != cte:
                place(other)
        order.append(cte)

    for cte in sorted(used):
        place(cte)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{c} AS ({CTES[c].strip()})" for c in order) + "\n" + body


ORACLES = {name: sql(name) for name in BODIES}
