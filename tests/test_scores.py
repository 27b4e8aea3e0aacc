"""Metrics and scores at their edges."""

import math

import pytest

from headway import schemas as S
from headway.config import WEIGHT_KEYS, Params, Weights
from headway.plans.metrics import facts
from headway.plans.score import SCORE_COLUMNS, check_weights, score

PARAMS = Params(travel_time_baseline=1.0, productivity_baseline=1.0)
NAN = float("nan")


def made(spark, pax=(), delays=(), bus_trips=(), trips=()):
    given = dict(zip(S.RECORDS, (pax, delays, bus_trips, trips)))
    return {n: spark.createDataFrame(list(rows), S.RECORDS[n]) for n, rows in given.items()}


def scored(spark, records, buses=("b1", "b2"), weights=Weights(), record=True, population=4):
    b = spark.createDataFrame([(v,) for v in buses], "vehicle_id string")
    scenario = spark.createDataFrame(
        [(population, 0.5, 0.25)], "population long, service_coverage double, transit_route_ratio double"
    )
    rows = score(facts(records, b, PARAMS), scenario, PARAMS, weights, record).collect()
    assert len(rows) == 1 and list(rows[0].asDict()) == list(SCORE_COLUMNS)
    return rows[0]


def trip(mode, seconds, *vehicles):
    return ("p", 0.0, float(seconds), mode, list(vehicles))


def test_empty_tables_score_zero(spark):
    r = scored(spark, made(spark))
    assert sum(r[c] for c in SCORE_COLUMNS[2:-1]) == 0.0
    assert r.final_score == pytest.approx(0.075)


def test_all_metrics(spark):
    r = scored(
        spark,
        made(
            spark,
            pax=[("p1", "b1"), ("p1", "b2"), ("p2", "b1")],
            delays=[("s", -180.0, 0.0), ("s", 180.0, 0.0), ("s", 180.5, 0.0), ("s", NAN, 0.0)],
            bus_trips=[("b1", "l", 1.0, 3600.0, True), ("b1", "l", 3.0, 3600.0, False), ("b1", "l", float("inf"), 0.0, True)],
            trips=[trip("pt", 60, "b1", "x", "b2"), trip("pt", 120, "b1", "b2"), trip("pt", 0, "b1"), trip("car", 30, "c")],
        ),
    )
    assert r.ridership == 0.5 and r.on_time_perf == 0.5
    assert r.travel_time == pytest.approx(math.exp(-1)) and r.transit_auto_time_ratio == pytest.approx(math.exp(-2))
    assert r.productivity == pytest.approx(math.exp(-1)) and r.bus_efficiency == 0.0
    assert r.bus_effective_travel_distance == 0.25
    assert r.bus_transfer_rate == pytest.approx(2 / 3)
    assert r.final_score == pytest.approx(sum(0.1 * r[c] for c in SCORE_COLUMNS[:-1]))


def test_transfers_with_odd_ids(spark):
    b1, b2 = "bus'\\1", 'bus"2'
    trips = [
        trip("pt", 1, b1, b2, b1), trip("pt", 1, b1, b2, b1), trip("pt", 1, b1, "x", b2),
        trip("car", 1, b1, b2), trip("pt", 1), trip("pt", 1, "x", b1, b1),
    ]
    assert scored(spark, made(spark, trips=trips), buses=(b1, b2)).bus_transfer_rate == pytest.approx(1 - 3 / 5)


def test_single_vehicle_trips_have_no_transfer_rate(spark):
    assert scored(spark, made(spark, trips=[trip("pt", 1, "b1"), trip("pt", 1, "b2")])).bus_transfer_rate == 0.0
    assert scored(spark, made(spark, trips=[trip("pt", 1, "x", "y")])).bus_transfer_rate == 1.0
    assert scored(spark, made(spark, trips=[trip("pt", 1, "b1", "b2")]), buses=()).bus_transfer_rate == 1.0


def test_missing_modes(spark):
    no_pt = scored(spark, made(spark, trips=[trip("car", 60, "c")]))
    assert no_pt.travel_time == 0.0 and no_pt.transit_auto_time_ratio == 0.0 and no_pt.bus_transfer_rate == 0.0
    no_car = scored(spark, made(spark, trips=[trip("pt", 2, "b1")]))
    assert no_car.transit_auto_time_ratio == pytest.approx(math.exp(-2))


def test_nan_delays_and_zero_lengths(spark):
    r = scored(spark, made(spark, delays=[("s", NAN, NAN)], bus_trips=[("b", "l", 0.0, 1.0, True)]))
    assert r.on_time_perf == 0.0 and r.bus_effective_travel_distance == 0.0
    assert r.productivity == 0.0  # no boardings recorded


def test_odd_scenario_values_pass_through(spark):
    b = spark.createDataFrame([], "vehicle_id string")
    scenario = spark.createDataFrame(
        [(0, NAN, 0.25)], "population long, service_coverage double, transit_route_ratio double"
    )
    row = score(facts(made(spark, pax=[("p", "b")]), b, PARAMS), scenario, PARAMS, Weights()).collect()[0]
    assert math.isnan(row.service_coverage) and row.ridership == 0.0 and math.isnan(row.final_score)


def test_zero_weight_switches_a_metric_off_unless_recorded(spark):
    weights = Weights(ridership=0.0, travel_time=0.2)
    records = made(spark, pax=[("p1", "b1")])
    assert scored(spark, records, weights=weights, record=False).ridership == 0.0
    kept = scored(spark, records, weights=weights, record=True)
    assert kept.ridership == 0.25 and kept.final_score == pytest.approx(0.075)


def test_weights_must_sum_to_one():
    with pytest.raises(ValueError):
        Weights(ridership=0.0)
    given = {key: 0 for key in WEIGHT_KEYS.values()} | {"bus_transfer": 1}
    assert Weights.from_config(given).bus_transfer_rate == 1.0


def test_weight_table_check(spark):
    rows = [(1, n, 0.1) for n in WEIGHT_KEYS] + [(2, n, 0.09) for n in WEIGHT_KEYS] + [(3, "ridership", 1.0)]
    df = spark.createDataFrame(rows, "run_id int, name string, weight double")
    assert {r.run_id: r.valid for r in check_weights(df, ["run_id"]).collect()} == {1: True, 2: False, 3: False}
