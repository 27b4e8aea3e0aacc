"""Cases outside of what the test tables hold."""

import math

from headway.operators.delays import delay_log
from headway.operators.scenario import population
from headway.operators.skew import HEAVY_ROWS_CONF, heavy_keys
from headway.operators.throughput import record_throughput, throughput_counts
from headway.plans.score import SCORE_COLUMNS, weighted_scores
from headway.sources.records import read_table, write_table


def test_csv_keeps_odd_ids(spark, tmp_path):
    ids = [" p1", "v ", "", "a\nb", 'q"u', "c,d", "\\"]
    rows = [(p, b) for p in ids for b in ids]
    df = spark.createDataFrame(rows, "person_id string, bus_id string")
    write_table(df, str(tmp_path / "pax"), "csv")
    back = read_table(spark, "bus_pax_records", str(tmp_path / "pax"), "csv")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_missing_delay_is_nan(spark):
    events = spark.createDataFrame(
        [(1, 1.0, "VehicleArrivesAtFacility", "b", "s", None, None), (2, 2.0, "VehicleDepartsAtFacility", "b", None, 3.0, None)],
        "seq long, time double, type string, vehicle string, facility string, delay double, vehicleId string",
    )
    buses = spark.createDataFrame([("b",)], "vehicle_id string")
    found = {r.seq: r.delay for r in delay_log(events, buses).collect()}
    assert math.isnan(found[1]) and found[2] == 3.0


def test_odd_times_are_counted(spark):
    events = spark.createDataFrame(
        [("a", math.nan), ("a", 0.5), ("a", math.inf), (None, 1.0), ("a", None)], "type string, time double"
    )
    rows = {(r.channel, r.second): r.n for r in throughput_counts(events).collect()}
    assert rows == {("a", 0): 2, ("a", (1 << 63) - 1): 1, (None, 0): 2, (None, (1 << 63) - 1): 1}


def test_heavy_keys_are_found_by_rows(spark):
    df = spark.range(2000).selectExpr("'v' AS k")
    spark.conf.set(HEAVY_ROWS_CONF, "1000")
    try:
        assert [r.k for r in heavy_keys(df, ["k"]).collect()] == ["v"]
    finally:
        spark.conf.unset(HEAVY_ROWS_CONF)


def test_persons_without_plans_count(spark):
    rows = [("a", True, 0, "home", 1.0, 2.0), ("b", False, None, None, None, None)]
    schema = "person_id string, selected boolean, act_seq int, act_type string, x double, y double"
    assert population(spark.createDataFrame(rows, schema)).first()[0] == 2


def test_records_per_second(spark):
    table = lambda times: spark.createDataFrame([(t,) for t in times], "emitted_at double")
    counts = record_throughput({"a": table([1.0, 1.9, math.nan]), "b": table([1.5]), "c": table([])})
    assert {(r.channel, r.second): r.n for r in counts.collect()} == {
        ("a", 1): 2, ("a", 0): 1, ("b", 1): 1, (None, 1): 3, (None, 0): 1,
    }


def test_missing_weight_gives_no_score(spark):
    columns = [c for c in SCORE_COLUMNS if c != "final_score"]
    scores = spark.createDataFrame([(r, *[1.0] * len(columns), 0.0) for r in (1, 2)], ["run_id", *columns, "final_score"])
    weights = spark.createDataFrame(
        [(r, c, 0.1) for r in (1, 2) for c in columns if (r, c) != (2, columns[0])], "run_id long, name string, weight double"
    )
    got = {r.run_id: r.final_score for r in weighted_scores(scores, weights, ["run_id"]).collect()}
    assert abs(got[1] - 0.1 * len(columns)) < 1e-9 and got[2] is None
