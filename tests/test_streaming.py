"""Streams fed in several micro-batches give what the batch operators give."""

import json

import logs
import pytest
from pyspark.sql import functions as F

from headway import schemas as S
from headway.operators.boardings import bus_boardings
from headway.operators.delays import bus_stop_delays
from headway.operators.throughput import throughput_counts
from headway.operators.traversals import bus_link_traversals
from headway.operators.trips import person_trips
from headway.streaming import jobs

KM = {"a": 0.5, "b": 1.5, "c": 2.5}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def log(spark):
    return logs.frame(spark, logs.random_log(19, 400)).cache()


@pytest.fixture(scope="module")
def dims(spark):
    return logs.ids(spark, ["v0", "v1"]), logs.ids(spark, ["v2", "v1"]), logs.kms(spark, KM)


def feed(log, folder, part, low, high):
    log.filter(f"seq >= {low} AND seq < {high}").coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, source, job, folder, files=16, finish=True):
    """Runs over what is there now, and to the end of the log if it is complete."""
    ends, out = str(folder / "ends"), str(folder / "out")
    stream = job(jobs.landed_events(spark, str(source), files), jobs.end_marks(spark, ends))
    if finish:
        jobs.run_to_end(stream, out, ends)
    else:
        jobs.start(stream, out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def test_fan_out_over_batches_equals_batch(spark, log, dims, tmp_path):
    buses, banned, km = dims
    source, out, ends = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ends")
    for part, (low, high) in enumerate([(0, 90), (90, 250), (250, 400), (400, 400)]):
        if part < 3:
            feed(log, source, part, low, high)
        else:
            jobs.mark_end(spark, ends)
        stream, marks = jobs.landed_events(spark, str(source)), jobs.end_marks(spark, ends)
        for query in jobs.start_fan_out(stream, buses, banned, km, out, marks, "5 seconds").values():
            query.awaitTermination()
    want = {
        "bus_pax_records": bus_boardings(log, buses, emitted=True),
        "bus_delay_records": bus_stop_delays(log, buses, emitted=True),
        "bus_trip_records": bus_link_traversals(log, buses, km, emitted=True),
        "trip_records": person_trips(log, banned, emitted=True),
    }
    for name, table in want.items():
        stored = spark.read.parquet(f"{out}/{name}")
        assert repr(rows(jobs.records(stored, emitted=True).select(table.columns))) == repr(rows(table)), name
        assert jobs.late_rows(stored).count() == 0 and table.count() > 0


def test_later_half_first_equals_batch(spark, log, dims, tmp_path):
    buses, source = dims[0], tmp_path / "in"
    for part, (low, high) in enumerate([(200, 400), (0, 200)]):
        feed(log, source, part, low, high)
    stored = run(spark, source, lambda *s: jobs.stream_bus_boardings(s[0], buses, s[1], "1 hour"), tmp_path, files=1)
    assert rows(jobs.records(stored)) == rows(bus_boardings(log, buses))
    assert jobs.late_rows(stored).count() == 0


def test_blocks_do_not_change_results(log):
    import pandas as pd

    from headway.streaming import processors as P

    table = log.filter("vehicle = 'v0'").toPandas()
    whole = pd.DataFrame(
        {"type": table["type"], "person": table["person"], "starting": table["driverId"], "time": table["time"]}
    )
    at_once, end = P.Boardings().advance("v0", whole, P.Boardings().blank())
    parts, carry = [], P.Boardings().blank()
    for at in range(0, len(whole), 7):
        out, carry = P.Boardings().advance("v0", whole[at : at + 7].reset_index(drop=True), carry)
        parts.append(out)
    assert pd.concat(parts, ignore_index=True).values.tolist() == at_once.values.tolist() and carry == end


def test_late_rows_come_out_whole(spark, log, dims, tmp_path):
    buses, source = dims[0], tmp_path / "in"
    job = lambda *s: jobs.stream_bus_boardings(s[0], buses, s[1], "0 seconds")
    for part, (low, high) in enumerate([(0, 100), (200, 300), (100, 200)]):
        feed(log, source, part, low, high)
        stored = run(spark, source, job, tmp_path, finish=part == 2)
    late = {r[0]: json.loads(r[1]) for r in jobs.late_rows(stored).collect()}
    assert late and all(100 <= seq < 200 and row["seq"] == seq for seq, row in late.items())
    in_time = log.filter(~F.col("seq").isin(list(late)))
    assert rows(jobs.records(stored)) == rows(bus_boardings(in_time.filter("seq < 300"), buses))


def test_iterations_do_not_mix(spark, log, dims, tmp_path):
    tagged = log.selectExpr("*", "CAST(seq % 2 AS INT) AS iteration")
    tagged.write.parquet(str(tmp_path / "in"))
    ends = str(tmp_path / "ends")
    stream = spark.readStream.schema(tagged.schema).parquet(str(tmp_path / "in"))
    only = jobs.stream_iteration_filter(stream, 1)
    job = jobs.stream_bus_boardings(only, dims[0], jobs.end_marks(spark, ends))
    jobs.run_to_end(job, str(tmp_path / "out"), ends)
    want = bus_boardings(tagged.filter("iteration = 1"), dims[0])
    assert rows(jobs.records(spark.read.parquet(str(tmp_path / "out")))) == rows(want)


def test_throughput(spark, log, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for part, (low, high) in enumerate([(0, 150), (150, 400)]):
        feed(log, source, part, low, high)
        stream = spark.readStream.schema(S.EVENTS).parquet(str(source))
        jobs.start_throughput(jobs.stream_throughput(stream), out).awaitTermination()
    want = throughput_counts(log).filter("channel IS NOT NULL")
    assert rows(jobs.read_throughput(spark, out)) == rows(want)
