"""Event-log operators: hand-written cases and random logs against the definitions."""

import logs
from logs import event, frame, ids, kms

from headway import schemas as S
from headway.operators.boardings import bus_boardings
from headway.operators.delays import bus_stop_delays
from headway.operators.events import last_iteration, valid_events
from headway.operators.traversals import bus_link_traversals, occupancy_violations
from headway.operators.trips import person_trips

KM = {"A": 1.0, "B": 2.0}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def start(v="b", d="pt_1"):
    return event(S.DRIVER_STARTS, vehicleId=v, driverId=d)


def on(p, v="b", t=0):
    return event(S.PERSON_ENTERS, t, person=p, vehicle=v)


def off(p, v="b", t=0):
    return event(S.PERSON_LEAVES, t, person=p, vehicle=v)


def traffic(link, t, v="b"):
    return event(S.ENTERS_TRAFFIC, t, vehicle=v, link=link)


def enter(link, t, v="b"):
    return event(S.ENTERED_LINK, t, vehicle=v, link=link)


def left(t, v="b"):
    return event(S.LEFT_LINK, t, vehicle=v)


def leaves(t, v="b"):
    return event(S.LEAVES_TRAFFIC, t, vehicle=v)


def arrives(stop, delay, v="b"):
    return event(S.ARRIVES, vehicle=v, facility=stop, delay=delay)


def departs(delay, v="b"):
    return event(S.DEPARTS, vehicle=v, delay=delay)


def leg(mode, t=0, p="p"):
    return event(S.DEPARTURE, t, person=p, computationalRoutingMode=mode)


def act(kind, t, p="p"):
    return event(S.ACTIVITY_START, t, person=p, actType=kind)


def board(spark, *events):
    return rows(bus_boardings(frame(spark, events), ids(spark, ["b"])))


def pairs(spark, *events):
    return rows(bus_stop_delays(frame(spark, events), ids(spark, ["b"])))


def moves(spark, *events):
    return rows(bus_link_traversals(frame(spark, events), ids(spark, ["b"]), kms(spark, KM)))


def journeys(spark, *events, banned=("tram",)):
    return rows(person_trips(frame(spark, events), ids(spark, banned)))


def test_driver_is_no_passenger_and_leaving_ends_the_run(spark):
    assert board(spark, start(), on("pt_1"), on("p1"), leaves(5), on("p2")) == [("p1", "b")]
    assert board(spark, on("p1"), start(), on("p1"), on("p1")) == [("p1", "b"), ("p1", "b")]
    assert board(spark, start(v="car"), on("p1", v="car")) == []


def test_stop_pairing(spark):
    assert pairs(spark, departs(9), arrives("s1", 1), arrives("s2", 2), departs(3), departs(4)) == [("s2", 2, 3)]
    assert pairs(spark, arrives("s1", 1), arrives(None, 2), departs(3)) == [("s1", 1, 3)]


def test_occupancy_counts_from_the_next_link(spark):
    got = moves(
        spark, start(), on("pt_1"), traffic("A", 0), on("p1", t=1), left(10), enter("B", 10), left(30), off("p1"), leaves(40)
    )
    assert got == [("b", "A", 1.0, 10.0, False), ("b", "B", 2.0, 20.0, True), ("b", "B", 2.0, 30.0, True)]


def test_driver_never_counts(spark):
    assert moves(spark, start(), traffic("A", 0), on("pt_1"), enter("B", 5), left(6)) == [("b", "B", 2.0, 1.0, False)]


def test_two_exits_give_two_rows_and_rejoining_resets(spark):
    assert moves(spark, traffic("A", 0), left(1), left(2)) == [("b", "A", 1.0, 1.0, False), ("b", "A", 1.0, 2.0, False)]
    got = moves(spark, traffic("A", 0), on("p1"), traffic("B", 5), enter("A", 6), left(7))
    assert got == [("b", "A", 1.0, 1.0, False)]


def test_unknown_link_gives_no_row_and_keeps_the_driver(spark):
    got = moves(
        spark, start(), traffic("nowhere", 0), left(1), leaves(2), traffic("A", 3), on("pt_1"), enter("B", 4), left(5)
    )
    assert got == [("b", "B", 2.0, 1.0, False)]
    got = moves(spark, start(), traffic("A", 0), leaves(2), traffic("A", 3), on("pt_1"), enter("B", 4), left(5))
    assert got == [("b", "A", 1.0, 2.0, False), ("b", "B", 2.0, 1.0, True)]


def test_everybody_counts_without_a_driver(spark):
    log = [traffic("A", 0), on("p1"), enter("B", 1), left(2)]
    assert moves(spark, *log) == [("b", "B", 2.0, 1.0, True)]
    assert board(spark, *log) == []


def test_passenger_left_on_board_is_reported(spark):
    log = frame(spark, [traffic("A", 0), on("p1"), on("p2"), off("p1"), leaves(5)])
    bad = occupancy_violations(log, ids(spark, ["b"]), kms(spark, KM)).collect()
    assert [(r.bus_id, r.time, r.on_board) for r in bad] == [("b", 5.0, 1)]


def test_trips_need_a_vehicle_off_the_blacklist(spark):
    assert journeys(spark, leg("walk", 1), act("work", 9)) == []
    assert journeys(spark, leg("pt", 1), on("p", "tram"), act("work", 9)) == []
    assert journeys(spark, leg("pt", 1), on("p", "tram"), on("p", "b"), act("work", 9)) == [
        ("p", 1.0, 8.0, "pt", ["tram", "b"])
    ]


def test_first_departure_with_a_mode_opens_the_trip(spark):
    got = journeys(spark, on("p"), leg(None, 0), leg("pt", 1), on("p"), leg("car", 2), act("work", 9))
    assert got == [("p", 1.0, 8.0, "pt", ["b"])]


def test_only_transit_interaction_keeps_a_trip_open(spark):
    got = journeys(
        spark, leg("pt", 0), on("p"), act("pt interaction", 3), on("p", "c"), act("car interaction", 5), on("p", "d"), act("work", 9)
    )
    assert got == [("p", 0.0, 5.0, "pt", ["b", "c"])]
    assert journeys(spark, leg("pt", 0, "pt_1"), on("pt_1"), act("work", 3, "pt_1")) == []


def test_equal_times_are_told_apart_by_seq(spark):
    assert board(spark, leaves(0), start(), on("p1")) == [("p1", "b")]
    assert board(spark, start(), leaves(0), on("p1")) == []


def test_valid_prefix_and_quarantine(spark):
    log = frame(spark, [start(), on("p1"), {**on("p2"), "time": None}, on("p3"), {**on("p4"), "type": None}])
    assert [r.seq for r in valid_events(log).orderBy("seq").collect()] == [0, 1, 3]
    assert [r.seq for r in valid_events(log, prefix=True).orderBy("seq").collect()] == [0, 1]
    good = frame(spark, [start(), on("p1")])
    assert valid_events(good, prefix=True).count() == 2


def test_last_iteration(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (2, 1)], "seq long, iteration int")
    assert sorted(r.seq for r in last_iteration(df).collect()) == [1, 2]
    assert [r.seq for r in last_iteration(df, 0).collect()] == [0]


def test_random_logs(spark, skewed):
    log = logs.random_log(len(skewed), 500)
    df, buses, km = frame(spark, log), ["v0", "v1"], {"a": 0.5, "b": 1.5, "c": 2.5}
    b = ids(spark, buses)
    assert rows(bus_boardings(df, b)) == sorted(logs.boardings(log, buses), key=repr)
    # Compared as text: NaN is unlike itself.
    assert repr(rows(bus_stop_delays(df, b))) == repr(logs.delays(log, buses))
    want, bad = logs.traversals(log, buses, km)
    assert rows(bus_link_traversals(df, b, kms(spark, km))) == sorted(want, key=repr)
    assert rows(occupancy_violations(df, b, kms(spark, km)).drop("seq")) == sorted(bad, key=repr)
    assert rows(person_trips(df, ids(spark, ["v2", "v1"]))) == sorted(logs.trips(log, ["v2", "v1"]), key=repr)
    assert len(want) > 20 and bad and logs.trips(log, ["v2", "v1"])


def _sparse(df):
    """The same order with gaps past 2^40 between events, as byte offsets of large logs have."""
    from pyspark.sql import functions as F

    return df.withColumn("seq", F.col("seq") * (1 << 41) + F.pmod("seq", F.lit(7)))


def test_random_logs_ranged(spark):
    """Range-partitioned prefix scans: keys spread over many partitions, results unchanged."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        log = logs.random_log(11, 900, vehicles=2, persons=2)
        df, buses, km = _sparse(frame(spark, log)), ["v0", "v1"], {"a": 0.5, "b": 1.5, "c": 2.5}
        b = ids(spark, buses)
        assert rows(bus_boardings(df, b, ranged=True)) == sorted(logs.boardings(log, buses), key=repr)
        assert repr(rows(bus_stop_delays(df, b, ranged=True))) == repr(logs.delays(log, buses))
        want, _ = logs.traversals(log, buses, km)
        assert rows(bus_link_traversals(df, b, kms(spark, km), ranged=True)) == sorted(want, key=repr)
        blacklist = ids(spark, ["v1"])
        assert rows(person_trips(df, blacklist, ranged=True)) == sorted(logs.trips(log, ["v1"]), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_ranged_chunks_are_balanced(spark):
    """One key with most rows still fills every partition about equally; it spans them all."""
    from pyspark.sql import functions as F

    from headway.operators.prefix import CHUNK, by_range

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        df = spark.range(30_000).select(
            (F.col("id") * 977).alias("seq"), F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("k")
        )
        seen = {}

        def recipe(ordered):
            seen["spans"] = sorted(r.k for r in ordered.spans.collect())
            return ordered.df

        sizes = [r["count"] for r in by_range(df, "k", recipe).groupBy(CHUNK).count().collect()]
        assert max(sizes) <= 2 * sum(sizes) / len(sizes) and sum(sizes) == 30_000
        assert "hot" in seen["spans"] and len(seen["spans"]) < 6
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
