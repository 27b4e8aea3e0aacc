"""Spatial coverage and key-skew helpers against brute force."""

import random

import pytest

from headway.operators import scenario as sc
from headway.operators.skew import heavy_keys, lookup


def points(spark, rows, name):
    return spark.createDataFrame([(f"{name}{i}", float(x), float(y)) for i, (x, y) in enumerate(rows)], "id string, x double, y double")


@pytest.mark.parametrize("radius", [1.0, 400.0])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_coverage_matches_all_pairs(spark, radius, broadcast):
    rng = random.Random(7)
    spot = lambda spread: (rng.uniform(-spread, spread) * radius, rng.uniform(-spread, spread) * radius)
    # A third of all homes within one cell, exact borders, negative coordinates.
    homes = [spot(9) for _ in range(300)] + [(rng.random() * 0.1 * radius, 0.1 * radius) for _ in range(150)]
    stops = [spot(9) for _ in range(25)] + [(5 * radius, 0.0), (5 * radius, 0.0)]
    homes += [(4 * radius, 0.0), (6 * radius, 0.0), (5 * radius, radius), (5 * radius, -radius)]
    want = sum(any((hx - x) ** 2 + (hy - y) ** 2 <= radius * radius for x, y in stops) for hx, hy in homes)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        places = sc.home_places(points(spark, [*homes], "h"))
        got = sc.covered_places(places, points(spark, stops, "s"), radius).agg({"persons": "sum"}).collect()[0][0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == want and 0 < want < len(homes)


def test_person_without_home_is_not_covered(spark):
    activities = spark.createDataFrame(
        [("a", True, 0, "work", 0.0, 0.0), ("a", False, 0, "home", 0.0, 0.0), ("b", True, 0, "home", 0.0, 0.0)],
        "person_id string, selected boolean, act_seq int, act_type string, x double, y double",
    )
    row = sc.service_coverage(activities, points(spark, [(0, 0)], "s"), 10.0).collect()[0]
    assert (row.covered, row.population, row.service_coverage) == (1, 2, 0.5)


def test_lines_bring_all_their_routes(spark):
    parts = spark.createDataFrame(
        [("A", "bus", "l1"), ("A", "train", "l2"), ("B", "Bus", "l3"), ("A", "bus", "gone")],
        "line_id string, transport_mode string, link_id string",
    )
    links = spark.createDataFrame([("l1", 10.0), ("l2", 20.0), ("l3", 70.0)], "link_id string, length_m double")
    assert sorted(r[0] for r in sc.covered_links(parts, ["bus", "pt"]).collect()) == ["gone", "l1", "l2"]
    assert sc.transit_route_ratio(links, parts, ["bus", "pt"]).collect()[0][0] == pytest.approx(0.3)


def test_vehicle_classes(spark):
    v = spark.createDataFrame([("1", "CityBUS"), ("2", "tram"), ("3", None)], "vehicle_id string, type_id string")
    assert [r[0] for r in sc.buses(v, ["bus"]).collect()] == ["1"]
    assert sorted(r[0] for r in sc.blacklist(v, ["bus"]).collect()) == ["2", "3"]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_is_a_plain_join(spark, skewed, how):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 20}") for i in range(120)]
    big = spark.createDataFrame(rows, "seq long, k string")
    dim = spark.createDataFrame([("hot", 1), ("k2", 2), ("k5", 3), ("unused", 4)], "k string, v int")
    assert (heavy_keys(big, ["k"]) is None) == (skewed == "plain")
    want = big.join(dim, ["k"], how)
    got = lookup(big, dim, ["k"], how, "seq").select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
