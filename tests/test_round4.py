"""Round 4: buckets of stream keys, and XML read in splits."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from headway import schemas as S
from headway.plans.analysis import analyse
from headway.sources import xml
from headway.streaming import processors as P
from workload import queries as Q
from workload import tables as T


def test_keys_of_a_bucket_worked_at_once_equal_keys_alone():
    kinds = [S.DRIVER_STARTS, S.PERSON_ENTERS, S.LEAVES_TRAFFIC, S.ENTERS_TRAFFIC, S.ARRIVES, S.DEPARTS,
             S.ENTERED_LINK, S.LEFT_LINK, S.PERSON_LEAVES, S.DEPARTURE, S.ACTIVITY_START]
    pick = np.random.default_rng(4)
    sizes, n = np.array([1, 1200, 3, 795, 1]), 2000
    any_of = lambda *values: pick.choice(np.array(values, dtype=object), n)
    log = pd.DataFrame(
        {
            "seq": np.arange(n), "time": np.arange(n) * 1.0, "type": any_of(*kinds), "person": any_of("p", "q", "d", None),
            "starting": any_of("d", "e", None), "facility": any_of("s", None), "delay": any_of(1.0, None),
            "link": any_of("l", "m", None), "km": any_of(0.5, None), "mode": any_of("pt", None),
            "vehicle": any_of("v", "w"), "banned": any_of(True, None),
        }
    )
    keys = np.array([f"k{i}" for i in range(len(sizes))], dtype=object)
    for processor in (P.Boardings(), P.StopDelays(), P.LinkTraversals(), P.PersonTrips()):
        blank = [processor.blank() for _ in keys]
        out, carries = processor.work(keys, sizes, log, blank)
        alone, at = [], 0
        for key, size, carry in zip(keys, sizes, carries, strict=True):
            rows, after = processor.advance(key, log[at : at + size].reset_index(drop=True), processor.blank())
            alone.append(rows)
            assert after == carry
            at += size
        rows = [row for r in alone for row in r.values.tolist()]
        assert rows and str(rows) == str(out.values.tolist())


def test_population_is_read_in_splits(spark, tmp_path):
    person = '<person id="p{0}">\n<plan selected="yes"><activity type="home" x="{0}" y="1"/></plan></person>\n'
    body = "".join(person.format(i) for i in range(300))
    extra = '<!-- <person id="no"> --><person id="e1"/><person id="e2" note="a&gt;b" ></person>\n'
    path = tmp_path / "population.xml"
    path.write_text(f'<?xml version="1.0"?>\n<population>\n{extra}{body}</population>\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = xml.scan_population(spark, str(path))
        assert rows.rdd.getNumPartitions() > 3
        got = sorted((r.person_id, r.act_type, r.x) for r in rows.collect() if r.act_type)
        assert got == sorted((f"p{i}", "home", float(i)) for i in range(300))
        assert sorted(r.person_id for r in rows.filter("act_type is null").collect()) == ["e1", "e2"]
        path.write_text("<population><!-- a </person> b --><person id='1'></person></population>")
        with pytest.raises(Exception, match="cannot be cut"):
            xml.scan_population(spark, str(path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_analysis_works_vehicles_out_once(spark, tmp_path):
    sf, seen = "/root/testdata/sf0.001", spark.sparkContext.accumulator(0)
    scenario = Q._log_scenario(spark, sf)
    vehicles = scenario.transit_vehicles

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = vehicles.mapInArrow(passed, vehicles.schema)
    scenario = type(scenario)(**{**vars(scenario), "transit_vehicles": watched})
    got = analyse(T.event_log(spark, sf), scenario, str(tmp_path / "out"), Q.PARAMS, Q.WEIGHTS, "csv")
    assert got.select(F.isnan("final_score")).first()[0] is False
    assert seen.value == vehicles.count()
