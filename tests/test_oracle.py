"""Every registered query against its SQL on the smallest data set."""

import compare
import pytest

import __spark_entry__ as entry
from workload import oracles
from workload import queries as base

SF = "/root/testdata/sf0.001"
QUERIES, SQL = base.QUERIES, oracles.ORACLES

# Known results at sf0.001: rows of the state machines, values of the metrics.
ROWS = {
    "event_log": 1000,
    "bus_boardings": 57,
    "bus_stop_delays": 19,
    "bus_link_traversals": 84,
    "occupancy_violations": 8,
    "person_trips": 4,
}


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare.differences(spark, con, SF, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(ROWS))
def test_known_row_counts(spark, name):
    assert QUERIES[name](spark, SF).count() == ROWS[name]


def test_entry(spark):
    (row,) = entry.entry(spark).collect()
    assert row.service_coverage == pytest.approx(2 / 150)
    assert row.bus_transfer_rate == pytest.approx(0.313725490)
    assert row.productivity == pytest.approx(0.568977258)
