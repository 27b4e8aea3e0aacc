import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from headway.operators.skew import HEAVY_ROWS_CONF  # noqa: E402
from headway.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["plain", "heavy", "heavy-no-broadcast"])
def skewed(request, spark):
    """Run a test on ordinary paths, with tiny heavy-key limits, and without broadcasts."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if request.param != "plain":
        spark.conf.set(HEAVY_ROWS_CONF, "7")
    if request.param == "heavy-no-broadcast":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset(HEAVY_ROWS_CONF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
