import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.compare import duck, session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    found = session()
    yield found
    found.stop()


@pytest.fixture(scope="session")
def small_duck():
    return duck(SMALL)


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side of a join is small."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.fixture
def interpreted(spark):
    """No whole-stage code for tiny literal frames, where compiling takes most of the time."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
