from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quire.session import get_spark

    s = get_spark(
        app="quire-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={"spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    from quire.session import clear_scratch

    clear_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def sf_small() -> str:
    return SF_SMALL
