"""A local session for the tests."""

from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_TINY = "/root/testdata/sf0.001"


def local_session():
    from tidemark.session import build_session

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        "tidemark-tests",
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": scratch + "/shared",
            "spark.sql.warehouse.dir": scratch + "/warehouse",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()
