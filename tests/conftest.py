"""One local session for all tests, with its own catalog folder."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

# Collected instants come out in the process's zone.
os.environ["TZ"] = "UTC"
time.tzset()

from trilayer.session import local_session  # noqa: E402
from trilayer.sources.tables import create_layers  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests",
        4,
        **{
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.catalogImplementation": "in-memory",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    create_layers(session)
    yield session
    session.stop()
