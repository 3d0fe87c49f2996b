from __future__ import annotations

import os

import pytest

from ledgerloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    """Tables that answers are compared on."""
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def small_dir() -> str:
    """Tables for tests of a way or a plan, where the size does not matter."""
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
