from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from marlgrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("marlgrid-tests", cpus="4", shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Sets session settings for one test."""
    before = {}

    def change(key: str, value: str) -> None:
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
