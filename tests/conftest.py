from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orelake.session import local_session  # noqa: E402
from orelake.storage import new_path  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder(spark):
    """A fresh folder name under the shared folder."""
    return new_path(spark, "test")


@pytest.fixture()
def database(spark, folder):
    """A fresh database with its files in the shared folder."""
    name = "t_" + folder.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    return name


@pytest.fixture(scope="session")
def plan_of(spark):
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
