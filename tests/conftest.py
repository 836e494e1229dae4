from __future__ import annotations

import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeward.operators.tables import TableNames  # noqa: E402
from lakeward.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="lakeward-wh-")
    session = local_session("local[*]", warehouse=warehouse)
    yield session
    session.stop()


@pytest.fixture()
def names(spark):
    """A fresh database per test, so tests never see each other's tables."""
    db = "t_" + uuid.uuid4().hex[:10]
    spark.sql(f"CREATE DATABASE {db}")
    return TableNames(database=db)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="lakeward-files-")
