from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tidemark.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from testbed.tables import Tables

    return Tables(spark, SF_DIR)


@pytest.fixture(scope="session")
def prepared(spark, tmp_path_factory):
    """Input tables written as in a deployment, for plan checks."""
    from testbed.tables import prepare

    return prepare(spark, SF_DIR, str(tmp_path_factory.mktemp("tables")))
