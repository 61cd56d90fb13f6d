from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tidewater-tests-")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tidewater-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # The cluster names its shared folder in spark.checkpoint.dir; use our
    # own only when the session has none.
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidewater-case-")


@pytest.fixture(scope="module", autouse=True)
def no_views_left():
    """Drop the temporary views that the tests of a module and the queries
    they ran have left; the catalog lists them in every database."""
    yield
    session = SparkSession.getActiveSession()
    for t in session.catalog.listTables() if session else ():
        if t.isTemporary:
            session.catalog.dropTempView(t.name)
