import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sightline.session import tune  # noqa: E402

STORED = tempfile.mkdtemp(prefix="tests-stored-")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", STORED)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def same():
    """Equal as multisets, in both directions."""

    def check(a, b):
        b = b.select(*a.columns)
        assert a.exceptAll(b).collect() == []
        assert b.exceptAll(a).collect() == []

    return check
