import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("hitlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hitlens-test-ckpt-"))
    yield session


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="hitlens-test-")


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of selected columns)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
