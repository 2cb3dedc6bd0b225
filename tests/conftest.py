import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tidewater.session import scratch_path  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[*]")
        .appName("tidewater-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # shared scratch root: keep the cluster's setting, pick one only when unset
    if not session.conf.get("spark.checkpoint.dir", None) and not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidewater-test-ckpt-"))
    yield session


@pytest.fixture()
def base(spark, request):
    return scratch_path(spark, "tests", request.node.name.replace("[", "_").replace("]", "_"))
