import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[*]").appName("scrubjay-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests run without a cluster: set a checkpoint folder only if none is configured.
    if not session.conf.get("spark.checkpoint.dir", None) and session.sparkContext.getCheckpointDir() is None:
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="scrubjay-ckpt-"))
    yield session
