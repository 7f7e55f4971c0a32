import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("LEXCURATE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lexcurate.session import REQUIRED_CONF

    b = (SparkSession.builder.master("local[*]").appName("lexcurate-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="lexcurate-test-ckpt-", dir="/tmp"))
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lexcurate-test-wh-", dir="/tmp")))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="lexcurate-test-", dir="/tmp")
