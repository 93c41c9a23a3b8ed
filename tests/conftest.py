import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from strata.session import PLAN_CONF

    warehouse = tempfile.mkdtemp(prefix="strata-wh-")
    builder = (SparkSession.builder.master("local[4]").appName("strata-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.warehouse.dir", warehouse))
    for k, v in PLAN_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="strata-test-")
