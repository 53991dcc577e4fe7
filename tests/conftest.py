import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from haatlake.plans.session import STATIC, tune

    session = (
        SparkSession.builder.master("local[8]").appName("tests").config(map=STATIC)
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def ws(spark):
    from haatlake.plans.workspace import workspace

    return workspace(spark, SF_DIR)
