from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from dqspark.session import DEFAULT_CONF

    builder = SparkSession.builder.master("local[*]").appName("dqspark-tests")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="dqspark-test-wh-"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="dqspark-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def tables(spark):
    from dqspark.sources.fixtures import load_fixtures

    return load_fixtures(spark, SMALL)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="dqspark-test-")
