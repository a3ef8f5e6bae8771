import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from basketry.session import get_session
    spark = get_session("local[4]", shuffle_partitions=8,
                        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="bk-test-ckpt-")})
    yield spark
    SparkSession.getActiveSession() and spark.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="bk-test-")
