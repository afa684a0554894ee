import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from shopmart.session import build_session
    s = build_session("local[4]", 4, app_name="shopmart-tests")
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="shopmart-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shopmart-test-")


def meta_df(spark, rows, entity="post_id"):
    return spark.createDataFrame(rows, f"{entity} long, meta_key string, meta_value string")
