import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from presslake.session import get_spark
    s = get_spark("local[4]", 8)
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="presslake-test-")


def pages_df(spark, *htmls, urls=None):
    rows = [(i, (urls[i] if urls else f"https://h{i}.example.com/a/{i}"), h) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")
