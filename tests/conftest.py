import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from revlens.session import get_session

    conf = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    s = get_session("local[*]", app="revlens-tests", conf=conf)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="revlens-test-"))
    yield s


def rows(df, *cols):
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
