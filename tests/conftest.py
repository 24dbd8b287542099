import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from linkwright.session import build_session
    os.environ.setdefault("LINKWRIGHT_LOCAL_DIR", str(tmp_path_factory.mktemp("ckpt")))
    s = build_session("local[4]", app_name="linkwright-tests", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: [(v is None, str(v)) for v in t])
