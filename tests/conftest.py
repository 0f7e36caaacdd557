import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vaultline.session import build_session
    s = build_session("local[8]", "vaultline-tests", 8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vaultline-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from vaultline.session import scratch_path
    return scratch_path(spark, "test")


def rows(df, order=None):
    """Collected rows as plain tuples, sorted for order-insensitive comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple("" if v is None else str(v) for v in t))
