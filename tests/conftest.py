import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from siniestro.session import get_spark
    s = get_spark("local[4]", 4, app_name="siniestro-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="siniestro-test-ckpt-"))
    yield s


def rows(df, *cols):
    """Collect a small test frame as a list of tuples (tests only)."""
    return [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
