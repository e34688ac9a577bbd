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
    from tessera.session import build_session
    ckpt = tempfile.mkdtemp(prefix="tessera-test-ckpt-")
    s = build_session("local[8]", app_name="tessera-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tessera.session import scratch_root
    return scratch_root(spark)


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of selected columns)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
