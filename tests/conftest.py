import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoal.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="shoal-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.default.parallelism": "4",
    })
    s.sparkContext.setLogLevel("ERROR")
    if not checkpoint_dir(s):  # tests only: one machine, so any folder is shared
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shoal-tests-"))
    yield s


def rows(df, *cols, order=None):
    """Collect small test frames as sorted tuples (None sorts first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
