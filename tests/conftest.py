import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tramline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", app_name="tramline-tests", shuffle_partitions=4,
                      checkpoint_dir=tempfile.mkdtemp(prefix="tramline-test-ckpt-"))
    yield s
    s.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df, *cols, order=None):
    """Collect small test results as plain tuples (sorted for stable asserts)."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=repr) if order is None else out
