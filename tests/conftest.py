import contextlib
import io
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spendlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    wh = tempfile.mkdtemp(prefix="spendlens-test-wh-")
    s = local_session("*", shuffle_partitions=8, warehouse=wh)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (NULL-safe sort) of the given columns (default: all)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))


def plan_text(df, mode="simple"):
    """What ``df.explain(mode)`` prints (the public way to read a plan)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
