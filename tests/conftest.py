import contextlib
import io
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from suite.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session()
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


def rows(df):
    """All rows as tuples, in the order of the table."""
    return [tuple(r) for r in df.collect()]


def unordered(df):
    return sorted(rows(df), key=repr)


def plan_of(df, mode="formatted"):
    """The text that ``explain`` prints."""
    with contextlib.redirect_stdout(io.StringIO()) as printed:
        df.explain(mode)
    return printed.getvalue()
