import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from harvestline import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, app_name="harvestline-tests")
    yield s


def rows(df, *cols, order=None):
    """Collect selected columns as a sorted list of tuples (test helper)."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r)) if order is None else out
