import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from brisa import configure  # noqa: E402
from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return configure(session("8"))


@pytest.fixture
def rows(spark):
    """Sorted tuples of a frame's columns."""

    def collect(df, *cols):
        return sorted(
            (tuple(r) for r in (df.select(*cols) if cols else df).collect()),
            key=lambda t: [(v is not None, str(type(v)), v) for v in t],
        )

    return collect
