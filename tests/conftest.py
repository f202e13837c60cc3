import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from wardline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = build_session(
        "wardline-tests", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": str(scratch), "spark.sql.warehouse.dir": str(scratch / "warehouse")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """The rows of a DataFrame as sorted tuples; NULL sorts first."""
    def collect(df, *columns):
        found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
        return sorted(found, key=lambda row: [(value is not None, str(type(value)), value) for value in row])
    return collect
