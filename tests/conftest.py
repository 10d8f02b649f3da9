import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from formline.operators.blocks import MAX_GROUP_ROWS_CONF  # noqa: E402
from formline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "formline-tests")
    yield session
    session.stop()


@pytest.fixture
def tiny_groups(spark):
    """Treat groups of more than twenty rows as oversized."""
    spark.conf.set(MAX_GROUP_ROWS_CONF, "20")
    yield
    spark.conf.unset(MAX_GROUP_ROWS_CONF)


def rows_of(df, columns=None):
    columns = columns or sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
