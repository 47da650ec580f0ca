import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from graphloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests", spark__sql__shuffle__partitions="2")
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    data = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in data.collect()), key=repr)
