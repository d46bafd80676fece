import pytest

from priorframe.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def values(df, *columns):
    """Rows as sorted tuples."""
    return sorted(
        (tuple(r[c] for c in columns) for r in df.select(*columns).collect()),
        key=lambda t: tuple((v is None, v) for v in t),
    )
