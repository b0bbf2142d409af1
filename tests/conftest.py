import pytest

from bazaar.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("bazaar-tests", "4", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def column(df, expression):
    """Values of one column expression, in row order."""
    return [row[0] for row in df.select(expression).collect()]
