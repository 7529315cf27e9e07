import pytest

from checks.verify import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame(schema, rows): a small hand-made DataFrame."""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
