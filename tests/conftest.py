import datetime as dt

import pytest

from stratamart.session import get_spark

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
T1 = dt.datetime(2024, 1, 2, 8, 0, 0)
T2 = dt.datetime(2024, 1, 3, 8, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "stratamart-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": 8,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("spark-warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collected(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collected
