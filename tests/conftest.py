import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracle import make_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = make_session(cores=4, partitions=4)
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate an expression over one row given as keyword columns."""

    def run(expression, ddl, *values):
        return spark.createDataFrame([tuple(values)], ddl).select(expression.alias("v")).first().v

    return run


@pytest.fixture
def each(spark):
    """Evaluate an expression over many values of one column ``x``, in order."""

    def run(make, values, ddl="string"):
        frame = spark.createDataFrame(list(enumerate(values)), f"i int, x {ddl}")
        rows = frame.select("i", make("x").alias("v")).orderBy("i").collect()
        return [r.v for r in rows]

    return run
