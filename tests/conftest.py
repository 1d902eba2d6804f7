import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tripmart.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate one column per row of values: ``one(values, type, column builder)``."""
    from pyspark.sql import functions as F

    def run(values, kind, build):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]

    return run


@pytest.fixture
def rows():
    def run(df, *order):
        return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]

    return run
