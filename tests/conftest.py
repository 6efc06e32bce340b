import tempfile

import pytest

from ledgerlake.session import build_session


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="ledgerlake-wh-")
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": warehouse,
        "spark.driver.memory": "6g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column expression over values of one text (or other) column ``x``."""
    def run(fn, data, dtype="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {dtype}")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]

    return run
