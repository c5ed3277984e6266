import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeloom.session import session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g", "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-"),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """Value of an expression over literal inputs."""
    def run(make, *values, type="string"):
        schema = ", ".join(f"c{i} {type}" for i in range(len(values)))
        from pyspark.sql import functions as F

        df = spark.createDataFrame([tuple(values)], schema)
        return df.select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("v")).first()["v"]

    return run


def rows(df, *cols):
    return sorted([tuple(r) for r in (df.select(*cols) if cols else df).collect()], key=str)
