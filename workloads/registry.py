"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(sql: str | None = None, text: Sequence[str] = ()):
    """Register a function of the tables under its name; ``text`` lists dates and times to render."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(Tables(tune(spark), sf_dir))
            return df.withColumns({c: F.col(c).cast("string") for c in text}) if text else df

        QUERIES[fn.__name__] = run
        if sql:
            casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in text)
            ORACLES[fn.__name__] = f"SELECT * REPLACE ({casts}) FROM ({sql})" if text else sql
        return fn

    return wrap
