"""Python workers that find this package wherever the driver was started."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def find_package(spark: SparkSession) -> SparkSession:
    """Put the package's folder on the workers' path; on a cluster it must be installed there or shared."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark
