"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even where that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def session(app: str = "lakeloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators count on to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor reaches: spark.checkpoint.dir as the session names it.

    Only a local master may fall back to a temporary folder; a cluster without the setting
    is an error, since a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if named is None and current is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="lakeloom-")
    if current is None:
        sc.setCheckpointDir(named)
    return named or current


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, in a folder named after the application.

    Nothing is written yet. Once the application has ended its folder can be dropped whole.
    """
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/lakeloom/{app}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows to a table in the shared folder and read that.

    The table outlives lost executors, is read by column, and tells the optimizer its size.
    """
    path = scratch(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(df: DataFrame) -> DataFrame:
    """End the generated loop here, so that the steps before and after are compiled as methods of their own.

    Spark fuses a chain of projections and broadcast joins into one method, and the JVM never compiles methods above
    8 000 bytecodes: wide chains then run several times slower. Coalescing to more partitions than there are moves no row, needs no
    shuffle and is not fused.
    """
    return df.coalesce(1 << 20)
