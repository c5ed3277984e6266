"""New-file pickup, event counts and table append.

Every job takes a checkpoint folder, so that a restart continues where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int | None = None,
              **options: str) -> DataFrame:
    """Stream of files as they appear in a folder."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def with_event_time(df: DataFrame, ts: str, lateness: str) -> DataFrame:
    """Watermark on a timestamp; zone-less times are read as session time."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def counts_per_window(events: DataFrame, ts: str, width: str = "1 hour", by: tuple[str, ...] = ()) -> DataFrame:
    grouped = events.groupBy(F.window(ts, width).alias("_w"), *by).agg(F.count(F.lit(1)).alias("n_rows"))
    return grouped.select(F.col("_w.start").alias("bin_start"), *by, "n_rows")


def append_to(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append all that is available, then stop."""
    return (
        df.writeStream.format(fmt).outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def update_each(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Write the rows each batch changes below its number, and only those.

    State of windows behind the watermark is dropped. A batch retried after a failure overwrites its own rows.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch={number}")

    return (
        df.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def newest_values(spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """The latest row of each key of a table written by ``update_each``; readers never miss it meanwhile."""
    rows = spark.read.format(fmt).load(path)
    values = [c for c in rows.columns if c not in keys and c != "batch"]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return latest.select(*keys, "_v.*")
