"""Tables: reading by format, and writes that keep, extend or replace them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def read(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Any installed format, the columnar table formats and event-store connectors included."""
    return spark.read.format(fmt).options(**options).load(path)


def expose(spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
    """Give tables of other layers names of their own in this session."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def synthetic(spark: SparkSession, rows: int, seed: int) -> DataFrame:
    """Uniform, normal and whole random numbers."""
    return spark.range(rows).select(
        "id", F.rand(seed).alias("uniform"), F.randn(seed + 1).alias("normal"),
        F.floor(F.rand(seed + 2) * 100).alias("whole"),
    )


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").format(fmt).option("overwriteSchema", "true").partitionBy(*partition_by).save(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("append").format(fmt).save(path)


def rewrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a table by a result that reads that table: written once beside it, then put in its place.

    The old table is renamed before the new one takes its name and deleted last, so a failure at any time
    leaves a whole table under one of the three names.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    path = path.rstrip("/")
    df.write.format(fmt).save(f"{path}.next-{mark}")
    jvm = spark.sparkContext._jvm
    place = {n: jvm.org.apache.hadoop.fs.Path(f"{path}{n}") for n in ("", f".next-{mark}", f".old-{mark}")}
    fs = place[""].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(place[""]) and not fs.rename(place[""], place[f".old-{mark}"]):
        raise OSError(f"{path} cannot be renamed")
    if not fs.rename(place[f".next-{mark}"], place[""]):
        raise OSError(f"{path}.next-{mark} cannot take its place")
    fs.delete(place[f".old-{mark}"], True)
    spark.catalog.refreshByPath(path)


def save_by_schema(df: DataFrame, table: str, mode: str | None = None, fmt: str = "parquet") -> str:
    """Append where the table has the same column set, else replace it; returns what was done."""
    catalog = df.sparkSession.catalog
    if mode is None:
        exists = catalog.tableExists(table)
        same = exists and set(df.sparkSession.table(table).columns) == set(df.columns)
        mode = "append" if same else "overwrite"
    if mode == "append":
        df.select(*df.sparkSession.table(table).columns).write.mode("append").format(fmt).saveAsTable(table)
    else:
        df.write.mode("overwrite").format(fmt).saveAsTable(table)
    return mode


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A table of the catalogue laid out in hash buckets of its keys, sorted inside each file; returns it.

    Joins and aggregates over the same keys of tables with equally many buckets then move no row. Rows are brought
    together by key first, so a bucket has few files; a key that fills several tasks is written by several. Bucketed
    scans read one bucket per task, so a table in which one key holds most rows is better joined unbucketed.
    ``path`` keeps the files outside the warehouse.
    """
    near = df.hint("rebalance", *[F.col(k) for k in keys])
    where = {"path": path} if path else {}
    near.write.mode("overwrite").format(fmt).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table, **where)
    return df.sparkSession.table(table)


def export_csv(df: DataFrame, path: str, delimiter: str = ",") -> None:
    df.write.mode("overwrite").option("header", "true").option("sep", delimiter).csv(path)


def export_by(df: DataFrame, path: str, by: str, fmt: str = "csv") -> None:
    """One folder per value in one job.

    Rows are rebalanced by value first: small values share no files, a huge one is split over
    several tasks, and no task writes a file for every value.
    """
    df.hint("rebalance", F.col(by)).write.mode("overwrite").option("header", "true").format(fmt).partitionBy(by).save(path)


def remove_rows(spark: SparkSession, path: str, doomed: Column, fmt: str = "parquet") -> None:
    """Delete matching rows from a table; rows for which the condition is unknown stay."""
    kept = read(spark, path, fmt).where(~F.coalesce(doomed, F.lit(False)))
    rewrite(kept, path, fmt)


def report_rows(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """All columns as text plus the local time of the report."""
    text = [F.col(c).cast("string").alias(c) for c in df.columns]
    return df.select(*text, F.from_utc_timestamp(F.current_timestamp(), zone).alias("validated_at"))


def report_keys(df: DataFrame, universe: Column, date: Column) -> DataFrame:
    """Lead columns of a report: universe, date and their joined key."""
    return df.select(universe.alias("universe"), date.alias("report_date"),
                     F.concat_ws("_", universe, date.cast("string")).alias("report_key"), "*")


def write_with_companions(df: DataFrame, path: str, companions: Mapping[str, DataFrame], fmt: str = "parquet") -> None:
    """A table and the tables derived from it, side by side."""
    overwrite(df, path, fmt)
    for name, part in companions.items():
        overwrite(part, f"{path}_{name}", fmt)
