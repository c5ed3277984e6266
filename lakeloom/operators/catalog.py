"""Source catalogue: what changed, what is due, what is done."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.joins import outer_with_origin
from lakeloom.operators.ordered import attach

# Columns of a catalogue: path, source, priority, write_mode, source_date, modified, processed, processed_on


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """New listing with the status of the old one.

    A file is due when it is new, was never processed, or belongs to an overwrite source and
    changed since. Files that vanished drop out.
    """
    state = old.select("path", "modified", "processed", "processed_on")
    both = outer_with_origin(state, new.drop("processed", "processed_on"), ["path"]).where("origin <> 'left_only'")
    due = (
        (F.col("origin") == "right_only")
        | ~F.coalesce(F.col("processed_old"), F.lit(False))
        | ((F.col("write_mode_new") == "overwrite") & (F.col("modified_new") > F.col("modified_old")))
    )
    due = F.coalesce(due, F.lit(False))
    rest = [c for c in new.columns if c not in ("path", "processed", "processed_on")]
    return both.select(
        "path", *[F.col(f"{c}_new").alias(c) for c in rest],
        F.when(due, F.lit(False)).otherwise(F.col("processed_old")).alias("processed"),
        F.when(~due, F.col("processed_on_old")).alias("processed_on"),
        due.alias("due"),
    )


def mark_processed(catalogue: DataFrame, done: DataFrame | None = None, source: str | None = None,
                   on: Column | None = None) -> DataFrame:
    """Mark files as processed: those listed, those of a source, or all."""
    on = F.current_date() if on is None else on
    if done is not None:
        listed = done.select("path").distinct().withColumn("_done", F.lit(True))
        catalogue = attach(catalogue, listed, ["path"])
        hit = F.coalesce(F.col("_done"), F.lit(False))
    else:
        hit = F.lit(True) if source is None else F.coalesce(F.col("source") == source, F.lit(False))
    marked = catalogue.withColumns({
        "processed": F.when(hit, F.lit(True)).otherwise(F.col("processed")),
        "processed_on": F.when(hit, on).otherwise(F.col("processed_on")),
    })
    return marked.drop("_done")


def work_list(catalogue: DataFrame) -> DataFrame:
    """Sources with files to process, by priority, with their number of files."""
    return (
        catalogue.where(~F.col("processed")).groupBy("priority", "source")
        .agg(F.count(F.lit(1)).alias("n_files"), F.min("source_date").alias("first_date"),
             F.max("source_date").alias("last_date"))
    )


def sources_json(catalogue: DataFrame) -> DataFrame:
    """One JSON text per priority listing its due sources."""
    lists = work_list(catalogue).groupBy("priority").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    return lists.select("priority", F.to_json(F.struct("priority", "sources")).alias("work"))


def append_log(spark, rows: Sequence[tuple], path: str, fmt: str = "parquet") -> None:
    """Append run records (run, step, status, message) with the time of writing."""
    frame = spark.createDataFrame(list(rows), "run string, step string, status string, message string")
    frame.withColumn("logged_at", F.current_timestamp()).write.mode("append").format(fmt).save(path)
