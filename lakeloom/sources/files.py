"""Raw file drops: delimited text, dated file names, listings."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.dates import date_from_name, fiscal_bounds
from lakeloom.operators.sets import union_all
from lakeloom.sources.records import physical_lines, whole_records


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: str | None = None, delimiter: str = ",",
                   quote: str = '"', escape: str = '"', multi_line: bool = False) -> DataFrame:
    """Delimited text with header; without schema every column is text."""
    reader = spark.read.option("header", "true").option("sep", delimiter).option("quote", quote)
    reader = reader.option("escape", escape).option("multiLine", str(multi_line).lower())
    return (reader.schema(schema) if schema else reader.option("inferSchema", "false")).csv(path)


def origin_name(by: str = "file") -> Column:
    """Name of the file a row came from, or of its folder where a drop is a folder of parts."""
    if by == "file":
        return F.col("_metadata.file_name")
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)


def with_source_date(df: DataFrame, name: str = "source", by: str = "file") -> DataFrame:
    """Date held by the name of the file (or folder) a row came from."""
    return df.select("*", date_from_name(origin_name(by)).alias(name))


def enveloped_records(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], delimiter: str = ",", lead: int = 1,
                      has_header: bool = True, trail: int = 1, name: str = "source", by: str = "file", quote: str = '"') -> DataFrame:
    """Records between each file's ``lead`` lines with header and its ``trail`` lines: text columns, origin date, ``reject``.

    Lead and trail are told by their place in the file, whatever splits it is read in. Quoted fields may hold line
    breaks. ``reject`` holds a record that does not have one field a column, and the lines after a quote that is never
    closed; else null.
    """
    records = whole_records(physical_lines(spark, path, delimiter, quote, lead + int(has_header), trail))
    schema = ", ".join(f"`{c}` string" for c in [*columns, "_reject"])
    options = {"sep": delimiter, "quote": quote, "escape": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_reject"}
    at = -1 if by == "file" else -2
    parsed = records.select(F.from_csv("value", schema, options).alias("_r"), "value", "_broken",
                            date_from_name(F.element_at(F.split("_file", "/"), at)).alias(name))
    reject = F.when(F.col("_broken"), F.col("value")).otherwise(F.col("_r._reject"))
    return parsed.select(*[F.when(~F.col("_broken"), F.col(f"_r.`{c}`")).alias(c) for c in columns], name, reject.alias("reject"))


def read_enveloped(spark: SparkSession, path: str | Sequence[str], schema: str, **how) -> DataFrame:
    """The records that fit, typed by the schema; what does not fit a type becomes null."""
    fields = spark.createDataFrame([], schema).schema
    rows = enveloped_records(spark, path, fields.names, **how)
    return rows.where("reject is null").drop("reject").withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in fields})


def enveloped_rejects(spark: SparkSession, path: str | Sequence[str], schema: str, name: str = "source", **how) -> DataFrame:
    """The records that do not fit, by date of origin; with the others they add up to the files' records."""
    columns = spark.createDataFrame([], schema).columns
    return enveloped_records(spark, path, columns, name=name, **how).where("reject is not null").select(name, "reject")


def read_parquet(spark: SparkSession, path: str | Sequence[str], date: Column | None = None,
                 by: str = "file") -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select("*", (date if date is not None else date_from_name(origin_name(by))).alias("source"))


def list_files(spark: SparkSession, root: str, pattern: str = "*", changed_after: str | None = None) -> DataFrame:
    """Path, name, type, size, modification time and source date of files; contents are not read.

    The source key is the whole folder path below the root, '' for files in the root itself.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    if changed_after:
        reader = reader.option("modifiedAfter", changed_after)
    name = F.element_at(F.split("path", "/"), -1)
    inside = F.regexp_replace("path", "^.*?" + re.escape(re.sub("^[a-z0-9]+:/*(?=/)", "", root).rstrip("/")) + "/", "")
    key = F.when(F.contains(inside, F.lit("/")), F.regexp_replace(inside, "/[^/]*$", "")).otherwise("")
    folder = F.element_at(F.split("path", "/"), -2)
    return reader.load(root).select(
        "path", folder.alias("folder"), name.alias("file_name"),
        F.lower(F.element_at(F.split(name, r"\."), -1)).alias("file_type"),
        key.alias("source_key"), date_from_name(name).alias("source_date"),
        F.col("modificationTime").alias("modified"), "length",
    )


def with_source_facts(files: DataFrame, sources: DataFrame) -> DataFrame:
    """Add source name, priority and write mode from a table keyed by the folder path below the root."""
    return files.join(sources, "source_key", "left")


def newest_per_folder(files: DataFrame) -> DataFrame:
    """The newest file of each folder path, an aggregate."""
    pick = F.max_by(F.struct("folder", "path", "file_name", "modified"), F.struct("modified", "path"))
    return files.groupBy("source_key").agg(pick.alias("_f")).select("source_key", "_f.*")


def column_inventory(spark: SparkSession, files: Mapping[str, str], fmt: str = "csv") -> DataFrame:
    """Columns of each file from its header or footer only."""
    rows = []
    for label, path in files.items():
        reader = spark.read.format(fmt)
        frame = (reader.option("header", "true") if fmt == "csv" else reader).load(path)
        rows += [(label, f.name, i, f.dataType.simpleString()) for i, f in enumerate(frame.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, column_name string, ordinal int, data_type string")


def price_list(spark: SparkSession, sheets: Mapping[str, str], fiscal_year: int, provider_type: str,
               schema: str) -> DataFrame:
    """Per-region price files as one list valid for a fiscal year."""
    first, last = fiscal_bounds(F.lit(fiscal_year))
    return union_all([
        read_delimited(spark, path, schema).withColumns({
            "region": F.lit(region), "valid_from": first, "valid_to": last, "provider_type": F.lit(provider_type),
        })
        for region, path in sheets.items()
    ])
