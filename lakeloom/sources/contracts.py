"""Dataset contracts: declared read schema, kept columns, names and write types, matched by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.dates import DATE_FORMATS, parse_date
from lakeloom.functions.names import keep_and_rename


@dataclass(frozen=True)
class Contract:
    """How one source is read, shaped and written."""

    name: str
    read_schema: str
    write_schema: str
    dates: Sequence[str] = ()
    keep: Sequence[str] | None = None
    renames: Mapping[str, str] = field(default_factory=dict)
    mode: str = "overwrite"
    fmt: str = "csv"
    options: Mapping[str, str] = field(default_factory=dict)
    transform: Callable[[DataFrame], DataFrame] | None = None
    date_formats: Sequence[str] = DATE_FORMATS

    def read(self, spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
        """Columns of the read schema. A delimited file's are found by its header, in any order; all files must have the same one."""
        if self.fmt == "csv" and self.options.get("header", "true") == "true":
            options = {"header": "true", "inferSchema": "false", "enforceSchema": "false", **self.options}
            raw = enforce(spark.read.options(**options).csv(path), self.read_schema)
        else:
            raw = spark.read.format(self.fmt).options(**self.options).schema(self.read_schema).load(path)
        return raw.withColumns({c: parse_date(F.col(c), self.date_formats) for c in self.dates}) if self.dates else raw

    def shape(self, raw: DataFrame) -> DataFrame:
        """Transform, keep, rename and type; what does not fit a type becomes null."""
        df = self.transform(raw) if self.transform else raw
        df = keep_and_rename(df, self.keep or df.columns, self.renames)
        return enforce(df, self.write_schema)


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def enforce(df: DataFrame, ddl: str) -> DataFrame:
    """Columns of a schema, by name, in its order and with its types."""
    want = schema_of(ddl)
    missing = [f.name for f in want if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the data: {missing}")
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in want])
