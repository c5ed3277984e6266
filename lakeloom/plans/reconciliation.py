"""Comparison of two extracts: cleaning both alike, checking them, keeping the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import names, text
from lakeloom.operators import compare, quality
from lakeloom.operators.filters import drop_repeated_headers, drop_values
from lakeloom.operators.reshape import wide_to_long
from lakeloom.session import cut
from lakeloom.sources.tables import append, report_keys, report_rows


@dataclass(frozen=True)
class Cleaning:
    """How an extract is made comparable; every step skips columns the extract lacks."""

    naming: names.Naming = names.Naming(joiner=" ")
    renames: Mapping[str, str] = field(default_factory=dict)
    melt_ids: Sequence[str] = ()
    melt_values: Sequence[str] = ()
    pad: Mapping[str, int] = field(default_factory=dict)
    values: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    unknown: Mapping[str, str] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    blacklist: Mapping[str, Sequence] = field(default_factory=dict)
    drop: Sequence[str] = ()


def clean(df: DataFrame, how: Cleaning) -> DataFrame:
    """Headers out, names and values normalised, amounts in rows, ids padded, types set."""
    df = names.rename_present(names.normalize_names(drop_repeated_headers(df), how.naming), how.renames)
    df = text.clean_placeholders(text.trim_strings(df))
    if how.melt_values:
        df = wide_to_long(df, how.melt_ids, how.melt_values, "amount_type", "amount", drop_zero=True)
    out = {}
    for c in df.columns:
        value = F.col(c)
        if c in how.values:
            value = text.map_known(value, how.values[c], how.unknown[c]) if c in how.unknown else text.mapped(value, how.values[c])
        if c in how.pad:
            value = text.zero_pad(text.drop_decimal_suffix(value), how.pad[c])
        if c in how.types:
            value = F.regexp_replace(value.cast("string"), ",", "").try_cast(how.types[c])
        out[c] = value
    return names.drop_present(drop_values(df.select(*[v.alias(c) for c, v in out.items()]), how.blacklist), how.drop)


def reports(a: DataFrame, b: DataFrame, by: str) -> dict[str, DataFrame]:
    """The report tables of one comparison; both extracts are kept once, since each report reads them."""
    a, b = cut(a), cut(b)
    metrics = cut(compare.suite(a, b))
    return {
        "metrics": metrics, "failures": compare.failures(metrics), "result_counts": compare.result_counts(metrics),
        "row_counts": compare.row_counts(a, b), "column_names": compare.column_names(a, b),
        "missing_values": compare.missing_values(a, b), "distinct_values": compare.distinct_values(a, b),
        "distinct_totals": compare.distinct_totals(compare.distinct_values(a, b)),
        "statistics": compare.statistics(a, b), "distributions": compare.distributions(a, b),
        "by_date": compare.compare_by_date(a, b, by), "profile_1": quality.profile(a), "profile_2": quality.profile(b),
    }


def keep_reports(found: Mapping[str, DataFrame], path: str, universe: str, on: str, zone: str = "UTC",
                 fmt: str = "parquet") -> None:
    """Append each report to its table, as text, keyed by universe and date."""
    for name, report in found.items():
        keyed = report_keys(report, F.lit(universe), F.lit(on))
        append(report_rows(keyed, zone), f"{path}/{name}", fmt)
