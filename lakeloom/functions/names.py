"""Column names: cleaning, renaming, ordering."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Naming:
    """How a name is cleaned: characters that go, white space and characters that become the joiner, letter case.

    With ``runs`` a run of joined characters becomes one joiner, else each becomes its own.
    """

    drop: str = ""
    join: str = ""
    joiner: str = "_"
    runs: bool = True
    trim: bool = True
    title: bool = False

    def __call__(self, name: str) -> str:
        name = "".join(ch for ch in name if ch not in self.drop)
        name = name.strip() if self.trim else name
        name = name.title() if self.title else name
        joined = rf"[\s{re.escape(self.join)}]" + ("+" if self.runs else "")
        return re.sub(joined, lambda _: self.joiner, name)


def normalize_names(df: DataFrame, how: Naming = Naming()) -> DataFrame:
    """Clean all column names; two names that become one are an error, not a silent loss."""
    names = [how(n) for n in df.columns]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"column names collide: {sorted(names)}")
    return df.toDF(*names)


def replace_in_names(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.toDF(*[n.replace(old, new) for n in df.columns])


def rename_present(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in renames.items() if a in df.columns})


def keep_and_rename(df: DataFrame, keep: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """Listed columns in the order of the list, renamed by the map."""
    renames = renames or {}
    return df.select(*[F.col(c).alias(renames.get(c, c)) for c in keep])


def to_front(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Listed columns first, the rest by name; absent ones are ignored."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *sorted(set(df.columns) - set(head)))


def first_columns(df: DataFrame, n: int) -> DataFrame:
    """The first n columns, or all but the last -n."""
    return df.select(*df.columns[:n])


def drop_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by name; what does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def align_to(df: DataFrame, like: DataFrame) -> DataFrame:
    """Columns both frames have, in the order and with the types of the other frame."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in like.schema if f.name in df.columns])


def derive(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Add columns from a table of names and SQL expressions over the given columns."""
    return df.select("*", *[F.expr(rule).alias(name) for name, rule in rules])
