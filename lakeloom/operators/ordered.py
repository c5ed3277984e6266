"""Running values over ordered groups that stay parallel when one group is huge.

A window puts a whole group into one task. ``scan`` measures the largest group first (one
pre-aggregated count). Groups of ordinary size go through plain windows that share one sort.
Where a group is larger than ``max_group_rows`` the rows are range-partitioned by group and
order, so that a group spans many partitions; each partition is scanned by itself, and the
one summary row per group and partition carries totals and last values across.

The measurement can be made once on a narrow input with ``is_hot`` and handed on as ``hot``:
steps that keep rows and keys keep the group sizes too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lakeloom.session import cut

MAX_GROUP_ROWS = 5_000_000
_CHUNK = "_scan_chunk"
_ROW = "_scan_row"
_N = "_scan_n"


@dataclass
class Scan:
    """What to compute along the order. Names map to input columns."""

    row_number: str | None = None
    rank: str | None = None
    sums: Mapping[str, Column] = field(default_factory=dict)   # running sum, this row included
    last: Mapping[str, Column] = field(default_factory=dict)   # last value so far, this row included
    prev: Mapping[str, Column] = field(default_factory=dict)   # last value before this row
    next: Mapping[str, Column] = field(default_factory=dict)   # first value after this row


def _window(by: Sequence[str], order: Sequence) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order)


def _columns(what: Scan, w: WindowSpec) -> dict[str, Column]:
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(1, Window.unboundedFollowing)
    out = {n: F.sum(c).over(so_far) for n, c in what.sums.items()}
    out |= {n: F.last(c, ignorenulls=True).over(so_far) for n, c in what.last.items()}
    out |= {n: F.last(c, ignorenulls=True).over(before) for n, c in what.prev.items()}
    out |= {n: F.first(c, ignorenulls=True).over(after) for n, c in what.next.items()}
    if what.row_number:
        out[what.row_number] = F.row_number().over(w).cast("long")
    if what.rank:
        out[what.rank] = F.rank().over(w).cast("long")
    return out


def largest_group(df: DataFrame, by: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest group and of the whole; one row reaches the driver."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.max("n").alias("top"), F.sum("n").alias("total")).first()
    return row["top"] or 0, row["total"] or 0


def group_limit(df: DataFrame, given: int | None = None) -> int:
    """Rows of a group one task may hold: as given, else as the session sets it for its row widths."""
    return given or int(df.sparkSession.conf.get("spark.lakeloom.maxGroupRows", str(MAX_GROUP_ROWS)))


def is_hot(df: DataFrame, by: Sequence[str], max_group_rows: int | None = None) -> bool:
    """True where one group is too large for one task."""
    return largest_group(df, by)[0] > group_limit(df, max_group_rows)


def attach(df: DataFrame, values: DataFrame, key: Sequence[str]) -> DataFrame:
    """Left join on null-safe key columns; the key columns of the second frame are dropped."""
    names = {c: f"_attach_key{i}" for i, c in enumerate(key)}
    other = values.withColumnsRenamed(names)
    match = reduce(and_, [F.col(c).eqNullSafe(F.col(k)) for c, k in names.items()])
    return df.join(other, match, "left").drop(*names.values())


def group_values(df: DataFrame, by: Sequence[str], values: Mapping[str, Column], hot: bool | None = None) -> DataFrame:
    """Add per-group aggregates to each row.

    The aggregate, which combines before its shuffle, is joined back, so that no task receives a
    group and nothing is measured; the input is read twice, so costly inputs are best ``cut`` before.
    A caller who knows that no group is large (``hot=False``) gets a window: one shuffle, and none
    where the rows are already partitioned by these keys.
    """
    if hot is None or hot:
        return attach(df, df.groupBy(*by).agg(*[c.alias(n) for n, c in values.items()]), by)
    w = Window.partitionBy(*by)
    return df.withColumns({n: c.over(w) for n, c in values.items()})


def scan(df: DataFrame, by: Sequence[str], order: Sequence, what: Scan,
         max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    """Add running values per group. The order must be total for row numbers to be repeatable."""
    limit = group_limit(df, max_group_rows)
    if hot is None:
        top, total = largest_group(df, by)
        hot = top > limit
    elif hot:
        total = df.count()
    if not hot:
        return df.withColumns(_columns(what, _window(by, order)))
    return _scan_split(df, list(by), order, what, parts=-(-total // limit) + 1)


def _scan_split(df: DataFrame, by: list[str], order: Sequence, what: Scan, parts: int) -> DataFrame:
    # the bounds come from a sample, so the split is written down once and both passes read it
    ranged = cut(df.repartitionByRange(parts, *by, *order).withColumn(_CHUNK, F.spark_partition_id()))
    key = [*by, _CHUNK]
    tails = {f"_scan_t{i}": c for i, c in enumerate([*what.last.values(), *what.prev.values()])}
    heads = {f"_scan_h{i}": c for i, c in enumerate(what.next.values())}
    w = _window(key, order)
    local = Scan(row_number=_ROW, rank=what.rank, sums=what.sums, last=what.last, prev=what.prev, next=what.next)
    rows = ranged.withColumns(_columns(local, w))

    # one row per group and chunk: its size, totals, last and first values
    position = Scan(row_number=_ROW)
    ends = (
        ranged.withColumns({**_columns(position, w), **tails, **heads})
        .groupBy(*key)
        .agg(
            F.count(F.lit(1)).alias(_N),
            *[F.sum(c).alias(f"_scan_s{i}") for i, c in enumerate(what.sums.values())],
            *[F.max_by(t, F.when(F.col(t).isNotNull(), F.col(_ROW))).alias(t) for t in tails],
            *[F.min_by(h, F.when(F.col(h).isNotNull(), F.col(_ROW))).alias(h) for h in heads],
        )
    )
    across = Window.partitionBy(*by).orderBy(_CHUNK)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    after = across.rowsBetween(1, Window.unboundedFollowing)
    carried = ends.select(
        *key,
        F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_N),
        *[F.sum(f"_scan_s{i}").over(before).alias(f"_scan_s{i}") for i in range(len(what.sums))],
        *[F.last(t, ignorenulls=True).over(before).alias(t) for t in tails],
        *[F.first(h, ignorenulls=True).over(after).alias(h) for h in heads],
    )

    joined = attach(rows, carried, key)
    final = {}
    for i, name in enumerate(what.sums):
        both = F.coalesce(F.col(name) + F.col(f"_scan_s{i}"), F.col(name), F.col(f"_scan_s{i}"))
        final[name] = both.cast(rows.schema[name].dataType)
    for i, name in enumerate([*what.last, *what.prev]):
        final[name] = F.coalesce(F.col(name), F.col(f"_scan_t{i}"))
    for i, name in enumerate(what.next):
        final[name] = F.coalesce(F.col(name), F.col(f"_scan_h{i}"))
    if what.row_number:
        final[what.row_number] = F.col(_ROW) + F.col(_N)
    if what.rank:
        final[what.rank] = F.col(what.rank) + F.col(_N)
    added = [c for c in _columns(what, w)]
    kept = [c for c in df.columns if c not in final]
    return joined.select(*kept, *[final[c].alias(c) for c in added])


def lag_by(df: DataFrame, by: Sequence[str], order: Sequence, lags: Mapping[str, tuple[str, int]],
           max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    """Value of a column n rows earlier in the group, null where there is no such row."""
    if not (is_hot(df, by, max_group_rows) if hot is None else hot):
        w = _window(by, order)
        return df.withColumns({name: F.lag(c, n).over(w) for name, (c, n) in lags.items()})
    numbered = cut(scan(df, by, order, Scan(row_number=_ROW), max_group_rows, hot=True))
    out = numbered
    for name, (c, n) in lags.items():
        earlier = numbered.select(*by, (F.col(_ROW) + n).alias(_ROW), F.col(c).alias(name))
        out = attach(out, earlier, [*by, _ROW])
    return out.drop(_ROW)
