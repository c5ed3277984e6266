"""Metric layer over a star: named measures evaluated by any attributes and by any role key.

Distinct counts are not additive, so the fact is reduced once to what can be added up: a row per finest group
and distinct value with a flag a measure, or, for whole-number keys, a bitmap per finest group and range of 32 768 keys.
All distinct columns and roles share one pass over the fact and its dimensions, and amounts ride along. Every
level of the hierarchy is then made from the reduced table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.joins import lookup
from lakeloom.session import cut


#: What amounts are added as; sums are exact to six digits after the point.
MONEY = "decimal(28,6)"
#: Counted columns carry this in front, so that one can be grouped by, or name a measure, as well.
_KEY = "_counted_"


@dataclass(frozen=True)
class Distinct:
    """Number of distinct values among the rows that meet a condition."""

    column: str
    where: Column | None = None


@dataclass(frozen=True)
class Total:
    """Exact sum: amounts are added as decimals, of a kind that must hold them."""

    value: Column
    where: Column | None = None
    kind: str = MONEY


@dataclass(frozen=True)
class Share:
    """One measure over another, zero where the latter is zero."""

    part: str
    whole: str


Measure = Distinct | Total | Share


@dataclass(frozen=True)
class Role:
    """How a fact reaches a dimension under one of its role keys."""

    dimension: DataFrame
    key: str
    dimension_key: str
    take: Sequence[str]


def navigate(fact: DataFrame, roles: Sequence[Role]) -> DataFrame:
    """Add dimension attributes; facts without partner stay under a blank member."""
    for role in roles:
        fact = lookup(fact, role.dimension, {role.key: role.dimension_key}, role.take)
    return fact


def by_every_role(fact: DataFrame, measures: Mapping[str, Measure], paths: Mapping[str, Sequence[Role]], by: Sequence[str], **how) -> DataFrame:
    """Measures per role and attributes: ``paths`` name the roles that lead from the fact to dimensions, the last of which holds ``by``.

    The fact meets all dimensions in one pass and is counted under each role from what that pass has kept.
    """
    told = fact
    for i, roles in enumerate(paths.values()):
        names = {c: f"_path{i}_{c}" for role in roles for c in role.take}
        for role in roles:
            told = lookup(told, role.dimension, {names.get(role.key, role.key): role.dimension_key}, {c: names[c] for c in role.take})
    views = [{"role": F.lit(label), **{c: F.col(f"_path{i}_{c}") for c in by}} for i, label in enumerate(paths)]
    return _evaluate(told, measures, views, **how)


def evaluate(fact: DataFrame, measures: Mapping[str, Measure], by: Sequence[str] = (),
             levels: Sequence[Sequence[str]] | None = None, roles: Sequence[Role] = (), bitmaps: bool = False) -> DataFrame:
    """Measures per group. ``levels`` lists the grouping levels (default: only the finest one);
    a level's missing attributes are null and ``level`` tells how many it has.

    ``bitmaps`` keeps distinct values as bits, for whole-number keys only: 4 KB a measure, finest group and range of 32 768 keys, however many
    of them there are. It pays where groups are few and keys dense, and is smaller than rows from some 200 keys a range on.
    """
    return _evaluate(navigate(fact, roles), measures, [{c: F.col(c) for c in by}], levels, bitmaps)


def _evaluate(fact: DataFrame, measures: Mapping[str, Measure], views: Sequence[Mapping[str, Column]], levels: Sequence[Sequence[str]] | None = None,
              bitmaps: bool = False) -> DataFrame:
    """Measures by what each view calls the groups; the views' rows are counted side by side."""
    by = list(views[0])
    kinds = {f.name: f.dataType for f in fact.select(*[v.alias(c) for c, v in views[0].items()]).schema}
    columns = list(dict.fromkeys(m.column for m in measures.values() if isinstance(m, Distinct)))
    counts = {n: columns.index(m.column) for n, m in measures.items() if isinstance(m, Distinct)}
    totals = {n: m for n, m in measures.items() if isinstance(m, Total)}
    flagged = fact.select(*[v.alias(f"_by{i}_{c}") for i, view in enumerate(views) for c, v in view.items()], *_inputs(fact, measures))
    if len(views) * len(columns) > 1:
        # joined and flagged once; each view and distinct column then reads only what it needs
        flagged = cut(flagged)
    told = [flagged.select(*[F.col(f"_by{i}_{c}").alias(c) for c in by], *[c for c in flagged.columns if not c.startswith("_by")]) for i in range(len(views))]
    reduced = (_as_bits if bitmaps else _as_rows)(told, by, columns, counts, totals)
    if levels is not None and len(levels) > 1:
        reduced = cut(reduced)

    parts = []
    for level in levels if levels is not None else [by]:
        wide = [F.col(c) if c in level else F.lit(None).cast(kinds[c]).alias(c) for c in by]
        added = (_bits_at if bitmaps else _rows_at)(reduced, by, list(level), counts, totals)
        parts.append(added.select(*wide, F.lit(len(level)).alias("level"), *counts, *totals))
    merged = reduce(DataFrame.unionByName, parts)
    shaped = {}
    for name, m in measures.items():
        if isinstance(m, Share):
            shaped[name] = F.coalesce(F.try_divide(F.col(m.part), F.col(m.whole)), F.lit(0.0))
        elif isinstance(m, Distinct):
            shaped[name] = F.coalesce(F.col(name), F.lit(0)).cast("bigint")
        else:
            shaped[name] = F.col(name).cast("double")
    keep = [*by, "level"] if levels is not None else by
    return merged.select(*keep, *[shaped[n].alias(n) for n in measures])


def _inputs(fact: DataFrame, measures: Mapping[str, Measure]) -> list[Column]:
    """Only the columns the measures read: keys, one flag per distinct measure, amounts."""
    out = {}
    for name, m in measures.items():
        if isinstance(m, Distinct):
            out[_KEY + m.column] = F.col(m.column)
            met = F.lit(True) if m.where is None else F.coalesce(m.where, F.lit(False))
            out[name] = met & F.col(m.column).isNotNull()
        elif isinstance(m, Total):
            amount = m.value.cast(m.kind)
            out[name] = amount if m.where is None else F.when(m.where, amount)
    return [c.alias(n) for n, c in out.items()]


def _per_column(told: Sequence[DataFrame], by: list[str], columns: list[str], counts: Mapping[str, int], totals: Mapping[str, Total],
                key: Callable[[str], list[Column]]) -> DataFrame:
    """Each row once per distinct column, with its number and key; flags and amounts of others are null, so nothing counts twice."""
    parts = []
    for flagged in told:
        schema = flagged.schema
        mine = lambda n, own, kinds=schema: (F.col(n) if own else F.lit(None).cast(kinds[n].dataType)).alias(n)
        for i in range(max(len(columns), 1)):
            parts.append(flagged.select(*by, F.lit(i).alias("_kind"), *(key(columns[i]) if columns else []),
                                        *[mine(n, of == i) for n, of in counts.items()], *[mine(n, i == 0) for n in totals]))
    return reduce(DataFrame.unionAll, parts)


def _as_rows(told, by, columns, counts, totals) -> DataFrame:
    """A row per finest group, distinct column and value: how each measure flags it, and amounts."""
    schema = told[0].schema
    keys = [_KEY + c for c in columns]
    key = lambda own: [(F.col(k) if k == _KEY + own else F.lit(None).cast(schema[k].dataType)).alias(k) for k in keys]
    return _merged(_per_column(told, by, columns, counts, totals, key), [*by, "_kind", *keys], counts, totals)


def _merged(rows, keys, counts, totals) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.max(n).alias(n) for n in counts], *[F.sum(n).alias(n) for n in totals])


def _rows_at(reduced, by, level, counts, totals) -> DataFrame:
    """Values counted per group of a level; on the finest one a value stands in one row of its group already."""
    if len(level) < len(by):
        keys = [c for c in reduced.columns if c not in (*by, *counts, *totals)]
        reduced = _merged(reduced, [*level, *keys], counts, totals)
    return reduced.groupBy(*level).agg(*[F.count_if(n).alias(n) for n in counts], *[F.sum(n).alias(n) for n in totals])


def _as_bits(told, by, columns, counts, totals) -> DataFrame:
    """A row per finest group, distinct column and range of keys: a bitmap of the keys each measure flags, and amounts."""
    for c in columns:
        if not isinstance(told[0].schema[_KEY + c].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
            raise ValueError(f"{c} is no whole number: its values have no bits")
    place = lambda own: [F.bitmap_bucket_number(_KEY + own).alias("_range"), F.bitmap_bit_position(_KEY + own).alias("_bit")]
    rows = _per_column(told, by, columns, counts, totals, place)
    bits = [F.bitmap_construct_agg(F.when(F.col(n), F.col("_bit"))).alias(n) for n in counts]
    made = rows.groupBy(*by, "_kind", "_range").agg(*bits, *[F.sum(n).alias(n) for n in totals])
    return made.select(*by, "_kind", "_range", *[F.when(F.col("_kind") == of, F.col(n)).alias(n) for n, of in counts.items()], *totals)


def _bits_at(reduced, by, level, counts, totals) -> DataFrame:
    """Bitmaps of a level's groups put together, then counted."""
    if len(level) < len(by):
        reduced = reduced.groupBy(*level, "_kind", "_range").agg(
            *[F.bitmap_or_agg(n).alias(n) for n in counts], *[F.sum(n).alias(n) for n in totals])
    return reduced.groupBy(*level).agg(*[F.sum(F.bitmap_count(n)).alias(n) for n in counts], *[F.sum(n).alias(n) for n in totals])


def standard_measures(item: str, member: str, amount: Column, excluded: Column, active: Column) -> dict[str, Measure]:
    """The nine measures: items, members, both by active and inactive provider with shares, amount.

    An unknown excluded flag counts the row; an unknown active flag counts as inactive.
    """
    kept = ~F.coalesce(excluded, F.lit(False))
    on = F.coalesce(active, F.lit(False))
    return {
        "items": Distinct(item, kept),
        "members": Distinct(member),
        "items_active": Distinct(item, kept & on),
        "items_inactive": Distinct(item, kept & ~on),
        "items_inactive_share": Share("items_inactive", "items"),
        "members_active": Distinct(member, on),
        "members_inactive": Distinct(member, ~on),
        "members_inactive_share": Share("members_inactive", "members"),
        "total_amount": Total(amount),
    }
