"""Versions, current flags, latest values and carried-forward labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.rules import filled_count
from lakeloom.operators.aggregate import first_by
from lakeloom.operators.ordered import Scan, group_values, is_hot, lag_by, scan
from lakeloom.session import cut


def version_suffix(df: DataFrame, id: str, order: Sequence, out: str, max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    """The first row along the order keeps its id, later ones get -2, -3 ..."""
    ranked = scan(df, [id], order, Scan(row_number="_v"), max_group_rows, hot)
    return ranked.withColumn(
        out, F.when(F.col("_v") == 1, F.col(id).cast("string")).otherwise(F.concat_ws("-", id, "_v"))
    ).drop("_v")


def surrogate_key(df: DataFrame, owner: str, unit: str, order: Sequence, tie: Sequence, out: str = "surrogate_key",
                  max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    """Key owner-rank that stays unique where rows tie.

    Tied rows share a rank. The tied row whose unit also owns the next untied row moves one rank
    up, into the gap the tie leaves. Rows that still share a key are numbered along ``tie``.
    """
    hot = is_hot(df, [owner], max_group_rows) if hot is None else hot
    ranked = scan(df, [owner], order, Scan(rank="_r"), max_group_rows, hot)
    sized = group_values(ranked, [owner, "_r"], {"_size": F.count(F.lit(1))}, hot=hot)
    single = F.when(F.col("_size") == 1, F.col(unit))
    ahead = scan(sized, [owner], [*order, *tie], Scan(next={"_next": single}), max_group_rows, hot)
    moves = (F.col("_size") > 1) & (F.col(unit) == F.col("_next"))
    moved = ahead.withColumn("key_rank", F.when(moves, F.col("_r") + 1).otherwise(F.col("_r")))
    numbered = scan(moved, [owner, "key_rank"], tie, Scan(row_number="_n"), max_group_rows, hot)
    base = F.concat_ws("-", owner, "key_rank")
    return numbered.withColumns({
        out: F.when(F.col("_n") == 1, base).otherwise(F.concat_ws("-", base, "_n")),
        "key_number": F.col("_n"),
    }).drop("_r", "_size", "_next", "_n")


def with_filled_count(df: DataFrame, out: str = "filled") -> DataFrame:
    return df.withColumn(out, filled_count(df.columns))


def latest_value(df: DataFrame, by: Sequence[str], order: Sequence[str], values: Mapping[str, str],
                 hot: bool | None = None) -> DataFrame:
    """Each group's most recent value beside every row; nulls in the order come last."""
    rank = F.struct(*[F.col(c) for c in order])
    return group_values(df, by, {out: F.max_by(F.col(c), rank) for c, out in values.items()}, hot)


def current_flag(df: DataFrame, by: Sequence[str], rank: Sequence[str], out: str,
                 hot: bool | None = None) -> DataFrame:
    """1 on the rows whose rank (compared as values, not as text) is the highest of their group."""
    top = F.struct(*[F.col(c) for c in rank])
    flagged = group_values(df, by, {"_top": F.max(top)}, hot)
    return flagged.withColumn(out, F.when(top == F.col("_top"), 1).otherwise(0)).drop("_top")


def latest_rows(df: DataFrame, by: Sequence[str], at: str, hot: bool | None = None) -> DataFrame:
    """All rows on the latest date of their group."""
    latest = group_values(df, by, {"_latest": F.max(at)}, hot)
    return latest.where(F.col(at).eqNullSafe(F.col("_latest"))).drop("_latest")


def latest_one(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_by(df, by, order, latest=True)


def resubmissions(df: DataFrame, by: Sequence[str], asked: str, decided: str, required: Column, tie: Sequence[str],
                  out: str = "resubmission", max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    """Number of a repeated request, counted where it needs approval and follows the last decision."""
    order = [asked, *tie]
    counted = scan(df, by, order, Scan(row_number="_n", prev={"_last": F.struct(decided)}), max_group_rows, hot)
    again = required & (F.col("_n") > 1) & (F.col(asked) >= F.col(f"_last.{decided}"))
    return counted.withColumn(out, F.when(again, F.col("_n") - 1).otherwise(F.lit(0))).drop("_n", "_last")


def occurrence(df: DataFrame, by: Sequence[str], order: Sequence, out: str = "occurrence",
               max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    """How many rows of the group came before."""
    return scan(df, by, order, Scan(row_number="_n"), max_group_rows, hot).withColumn(out, F.col("_n") - 1).drop("_n")


def running_total(df: DataFrame, by: Sequence[str], order: Sequence, value: Column, out: str = "running_total",
                  max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    return scan(df, by, order, Scan(sums={out: value}), max_group_rows, hot)


def fill_forward(df: DataFrame, by: Sequence[str], order: Sequence, cols: Sequence[str], blank_as_null: bool = False,
                 max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    """Carry the last value of each column over nulls (and blanks)."""
    value = (lambda c: F.nullif(F.col(c), F.lit(""))) if blank_as_null else F.col
    filled = scan(df, by, order, Scan(last={f"_f_{c}": value(c) for c in cols}), max_group_rows, hot)
    return filled.select(*[F.col(f"_f_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def group_number(df: DataFrame, by: Sequence[str], order: Sequence, marker: str, out: str = "group_id",
                 max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    """Running count of filled markers: rows without one belong to the group above."""
    started = F.when(F.col(marker).isNotNull(), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    return scan(df, by, order, Scan(sums={out: started}), max_group_rows, hot)


def outline_labels(df: DataFrame, by: Sequence[str], order: Sequence, text: str, category_pattern: str,
                   marked: Column, filled: Column, max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    """Category, class, subclass and description of outline lines, by mark and position.

    A line names a category by its text. From the second line on a marked line is a class, from
    the third a subclass as well; from the fourth, a line with any mark holds a description.
    """
    lines = scan(df, by, order, Scan(row_number="_line"), max_group_rows, hot)
    label = lambda condition: F.when(condition, F.col(text)).otherwise(F.lit(""))
    return lines.withColumns({
        "category": label(F.col(text).rlike(category_pattern)),
        "class": label(marked & (F.col("_line") > 1)),
        "subclass": label(marked & (F.col("_line") > 2)),
        "description": label(filled & (F.col("_line") > 3)),
    }).drop("_line")


def outline_rows(spans: DataFrame, document: str, seq: str, size: str, text: str, sizes: Mapping[str, float],
                 class_pattern: str, code_pattern: str, schedule_word: str = "Schedule",
                 max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    """Rows of a typeset table from its text spans, whose size tells their role.

    Sizes name province, heading, section, row, limitation and code. Each span of row size opens
    an output row under the headings above it; later limitations and codes belong to that row.
    """
    role = lambda name: F.round(F.col(size), 2) == F.lit(sizes[name])
    words = F.col(text)
    is_schedule = words.contains(schedule_word)
    is_class = words.rlike(class_pattern)
    number = F.col(seq)

    def marks(condition: Column) -> Column:
        return F.when(condition, F.struct(number.alias("at"), words.alias("text")))

    if hot is None:
        # the spans are made once: measured, scanned and aggregated from a table
        spans = cut(spans)
        hot = is_hot(spans, [document], max_group_rows)
    carried = scan(
        spans, [document], [seq],
        Scan(
            sums={"row_id": F.when(role("row"), 1).otherwise(0)},
            last={
                "_schedule": marks(role("heading") & is_schedule),
                "_association": marks(role("heading") & ~is_schedule),
                "_section": marks(role("section")),
                "_class": marks(role("row") & is_class),
                "_plain": marks(role("row") & ~is_class),
            },
        ),
        max_group_rows, hot,
    )
    lines = group_values(carried, [document], {"_province": F.min(marks(role("province")))}, hot=hot)
    section_at = F.coalesce(F.col("_section.at"), F.lit(-1).cast("long"))
    class_at = F.coalesce(F.col("_class.at"), F.lit(-1).cast("long"))
    plain_at = F.coalesce(F.col("_plain.at"), F.lit(-1).cast("long"))
    in_class = class_at > section_at
    in_subclass = (plain_at > section_at) & (plain_at > class_at)
    lines = lines.withColumns({"_in_class": in_class, "_in_subclass": in_subclass}).where("row_id > 0")
    limitation = F.when(
        role("limitation") & (F.col("_in_class") | F.col("_in_subclass")) & (F.trim(words) != "")
        & (F.upper(F.trim(words)) != "NULL"), F.struct(number, words.alias("w")))
    code = F.when(role("code") & F.col("_in_subclass") & F.trim(words).rlike(code_pattern),
                  F.struct(number, F.trim(words).alias("w")))
    head = lambda value: F.max(F.when(role("row"), value))
    packed = lambda c, sep: F.nullif(F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x["w"]), sep),
                                     F.lit(""))
    return lines.groupBy(document, "row_id").agg(
        head(F.when(F.col("_province.at") < number, F.col("_province.text"))).alias("province"),
        head(F.col("_association.text")).alias("association"),
        head(F.col("_schedule.text")).alias("schedule"),
        head(F.col("_section.text")).alias("section"),
        head(F.when(F.col("_in_class"), F.col("_class.text"))).alias("class"),
        head(F.when(F.col("_in_subclass"), F.col("_plain.text"))).alias("subclass"),
        F.trim(packed(limitation, " ")).alias("limitations"),
        packed(code, ", ").alias("codes"),
    )


def bucket_by_cutoff(df: DataFrame, at: str, cutoffs: DataFrame, cutoff: str, out: str = "load_date",
                     max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    """Assign each row the first cut-off on or after its date, null past the last one.

    Times count as their day. Days are made distinct before they meet the cut-offs, so the scan holds no more
    rows than the calendar.
    """
    days = df.select(F.to_date(at).alias("_day")).where("_day is not null").distinct()
    marks = cutoffs.select(F.to_date(cutoff).alias("_day")).distinct()
    lines = days.withColumn("_kind", F.lit(0)).unionByName(marks.withColumn("_kind", F.lit(1)))
    found = scan(lines, [], ["_day", "_kind"], Scan(next={out: F.when(F.col("_kind") == 1, F.col("_day"))}),
                 max_group_rows, hot).where("_kind = 0").select("_day", out)
    return df.join(found, F.to_date(df[at]) == found["_day"], "left").select(*[df[c] for c in df.columns], out)


def lagged(df: DataFrame, by: Sequence[str], order: Sequence, lags: Mapping[str, tuple[str, int]],
           max_group_rows: int | None = None, hot: bool | None = None) -> DataFrame:
    return lag_by(df, by, order, lags, max_group_rows, hot)
