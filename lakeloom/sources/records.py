"""Records of delimited files whose quoted fields hold line breaks, read in parallel however the files are split.

A reader that starts in the middle of a file cannot know whether it stands inside a quoted field. So every line is
taken as a function of the state before it: where it leads from outside a quoted field, and where from inside. Functions
are put together along a split for both states it may be entered in; one row per split then says, along the
file, which of the two was true. Only after that lines become records, and only records of several lines are gathered.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from lakeloom.session import cut


def quote_patterns(delimiter: str = ",", quote: str = '"') -> tuple[str, str]:
    """Patterns of the lines that end inside a quoted field: if entered outside of one, and if entered inside.

    A quote opens a field only as its first character; two quotes inside stand for one; what follows the closing
    quote up to the delimiter is part of the field. Loops are possessive: they neither back up nor recurse.
    """
    if len(delimiter) != 1 or len(quote) != 1:
        raise ValueError("delimiter and quote must be single characters")
    d, q = re.escape(delimiter), re.escape(quote)
    inside, rest = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+", f"[^{d}]*+"
    field = f"(?:{q}{inside}{q}{rest}|(?!{q}){rest})"
    opened = rf"(?:{field}{d})*+{q}{inside}\z"
    return rf"\A{opened}", rf"\A{inside}(?:\z|{q}{rest}{d}{opened})"


def physical_lines(spark: SparkSession, path: str | Sequence[str], delimiter: str = ",", quote: str = '"', lead: int = 0, trail: int = 0) -> DataFrame:
    """Lines of every file but its first ``lead`` and last ``trail``: _file, _block (the split's start), _line (their order), value, _out, _in.

    ``_out`` and ``_in`` say whether the line ends inside a quoted field when entered outside or inside of one. Lines are read
    and numbered once, in one written table; their place in the file follows from the sizes of the splits ahead.
    """
    outside, inside = quote_patterns(delimiter, quote)
    lines = cut(spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"),
        "value", F.col("value").rlike(outside).alias("_out"), F.col("value").rlike(inside).alias("_in")))
    if not lead and not trail:
        return lines
    sizes = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_line").alias("first"))
    along = Window.partitionBy("_file")
    ahead = along.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_file", "_block", (F.coalesce(F.sum("n").over(ahead), F.lit(0).cast("long")) - F.col("first")).alias("_shift"),
                         F.sum("n").over(along).alias("_total"))
    place = F.col("_line") + F.col("_shift")
    return lines.join(sizes, ["_file", "_block"]).where((place >= lead) & (place < F.col("_total") - trail)).drop("_shift", "_total")


def entered(df: DataFrame, along: WindowSpec) -> DataFrame:
    """Adds ``_known`` and ``_state``: the state each row is entered in, along the order.

    Rows are functions _out, _in. A row whose both results agree decides the state whatever was before it; other rows keep or
    swap it. After a deciding row the state is known (``_state``, 0 outside); ahead of the first one ``_state`` says whether
    the state at the start was swapped.
    """
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    swap = F.when(F.col("_out") & ~F.col("_in"), 1).otherwise(0)
    df = df.withColumn("_swaps", F.coalesce(F.sum(swap).over(before), F.lit(0).cast("long")))
    decided = F.when(F.col("_out") == F.col("_in"), F.struct(F.col("_out").cast("long").alias("state"), F.col("_swaps").alias("at")))
    df = df.withColumn("_last", F.last(decided, ignorenulls=True).over(before))
    known = F.col("_last").isNotNull()
    state = F.when(known, F.col("_last.state") + F.col("_swaps") - F.col("_last.at")).otherwise(F.col("_swaps"))
    return df.withColumns({"_known": known, "_state": F.pmod(state, F.lit(2))}).drop("_swaps", "_last")


def _stepped(df: DataFrame) -> DataFrame:
    """Lines with the state before them and the number of records begun up to them, for both states their split may be entered in."""
    along = Window.partitionBy("_file", "_block").orderBy("_line")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = entered(df, along)
    states = {f"_state{e}": F.when(F.col("_known"), F.col("_state")).otherwise(F.pmod(F.col("_state") + e, F.lit(2))) for e in (0, 1)}
    df = df.withColumns(states).drop("_known", "_state")
    return df.withColumns({f"_begun{e}": F.sum(F.when(F.col(f"_state{e}") == 0, 1).otherwise(0)).over(so_far) for e in (0, 1)})


def _after(state: Column) -> Column:
    return F.when(state == 0, F.col("_out")).otherwise(F.col("_in"))


def whole_records(lines: DataFrame) -> DataFrame:
    """Rows (_file, value, _broken) of records, from ``physical_lines``: lines put together wherever a quoted field goes on.

    A record that begins in one split and ends in a later one belongs to the first. Where a file ends inside a quoted field,
    the record it was opened in cannot be told: its lines come one by one, ``_broken``, so a stray quote never gathers the rest
    of a file. A carriage return that ends a record is taken off; line breaks inside fields stay as they are.
    """
    narrow = _stepped(lines.select("_file", "_block", "_line", "_out", "_in"))
    # one row per split: what it makes of either state, and the records that begin in it
    splits = narrow.groupBy("_file", "_block").agg(
        *[F.max_by(_after(F.col(f"_state{e}")), "_line").alias(name) for e, name in ((0, "_out"), (1, "_in"))],
        *[F.max(f"_begun{e}").alias(f"_records{e}") for e in (0, 1)])
    along = Window.partitionBy("_file").orderBy("_block")
    splits = entered(splits, along).withColumnRenamed("_state", "_entry").drop("_known")
    splits = splits.withColumns({"_records": F.when(F.col("_entry") == 0, F.col("_records0")).otherwise(F.col("_records1")),
                                 "_exit": F.when(F.col("_entry") == 0, F.col("_out")).otherwise(F.col("_in"))})
    holder = F.when(F.col("_records") > 0, F.struct("_block", "_records"))
    whole = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    splits = cut(splits.select(
        "_file", "_block", "_entry", F.last(holder, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_owner"),
        F.when(F.last("_exit").over(whole), F.last(holder, ignorenulls=True).over(whole)).alias("_open")))
    rows = _stepped(lines).join(splits, ["_file", "_block"])
    state = F.when(F.col("_entry") == 0, F.col("_state0")).otherwise(F.col("_state1"))
    begun = F.when(F.col("_entry") == 0, F.col("_begun0")).otherwise(F.col("_begun1"))
    own = F.struct(F.col("_block"), begun.alias("_records"))
    rows = rows.select("_file", "_block", "_line", "value", F.when(begun > 0, own).otherwise(F.col("_owner")).alias("_record"), "_open",
                       ((state == 0) & ~_after(state)).alias("_alone"))
    rows = rows.withColumn("_broken", F.coalesce(F.col("_record") == F.col("_open"), F.lit(False)))
    single = rows.where("_alone or _broken").select("_file", "value", "_broken")
    piece = F.struct("_block", "_line", "value")
    several = rows.where("not (_alone or _broken)").groupBy("_file", "_record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["value"]), "\n").alias("value"))
    both = single.unionAll(several.select("_file", "value", F.lit(False)))
    return both.withColumn("value", F.regexp_replace("value", r"\r\z", ""))
