"""Type-2 history from change files, and roster snapshots.

A change file holds deletes and upserts of one date. Deletes are applied before the upserts of
their file. A version stays open until a delete reaches it; an upsert alone does not close its
predecessor unless asked for. Rows that share a natural key within a file are packed into one
version, whose id lists all their ids; a delete of any of them closes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.aggregate import first_by
from lakeloom.operators.joins import anti, semi
from lakeloom.operators.ordered import Scan, attach, is_hot, scan
from lakeloom.session import cut

OPEN_END = "9999-12-31"
PACK = r"\|"


def versions_of(changes: DataFrame, natural: str, id: str, date: str, op: str) -> DataFrame:
    """Upserts packed per file and natural key: distinct values joined, ids sorted.

    Whatever is no delete is an upsert, a missing op too. Rows without id stay as they are.
    """
    rows = changes.where(~F.col(op).eqNullSafe("delete")).drop(op)
    others = [c for c in rows.columns if c not in (natural, date)]
    packed = [
        F.nullif(F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), "|"), F.lit("")).alias(c)
        for c in others
    ]
    keyed = rows.where(F.col(natural).isNotNull()).groupBy(natural, date).agg(*packed)
    loose = rows.where(F.col(natural).isNull()).select(
        natural, date, *[F.col(c).cast("string").alias(c) for c in others]
    )
    # two rows of one file may carry the same id under different natural keys: keep one version, by a total order
    both = keyed.unionByName(loose)
    named = first_by(both.where(F.col(id).isNotNull()), [id, date], [natural, *sorted(c for c in others if c != id)])
    return named.unionByName(both.where(F.col(id).isNull()))


def closings_of(changes: DataFrame, versions: DataFrame, id: str, date: str, op: str,
                full: Column | None = None) -> DataFrame:
    """Dates at which a delete names a version chain directly or through its packed ids.

    Deletes in a full file close nothing: they leave the end open.
    """
    open_end = F.lit(OPEN_END).cast("date")
    end = F.date_sub(date, 1) if full is None else F.when(full, open_end).otherwise(F.date_sub(date, 1))
    deletes = changes.where(F.col(op) == "delete").select(
        F.col(id).cast("string").alias("_piece"), F.col(date).alias("_at"), end.alias("_end")
    ).distinct()
    chains = versions.select(id).distinct().select(id, F.explode(F.split(id, PACK)).alias("_piece"))
    return chains.join(deletes, "_piece").select(id, "_at", "_end").distinct()


def replay(changes: DataFrame, natural: str, id: str, date: str, op: str, full: Column | None = None,
           which_delete: str = "last", close_on_upsert: bool = False,
           max_group_rows: int | None = None, reached_name: str | None = None) -> DataFrame:
    """History of all change files at once: effective_date, end_date and version (1 = newest).

    Rows without id are versions of their own, with number 1. ``reached_name`` adds a column that says whether a delete
    reached the version, be it one of a full file.
    """
    # kept once: chains, marks and the result all read the packed versions, and each size is measured
    versions = cut(versions_of(changes, natural, id, date, op))
    closings = cut(closings_of(changes, versions, id, date, op, full))
    closed = reached(versions, closings, id, date, max_group_rows)
    pick = F.max_by if which_delete == "last" else F.min_by
    ends = closed.groupBy(id, "_version").agg(pick("_end", "_at").alias("_end")).withColumnsRenamed({"_version": date})
    joined = attach(versions, ends, [id, date])
    if reached_name:
        joined = joined.withColumn(reached_name, F.col("_end").isNotNull())
    joined = joined.withColumn("end_date", F.coalesce(F.col("_end"), F.lit(OPEN_END).cast("date"))).drop("_end")
    hot = is_hot(versions.where(F.col(id).isNotNull()), [id], max_group_rows)
    return numbered(joined, id, date, close_on_upsert, max_group_rows, hot).withColumnRenamed(date, "effective_date")


def numbered(versions: DataFrame, id: str, date: str, close_on_upsert: bool = False, max_group_rows: int | None = None,
             hot: bool | None = None) -> DataFrame:
    """Versions with end_date plus ``version``, 1 for a chain's newest; with ``close_on_upsert`` each ends before the next begins."""
    chained = scan(versions.where(F.col(id).isNotNull()), [id], [F.desc(date)], Scan(row_number="version", prev={"_following": F.col(date)}),
                   max_group_rows, hot)
    if close_on_upsert:
        chained = chained.withColumn("end_date", F.least("end_date", F.date_sub("_following", 1)))
    alone = versions.where(F.col(id).isNull()).withColumn("version", F.lit(1))
    return chained.withColumn("version", F.col("version").cast("int")).drop("_following").unionByName(alone)


def reached(versions: DataFrame, closings: DataFrame, id: str, date: str,
            max_group_rows: int | None = None) -> DataFrame:
    """The version each closing reaches: the newest one strictly before it."""
    marks = versions.select(id, F.col(date).alias("_at"), F.lit(1).alias("_kind"),
                            F.lit(None).cast("date").alias("_end"), F.col(date).alias("_version"))
    lines = closings.select(id, "_at", F.lit(0).alias("_kind"), "_end", F.lit(None).cast("date").alias("_version"))
    merged = scan(marks.unionByName(lines), [id], ["_at", "_kind", "_end"],
                  Scan(last={"_reached": F.col("_version")}), max_group_rows)
    return merged.where("_kind = 0 and _reached is not null").select(
        id, "_at", "_end", F.col("_reached").alias("_version")
    )


def apply_batch(history: DataFrame, batch: DataFrame, natural: str, id: str, op: str, file_date: Column, full: bool = False,
                which_delete: str = "last", close_on_upsert: bool = False, reached_name: str | None = None) -> DataFrame:
    """Apply one change file, later than all before it, to a history made by replay with the same rules.

    With ``which_delete="first"`` a version that a delete has reached keeps its end; the history must tell it by
    ``reached_name``.
    """
    if which_delete == "first" and not reached_name:
        raise ValueError("the first delete counts: the history must say which versions one has reached")
    at = batch.withColumn("_at", file_date)
    end = F.lit(OPEN_END).cast("date") if full else F.date_sub(file_date, 1)
    deleted = at.where(F.col(op) == "delete").select(F.col(id).cast("string").alias("_gone")).distinct()
    newest = history.where("version = 1").select(id, F.explode(F.split(id, PACK)).alias("_piece"))
    hit = semi(newest, deleted, {"_piece": "_gone"}).select(id).distinct().withColumn("_hit", F.lit(True))
    fresh = versions_of(at, natural, id, "_at", op).withColumnRenamed("_at", "effective_date")
    # a chain is renewed once, whatever stands for it; rows without id belong to none
    renewed = fresh.where(F.col(id).isNotNull()).select(id).distinct().withColumn("_renewed", F.lit(True))
    kept = attach(attach(history, hit, [id]), renewed, [id])
    is_hit = F.coalesce(F.col("_hit"), F.lit(False)) & (F.col("version") == 1)
    is_renewed = F.coalesce(F.col("_renewed"), F.lit(False))
    ends = F.when(is_hit & (~F.col(reached_name) if which_delete == "first" else F.lit(True)), end).otherwise(F.col("end_date"))
    if close_on_upsert:
        ends = F.when(is_renewed & (F.col("version") == 1), F.least(ends, F.date_sub(file_date, 1))).otherwise(ends)
    changed = {"end_date": ends, "version": F.col("version") + F.when(is_renewed, 1).otherwise(0)}
    added = {"end_date": F.lit(OPEN_END).cast("date"), "version": F.lit(1)}
    if reached_name:
        changed[reached_name] = F.col(reached_name) | is_hit
        added[reached_name] = F.lit(False)
    kept = kept.withColumns(changed).drop("_hit", "_renewed")
    return kept.unionByName(fresh.withColumns(added).select(*kept.columns))


def version_id(id: str = "id", version: str = "version") -> Column:
    """The bare id for the newest version, id-2, id-3 ... for older ones."""
    return F.when(F.col(version) == 1, F.col(id)).otherwise(F.concat_ws("-", id, version))


def audit(changes: DataFrame, natural: str, id: str, date: str, op: str,
          max_group_rows: int | None = None) -> DataFrame:
    """Planned and actual counts per change file, from one pass instead of a count per step."""
    versions = cut(versions_of(changes, natural, id, date, op))
    is_delete = F.col(op).eqNullSafe("delete")
    raw = changes.groupBy(date).agg(
        F.count(F.lit(1)).alias("delta_raw"), F.count_if(is_delete).alias("delete_raw"),
        F.count_if(~is_delete).alias("upsert_raw"),
    )
    repeated = (
        changes.where(~is_delete & F.col(natural).isNotNull()).groupBy(date, natural).count()
        .groupBy(date).agg(F.count_if(F.col("count") > 1).alias("upsert_duplicates"))
    )
    actual = versions.groupBy(date).agg(F.count(F.lit(1)).alias("upsert_actual"))
    first_seen = versions.groupBy(F.col(id).alias("_chain")).agg(F.min(date).alias("_first"))
    deletes = changes.where(is_delete).select(F.col(id).cast("string").alias("_gone"), date)
    unmatched = (
        deletes.join(first_seen, F.col("_gone") == F.col("_chain"), "left")
        .groupBy(date).agg(F.count_if(F.coalesce(F.col("_first") >= F.col(date), F.lit(True)))
                           .alias("delete_without_match"))
    )
    closings = cut(closings_of(changes, versions, id, date, op))
    closed = reached(versions, closings, id, date, max_group_rows)
    reach = closed.groupBy(F.col("_at").alias(date)).agg(F.count(F.lit(1)).alias("delete_actual"))
    out = raw
    for part in (repeated, actual, unmatched, reach):
        out = out.join(part, date, "left")
    out = out.na.fill(0)
    out = scan(out, [], [date], Scan(sums={"total_actual": F.col("upsert_actual")}), max_group_rows)
    return out.withColumns({
        "total_before": F.col("total_actual") - F.col("upsert_actual"),
        "upsert_planned": F.col("upsert_raw") - F.col("upsert_duplicates"),
        "delete_planned": F.col("delete_raw") - F.col("delete_without_match"),
    })


def roster_refresh(old: DataFrame, new: DataFrame, id: str, active: str, stamped: str, as_of: Column) -> DataFrame:
    """New snapshot plus members it lost, marked inactive; the date is set on the first loss only."""
    lost = anti(old, new, {id: id}).withColumns({
        stamped: F.when(F.col(active), as_of).otherwise(F.col(stamped)),
        active: F.lit(False),
    })
    return new.unionByName(lost.select(*new.columns))
