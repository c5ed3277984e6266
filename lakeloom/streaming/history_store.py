"""Type-2 history kept from a stream of change files, at the cost of what each batch touches.

Four tables lie below the store's folder, each partitioned by batch and by a hash bucket of its key: ``changes`` as they
came, ``deletes`` by the id they name, ``chains`` (an id and the packed id that holds it) and ``versions``. A batch reads the buckets of
the chains it touches and appends the versions that are new or whose end it moves; version numbers follow from the order
of dates and are worked out by the reader. So what a batch writes does not grow with the history. A late file finds the deletes
that came before it, since these are kept. A batch that is tried again overwrites its own partitions and reads only
those of earlier batches.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeloom.operators.history import OPEN_END, PACK, numbered, reached, versions_of
from lakeloom.operators.joins import anti, semi
from lakeloom.session import cut

#: Hash buckets of each table: a batch opens the files of the buckets it touches, and names them on the driver.
BUCKETS = 64
AUDIT = ("batch int, first_date date, last_date date, total_before long, delta_raw long, delete_raw long, delete_without_match long, "
         "delete_without_match_detailed long, delete_without_match_no_duplicates long, delete_planned long, delete_actual long, upsert_raw long, "
         "upsert_duplicates long, upsert_planned long, upsert_actual long, total_duplicate long, total_planned long, total_actual long")


def keep(changes: DataFrame, path: str, checkpoint: str, natural: str, id: str, date: str, op: str, full: Column | None = None,
         which_delete: str = "last", buckets: int = BUCKETS) -> StreamingQuery:
    """Apply all change files that are available to the store, then stop.

    Files may come in any order and several in a batch; all rows of a date must come in one batch. Rules are those of
    ``history.replay``: ``full`` marks rows of full files, whose deletes close nothing; ``which_delete`` says which of the deletes that
    reach a version sets its end. A further file of a date adds no version to a chain that has one of that date. Every
    batch leaves a row of counters, ``audit``.
    """
    store = _Store(changes.sparkSession, path, changes.schema, natural, id, date, op, buckets)
    store.prepare()
    return changes.writeStream.foreachBatch(store.step(full, which_delete)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str, schema: T.StructType, natural: str, id: str, date: str, op: str, close_on_upsert: bool = False) -> DataFrame:
    """The history as ``history.replay`` gives it: effective_date, end_date, version; with ``close_on_upsert`` an upsert ends its predecessor."""
    store = _Store(spark, path, schema, natural, id, date, op, BUCKETS)
    versions = store.newest(store.stored("versions").drop("bucket")).drop("_closed_on")
    return numbered(versions.withColumnRenamed("_end", "end_date"), id, date, close_on_upsert).withColumnRenamed(date, "effective_date")


def audit(spark: SparkSession, path: str) -> DataFrame:
    """Planned and actual counts of every batch, as counted while it was written.

    ``delete_without_match`` counts delete rows that name no whole chain id with an earlier version, ``..._detailed`` the versions these
    reach as one of several packed ids, ``..._no_duplicates`` the natural keys among them. ``delete_planned`` is chains times delete dates that
    have a version to close, ``delete_actual`` the ones that reached one. ``upsert_duplicates`` are rows packed into another;
    ``total_duplicate`` counts chains that were there before and got a further version. Totals are versions.
    """
    return spark.read.schema(AUDIT).parquet(f"{path}/audit").select(*T.StructType.fromDDL(AUDIT).names)


class _Store:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, natural: str, id: str, date: str, op: str, buckets: int):
        self.spark, self.path, self.natural, self.id, self.date, self.op, self.n = spark, path.rstrip("/"), natural, id, date, op, buckets
        self.changes = schema
        versions = versions_of(spark.createDataFrame([], schema), natural, id, date, op).schema
        day = T.DateType()
        self.schemas = {
            "versions": T.StructType([*versions, T.StructField("_closed_on", day), T.StructField("_end", day)]),
            "chains": T.StructType([T.StructField("_piece", T.StringType()), T.StructField(id, T.StringType())]),
            "deletes": T.StructType([T.StructField("_piece", T.StringType()), T.StructField("_at", day), T.StructField("_end", day)]),
        }
        self.values = [c for c in versions.names if c not in (id, date)] + ["_closed_on", "_end"]

    def prepare(self) -> None:
        """The tables' folders, so that the first batch finds them empty."""
        for name, schema in self.schemas.items():
            self.spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path}/{name}")
        self.spark.createDataFrame([], AUDIT).write.mode("append").parquet(f"{self.path}/audit")

    def bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.n)).cast("int").alias("bucket")

    def put(self, rows: DataFrame, name: str, key: str, number: int) -> None:
        rows.withColumn("bucket", self.bucket(key)).hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}/batch={number}")

    def stored(self, name: str, before: int | None = None, keys: DataFrame | None = None, key: str = "") -> DataFrame:
        """Rows of earlier batches, from the buckets of the given keys only: these are partitions, and at most as many as there are buckets."""
        schema = T.StructType([*self.schemas[name], T.StructField("batch", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        if keys is not None:
            found = [r[0] for r in keys.select(self.bucket(key)).distinct().collect()]
            rows = rows.where(F.col("bucket").isin(found)) if found else rows.where("false")
        return rows

    def newest(self, rows: DataFrame) -> DataFrame:
        """The last written row of each version; rows without id are never written again."""
        known = rows.where(F.col(self.id).isNotNull()).groupBy(self.id, self.date).agg(F.max_by(F.struct(*self.values), "batch").alias("_v"))
        return known.select(self.id, self.date, "_v.*").unionByName(rows.where(F.col(self.id).isNull()).drop("batch"))

    def step(self, full: Column | None, which_delete: str) -> Callable[[DataFrame, int], None]:
        pick = F.max_by if which_delete == "last" else F.min_by

        def run(batch: DataFrame, number: int) -> None:
            id, date, natural = self.id, self.date, self.natural
            self.spark = spark = batch.sparkSession
            gone = F.col(self.op).eqNullSafe("delete")
            log, seen = f"{self.path}/changes/batch={number}", Observation()
            batch.observe(seen, F.count(F.lit(1)).alias("delta"), F.count_if(gone).alias("deletes"), F.count_if(~gone).alias("upserts"),
                          F.min(date).alias("first"), F.max(date).alias("last")).write.mode("overwrite").parquet(log)
            mine = spark.read.schema(self.changes).parquet(log)
            fresh = cut(versions_of(mine, natural, id, date, self.op))
            end = F.date_sub(date, 1) if full is None else F.when(full, F.lit(OPEN_END).cast("date")).otherwise(F.date_sub(date, 1))
            named = mine.where(gone).select(F.col(id).cast("string").alias("_piece"), F.col(date).alias("_at"), end.alias("_end"))
            deletes = cut(named.where("_piece is not null").distinct())
            pieces = _pieces(fresh, id)
            # the chains that a delete names, directly or as one of its pieces, and those with a new version
            known = self.stored("chains", number, deletes.select("_piece").unionAll(pieces.select("_piece")), "_piece").select("_piece", id).distinct()
            known = cut(known)
            self.put(anti(pieces, known, {"_piece": "_piece", id: id}), "chains", "_piece", number)
            self.put(deletes, "deletes", "_piece", number)
            hit = semi(known.unionByName(pieces), deletes, {"_piece": "_piece"}).select(id)
            touched = cut(hit.unionAll(fresh.where(F.col(id).isNotNull()).select(id)).distinct())
            old = cut(semi(self.newest(self.stored("versions", number, touched, id).drop("bucket")), touched, {id: id}))
            added = anti(fresh.where(F.col(id).isNotNull()), old, {id: id, date: date})
            whole = cut(old.drop("_closed_on", "_end").unionByName(added))
            own = _pieces(touched, id)
            every = self.stored("deletes", number, own, "_piece").select("_piece", "_at", "_end").unionByName(deletes)
            closings = cut(own.join(every.distinct(), "_piece").select(id, "_at", "_end").distinct())
            closed = cut(reached(whole, closings, id, date))
            ends = closed.groupBy(id, F.col("_version").alias(date)).agg(pick(F.struct(F.col("_at").alias("_closed_on"), "_end"), "_at").alias("_by"))
            open_end = F.lit(OPEN_END).cast("date")
            now = whole.join(ends, [id, date], "left").select(*whole.columns, "_by._closed_on", F.coalesce("_by._end", open_end).alias("_end"))
            was = old.select(F.col(id).alias("_id"), F.col(date).alias("_date"), F.col("_closed_on").alias("_was_closed"), F.col("_end").alias("_was_end"))
            both = now.join(was, (F.col(id) == F.col("_id")) & (F.col(date) == F.col("_date")), "left")
            moved = F.col("_id").isNull() | ~F.col("_closed_on").eqNullSafe(F.col("_was_closed")) | (F.col("_end") != F.col("_was_end"))
            loose = fresh.where(F.col(id).isNull()).select(*whole.columns, F.lit(None).cast("date").alias("_closed_on"), open_end.alias("_end"),
                                                          F.lit(True).alias("_new"))
            rows = both.where(moved).select(*now.columns, F.col("_id").isNull().alias("_new")).unionByName(loose)
            kept = Observation()
            self.put(rows.observe(kept, F.count_if("_new").alias("new")).drop("_new"), "versions", id, number)
            self.count(number, mine, named, deletes, fresh, whole, closed, own, seen.get, kept.get)

        return run

    def count(self, number: int, mine: DataFrame, named: DataFrame, deletes: DataFrame, fresh: DataFrame, whole: DataFrame, closed: DataFrame,
              own: DataFrame, seen: dict, kept: dict) -> None:
        """The batch's row of counters, from what was observed and from its own small tables."""
        id, date, natural = self.id, self.date, self.natural
        upserts = mine.where(~F.col(self.op).eqNullSafe("delete"))
        packs = upserts.groupBy(natural, date).agg(F.count(F.lit(1)).alias("n")).agg(
            F.sum(F.when(F.col(natural).isNull(), F.col("n")).otherwise(1)).alias("upsert_planned"))
        spans = whole.groupBy(id).agg(F.min(date).alias("_first"), F.count(F.lit(1)).alias("_n"))
        named = named.groupBy("_piece", "_at").agg(F.count(F.lit(1)).alias("_rows")).join(spans, F.col("_piece") == F.col(id), "left")
        named = named.select("_piece", "_at", "_rows", F.coalesce(F.col("_first") < F.col("_at"), F.lit(False)).alias("_met"))
        apart = own.join(named.where("not _met").select("_piece", "_at"), "_piece").select(id, "_at").distinct()
        reach = apart.join(whole.select(id, date, natural), id).where(F.col(date) < F.col("_at"))
        planned = own.join(deletes.select("_piece", "_at").distinct(), "_piece").select(id, "_at").distinct()
        again = semi(spans.where("_n > 1"), fresh, {id: id})
        parts = [packs, named.agg(F.sum(F.when(~F.col("_met"), F.col("_rows"))).alias("delete_without_match")),
                 reach.agg(F.count(F.lit(1)).alias("delete_without_match_detailed")),
                 reach.agg(F.count_distinct(natural).alias("delete_without_match_no_duplicates")),
                 planned.join(spans, id).where("_first < _at").agg(F.count(F.lit(1)).alias("delete_planned")),
                 semi(closed, planned, {id: id, "_at": "_at"}).agg(F.count(F.lit(1)).alias("delete_actual")),
                 again.agg(F.count(F.lit(1)).alias("total_duplicate"))]
        told = [x.select(F.lit(x.columns[0]).alias("name"), F.coalesce(x.columns[0], F.lit(0)).cast("long").alias("n")) for x in parts]
        counts = dict(map(tuple, reduce(DataFrame.unionAll, told).collect()))  # seven numbers
        last = audit(self.spark, self.path).where(F.col("batch") < number).agg(F.max_by("total_actual", "batch")).first()[0] or 0
        counts |= {"batch": number, "first_date": seen["first"], "last_date": seen["last"], "total_before": last, "delta_raw": seen["delta"],
                   "delete_raw": seen["deletes"], "upsert_raw": seen["upserts"], "upsert_duplicates": seen["upserts"] - counts["upsert_planned"],
                   "upsert_actual": kept["new"], "total_planned": last + counts["upsert_planned"], "total_actual": last + kept["new"]}
        names = T.StructType.fromDDL(AUDIT).names
        self.spark.createDataFrame([tuple(counts[c] for c in names)], AUDIT).drop("batch").write.mode("overwrite").parquet(f"{self.path}/audit/batch={number}")


def _pieces(rows: DataFrame, id: str) -> DataFrame:
    """Each id beside the ids packed in it."""
    return rows.where(F.col(id).isNotNull()).select(id).distinct().select(F.explode(F.split(id, PACK)).alias("_piece"), id).distinct()
