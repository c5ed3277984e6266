"""Shards by rendezvous hashing of a stable record key over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slots are counted inside this many hash buckets of each shard, so no task orders a whole shard.
SLOT_BUCKETS = 4096


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key: the one with the largest ``ln(u) / weight``, u uniform in key and shard.

    Each shard's score depends on the key and that shard alone. So one more shard takes records only
    into itself, one less gives away only its own, and a changed weight moves only its difference.
    A weight of 0 gets nothing. Equal scores go to the higher number.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be above zero")
    scores = []
    for i, weight in enumerate(weights):
        if weight:
            uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(i)), 11) + 0.5) / float(1 << 53)
            scores.append(F.struct((F.log(uniform) / float(weight)).alias("score"), F.lit(i).alias("shard")))
    return F.greatest(*scores)["shard"] if len(scores) > 1 else scores[0]["shard"]


def shard(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, *, id: str = "doc_id",
          text: str = "text", slot_buckets: int = SLOT_BUCKETS) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard (with the weights ``grown``).

    The key is the id alone; a null id falls back to the text, so that such rows spread too. Size is the
    text's UTF-8 bytes plus 1 (null text: no bytes, crc 0). Slots count every shard from 0 without a gap,
    ordered by (bucket, id, crc, size): buckets are counted first, then rows only inside their bucket.
    Rows equal in all three get slots of their own. Other columns are not carried, whatever their names;
    an empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
    )
    key = F.coalesce(F.xxhash64(F.col("doc_id"), F.lit("key")), F.lit(0).cast("long"))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text_crc32", "size")).otherwise(key)
    placed = rows.withColumn("k", key).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"),
        rendezvous(F.col("k"), weights).alias("shard"),
        (rendezvous(F.col("k"), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.pmod(F.xxhash64("k", "text_crc32", "size"), F.lit(slot_buckets)).cast("int").alias("bucket"),
    )
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return placed.withColumn("nth", F.row_number().over(inside)).join(base, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("base") + F.col("nth") - 1).alias("slot"), "grown_shard")
