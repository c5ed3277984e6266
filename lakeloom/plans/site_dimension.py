"""Entity dimension: one row per member and site, from facts and a roster."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.rules import first_match, is_true
from lakeloom.functions.text import area_type, key_of, mapped
from lakeloom.operators.aggregate import first_by
from lakeloom.operators.joins import anti, lookup
from lakeloom.operators.ordered import attach

def site_dimension(facts: DataFrame, roster: DataFrame, mapping: DataFrame, start: str, excluded: str,
                   specialties: Mapping[str, str], regions: Mapping[str, str],
                   labels: Mapping[str, Mapping[str, str]], joined: str = "Participating",
                   single: str = "Per claim", unknown: str = "Unknown") -> DataFrame:
    """Members with claims at their sites, then roster members without any.

    facts: member, site, prefix, region, kind, specialty, service_date, submitted_date, paid, coordinated
    roster: member, specialty, region, prefix, joined_on, enrolled (Y/N), language, snapshot_date
    mapping: member, school, school_specialty
    ``joined``, ``single`` and ``unknown`` are the kinds the rules know; other kinds pass through.
    """
    facts = facts.where(F.col("specialty") != excluded).withColumn("uid", key_of(["member", "site"]))
    first_day = F.lit(start).cast("date")

    # one aggregate per key level, joined back to one row per site; no window over the facts
    per_member = facts.groupBy("member").agg(
        F.max("service_date").alias("last_service"),
        F.min(F.when(F.col("submitted_date") >= first_day, F.col("submitted_date")).otherwise(first_day))
        .alias("first_claim"),
        F.sum(F.col("paid").cast("decimal(18,2)")).alias("_paid"),
        F.sum(F.col("coordinated").cast("decimal(18,2)")).alias("_coordinated"),
    )
    latest = ["service_date", "submitted_date", "kind", "region", "prefix", "specialty"]
    site = first_by(facts.select("uid", "member", "site", *latest), ["uid"], latest, latest=True)
    site = attach(site.drop("service_date", "submitted_date"), per_member, ["member"])
    paid = F.when((F.col("_paid") > 0) | (F.col("_coordinated") > 0), F.lit("Y")).otherwise(F.lit("N"))
    site = site.withColumns({"paid_status": paid, "area": area_type(F.col("prefix"))}).drop("_paid", "_coordinated")
    with_claims = lookup(site, roster, {"member": "member"},
                         {"joined_on": "joined_on", "enrolled": "enrolled", "language": "language"})

    without = anti(roster, site, {"member": "member"}).withColumns({
        "site": F.lit("0"), "uid": key_of([F.col("member"), F.lit("0")]), "area": area_type(F.col("prefix")),
    }).withColumnRenamed("snapshot_date", "left_on")
    both = with_claims.unionByName(without, allowMissingColumns=True)

    kind = F.col("kind")
    both = both.withColumn("joined_on", first_match([
        (kind == single, F.col("first_claim")),
        ((kind == joined) & F.col("joined_on").isNull(), F.col("first_claim")),
    ], F.col("joined_on")))
    both = both.withColumn("kind", first_match([
        ((F.col("enrolled") == "Y") & kind.isNull(), F.lit(joined)),
        ((F.col("enrolled") == "N") & kind.isNull(), F.lit(unknown)),
    ], kind))
    unpaid = kind.isin(joined, unknown) & F.col("paid_status").isNull()
    both = both.withColumn("paid_status", F.when(unpaid, F.lit("N")).otherwise(F.col("paid_status")))

    both = lookup(both, mapping, {"member": "member"}, ["school", "school_specialty"])
    both = both.withColumns({
        "specialty": mapped(F.col("specialty"), specialties), "region": mapped(F.col("region"), regions),
    })
    out = both.select(
        "uid", "member", "site", "prefix", "region", "area", "kind", "specialty", "joined_on", "last_service",
        "paid_status", "language", "left_on", "school", "school_specialty",
        key_of(["prefix", "specialty"]).alias("billing_key"),
        is_true(kind.isin(joined, single)).alias("valid"),
        is_true(kind == joined).alias("active"),
        *[mapped(F.col(c), words, on_missing="null").alias(f"{c}_2") for c, words in labels.items()],
    )
    return first_by(out, ["uid"], ["school", "school_specialty", "joined_on", "left_on"])
