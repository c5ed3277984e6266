"""Silver and gold datasets as chains of operators over generic column names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import dates, rules, text
from lakeloom.functions.names import drop_present, keep_and_rename, replace_in_names
from lakeloom.operators.aggregate import first_by, group_remaining, row_sum
from lakeloom.operators.filters import differs, drop_all_null
from lakeloom.operators.joins import lookup, lookup_each, resolve_code
from lakeloom.operators.ordered import attach, is_hot
from lakeloom.operators.reshape import explode_matches, rows_per_system, split_into, wide_to_long
from lakeloom.operators.windows import (
    current_flag, fill_forward, group_number, latest_value, resubmissions, running_total, surrogate_key,
    with_filled_count,
)
from lakeloom.session import apart, cut


def claims_silver(raw: DataFrame, surgical_codes: DataFrame, descriptions: DataFrame, reasons: DataFrame,
                  kinds: Mapping[str, str], regions: Mapping[str, str], split_region: str,
                  own_specialties: Sequence[str], surgeon: str) -> DataFrame:
    """Typed claims with padded ids, regions, code keys and descriptions.

    raw: reference, provider, facility, member_postal, provider_postal, provider_region, kind,
    specialty, code, code_paid, coordinated, reason, remark, amount
    """
    df = text.map_values(apart(text.trim_strings(raw)), ["kind"], kinds)
    df = text.map_values(df, ["provider", "facility", "code"], {"N/A": None})
    df = apart(df.withColumns({
        "provider": text.zero_pad(F.col("provider"), 9), "facility": text.zero_pad(F.col("facility"), 9),
        "code": text.zero_pad(F.col("code"), 5), "code_paid": text.zero_pad(F.col("code_paid"), 5),
    })).withColumns({
        "coordinated": rules.yes_no(F.col("coordinated")),
        "claim_date": dates.reference_date(F.col("reference")),
        "member_region": text.region_from_code(F.col("member_postal"), regions),
        "facility_region": text.region_from_code(F.col("provider_postal"), regions),
        "member_prefix": text.leading(F.col("member_postal")),
        "facility_prefix": text.leading(F.col("provider_postal")),
        "system": rules.split_system(F.col("provider_region"), split_region, split_region, "CAN"),
    })
    # what a code stands for is put together once, so that each code column is looked up once
    listed = surgical_codes.select(F.col("code").alias("code")).distinct().withColumn("listed", F.lit(True))
    codes = cut(descriptions.select("code", "description").join(listed, "code", "full"))
    df = lookup_each(apart(df), codes, "code", {"code": "_submitted", "code_paid": "_paid"}, ["description", "listed"])
    key = lambda code, hit: text.code_key(
        F.col(code), F.col("system"), F.col("specialty"),
        rules.surgical(F.col(hit), F.col("specialty"), surgeon), own_specialties, split_region)
    df = df.withColumns({
        "code_key_submitted": key("code", "listed_submitted"), "code_key_paid": key("code_paid", "listed_paid"),
    }).drop("listed_submitted", "listed_paid")
    labels = cut(reasons)
    df = lookup(df, labels, {"reason": "reason"}, {"label": "reason_label"})
    return lookup(df, labels, {"remark": "reason"}, {"label": "remark_label"})


def estimates_silver(raw: DataFrame, descriptions: DataFrame, reasons: DataFrame, regions: Mapping[str, str],
                     split_region: str) -> DataFrame:
    """Typed estimates: padded ids and codes, dates, regions, system, description and reason labels.

    raw: estimate, provider, facility, code, member_postal, provider_region, asked, decided, reason, remark
    """
    df = text.map_values(text.trim_strings(raw), ["provider", "facility", "code"], {"N/A": None})
    df = df.withColumns({
        "provider": text.zero_pad(F.col("provider"), 9), "facility": text.zero_pad(F.col("facility"), 9),
        "code": text.zero_pad(F.col("code"), 5),
        "asked": dates.parse_date(F.col("asked")), "decided": dates.parse_date(F.col("decided")),
        "member_region": text.region_from_code(F.col("member_postal"), regions),
        "member_prefix": text.leading(F.col("member_postal")),
        "system": rules.split_system(F.col("provider_region"), split_region, split_region, "CAN"),
    })
    df = lookup(df, descriptions, {"code": "code"}, ["description"])
    df = lookup(df, reasons, {"reason": "reason"}, {"label": "reason_label"})
    return lookup(df, reasons, {"remark": "reason"}, {"label": "remark_label"})


def reason_codes(raw: DataFrame, code: str, order: Sequence[str], renames: Mapping[str, str]) -> DataFrame:
    """One row per code, the first along the order, with the renamed columns only."""
    return keep_and_rename(first_by(raw, [code], order), list(renames), renames)


def procedure_descriptions(raw: DataFrame, code: str, renames: Mapping[str, str], length: int = 5) -> DataFrame:
    """Descriptions by padded code, with the renamed columns only."""
    return keep_and_rename(raw.withColumn(code, text.zero_pad(F.col(code), length)), list(renames), renames)


def administration_cost(raw: DataFrame, parts: Sequence[str], total: str, renames: Mapping[str, str]) -> DataFrame:
    """Cost rows with the sum of their parts, nulls as 0, and the renamed columns only."""
    return keep_and_rename(raw.withColumn(total, row_sum(parts)), [*renames, total], renames)


def funding_silver(raw: DataFrame, amounts: Sequence[str], regions: Mapping[str, str]) -> DataFrame:
    """Claim funding: padded ids, total of its amounts, claim date, regions and prefixes."""
    return raw.withColumns({
        "provider": text.zero_pad(F.col("provider"), 9),
        "total_amount": row_sum(amounts),
        "claim_date": dates.reference_date(F.col("reference")),
        "member_region": text.region_from_code(F.col("member_postal"), regions),
        "member_prefix": text.leading(F.col("member_postal")),
    })


def contract_cost(raw: DataFrame, year: str, month: str, budgets: Mapping[str, str],
                  max_group_rows: int | None = None) -> DataFrame:
    """Spending to date within a year and the remaining budget; budgets map spending to budget columns."""
    df, money = raw, lambda c: F.col(c).cast("decimal(18,2)")
    hot = is_hot(raw, [year], max_group_rows)
    for spent, budget in budgets.items():
        df = running_total(df, [year], [month], money(spent), f"{spent}_to_date", max_group_rows, hot)
        df = group_remaining(df, [year], money(budget), F.col(f"{spent}_to_date"), f"{budget}_remaining", hot=hot)
    return df


def billing_long(raw: DataFrame, ids: Sequence[str], counts: Sequence[str], totals: Sequence[str],
                 yes: str = "Direct", no: str = "Non_Direct") -> DataFrame:
    """Wide billing counts as rows of specialty and method; blanks count as 0."""
    df = drop_present(raw, totals)
    df = df.withColumns({c: F.col(c).cast("string") for c in counts})
    long = wide_to_long(df, ids, counts, "variable", "count")
    long = text.map_values(long, ["count"], {}, default="0")
    parts = split_into(F.col("variable"), ["specialty", "direct"], "_")
    out = long.select(*ids, *parts, text.to_int_or_zero(F.col("count")).alias("count"))
    return out.withColumn("direct", text.mapped(F.col("direct"), {yes: "Yes", no: "No"}))


def population_long(raw: DataFrame, region: str, groups: Mapping[str, int], total: str, prefix: str = "") -> DataFrame:
    """Population by age group: total row dropped, long form, lowest age of each group."""
    df = raw.where(differs(F.col(region), total))
    df = replace_in_names(df, prefix, "") if prefix else df
    long = wide_to_long(df, [region], list(groups), "age_group", "population")
    lowest = text.value_map(groups)
    return text.map_values(long, [region], {}).withColumn(
        "lowest_age", F.coalesce(F.try_element_at(lowest, F.col("age_group")), F.lit(0)))


def code_reference(raw: DataFrame, document: str, seq: str, schedules: Sequence[str], first_code: str,
                   second_codes: str, replacements: DataFrame, exceptions: DataFrame, systems: tuple[str, str],
                   own_specialties: Sequence[str], surgeon: str, valid: tuple[str, str] = ("2024-01-01", "9999-12-31"),
                   max_group_rows: int | None = None) -> DataFrame:
    """Code list from an outline: descriptions carried down, packed codes split, one row per key."""
    df = cut(drop_all_null(raw, schedules))
    hot = is_hot(df, [document], max_group_rows)
    df = group_number(df, [document], [seq], "description", "procedure", max_group_rows, hot)
    df = fill_forward(df, [document], [seq], ["description"], max_group_rows=max_group_rows, hot=hot)
    df = explode_matches(df, second_codes, r"(\d{5}\s*[A-Z]{2})", "second_code")
    df = text.trim_strings(df)
    df = df.withColumns({
        "second_code": text.tidy_pair(F.col("second_code"), r"(\d{5})\s*([A-Z]{2})"),
        "schedule": text.filled_names(schedules),
        "notes": text.notes_after(F.col(second_codes), r"\d{5}\s*[A-Z]{2}"),
    })
    df = rows_per_system(df, seq, first_code, "second_code", systems, [document, "second_code"])
    base, specialty = split_into(F.col("code"), ["code_base", "specialty"], " ")
    df = df.select("*", base, specialty)
    df = df.withColumns({"code": text.zero_pad(F.col("code"), 5), "code_base": text.zero_pad(F.col("code_base"), 5)})
    df = df.withColumn("code_key", text.code_key(
        F.col("code_base"), F.col("system"), F.col("specialty"), F.col("specialty") == surgeon,
        own_specialties, systems[1]))
    df = first_by(df, ["code_key"], [document, seq, "system", "code"])
    df = lookup(df, replacements, {"code": "code"}, {"description": "_replaced"})
    df = df.withColumn("description", text.overwrite_where_present(F.col("description"), F.col("_replaced")))
    df = lookup(df.drop("_replaced"), exceptions, {"code": "code"}, {"starts": "exception_start"})
    return df.withColumns({n: F.lit(d).cast("date") for n, d in zip(("start_date", "end_date"), valid)})


def contact_centre(raw: DataFrame, seconds: Sequence[str], label: str, words: Mapping[str, str]) -> DataFrame:
    """Call figures in minutes, with labels in a second language."""
    minutes = {f"{c}_minutes": dates.minutes(F.col(c)) for c in seconds}
    return raw.withColumns({**minutes, f"{label}_2": text.mapped(F.col(label), words)}).drop(*seconds)


def copay_tiers(tiers: DataFrame, members: DataFrame, number: str, member: str, tie: Sequence[str]) -> DataFrame:
    """Tier per member: keys made unique before and after the join."""
    people = first_by(members.select(number, member).distinct(), [number], [member])
    joined = lookup(tiers, people, {number: number}, [member])
    known = joined.where(F.col(member).isNotNull())
    return keep_and_rename(first_by(known, [member], [number, *tie]), [number, member, *tie])


def gold_members(members: DataFrame, tiers: DataFrame, as_of: Column,
                 tie: Sequence[str] = ("unit", "coverage_start", "coverage_end"),
                 max_group_rows: int | None = None) -> DataFrame:
    """Members with a unique key, current flags, coverage and ages.

    members: client, unit, effective_date, end_date, applied_on, eligible_on, birth_date,
    coverage_start, coverage_end, enrolled (boolean); ``tie`` decides between rows that tie
    """
    # group sizes are measured once on the input; no later step changes them
    many = is_hot(members, ["client"], max_group_rows)
    many_units = is_hot(members, ["unit"], max_group_rows)
    df = with_filled_count(members)
    df = surrogate_key(df, "client", "unit", ["effective_date", "applied_on", F.desc("filled"), "end_date"],
                       list(tie), "member_key", max_group_rows, many)
    key = ["key_rank", "key_number"]
    df = current_flag(df, ["client"], key, "current_client", hot=many)
    df = current_flag(df, ["unit"], key, "current_unit", hot=many_units)
    df = current_flag(df, ["unit"], ["effective_date"], "current_record", hot=many_units)
    df = lookup(df, tiers, {"client": "client"}, ["tier"])
    c = F.col
    return df.withColumns({
        "covered": dates.active_on(c("enrolled"), c("coverage_start"), c("coverage_end"), as_of),
        "age_now": dates.whole_years(c("birth_date"), as_of),
        "age_applied": dates.age_at(c("birth_date"), c("applied_on"), c("eligible_on")),
    }).drop("filled", "key_rank", "key_number")


def gold_claims(claims: DataFrame, tiers: DataFrame, dimension: DataFrame) -> DataFrame:
    """Claims with the latest type per provider, latest region and age per member, tier and validity.

    claims: claim, provider, site, member, kind, region, age, service_date, claim_date
    """
    facts = cut(claims)  # the facts are joined once; both aggregates read their narrow columns from the table
    at = ["service_date", "claim_date", "kind"]
    kinds = facts.groupBy("provider").agg(F.max_by("kind", F.struct(*at)).alias("current_kind"))
    at = F.struct("service_date", "claim")
    seen = facts.groupBy("member").agg(F.max_by("region", at).alias("latest_region"), F.max_by("age", at).alias("latest_age"))
    df = attach(attach(facts, kinds, ["provider"]), seen, ["member"])
    df = df.withColumn("uid", text.key_of(["provider", "site"]))
    df = lookup(df, tiers, {"member": "member"}, ["tier"])
    return lookup(df, dimension, {"uid": "uid"}, ["valid", "active"])


def gold_estimates(estimates: DataFrame, groups: Sequence[tuple[str, Sequence[str]]], incomplete: Sequence[str],
                   tiers: DataFrame, max_group_rows: int | None = None) -> DataFrame:
    """Estimates with resubmission number, code group, outcome, latest region, key and tier.

    estimates: estimate, provider, site, member, code, tooth, surface, indicator, asked, decided,
    paid, reason, remark, region, service_date
    """
    estimates = cut(estimates)  # the facts are joined once
    df = resubmissions(estimates, ["member", "code", "tooth", "surface"], "asked", "decided",
                       F.col("indicator") == "Required", ["estimate"], max_group_rows=max_group_rows)
    df = df.withColumns({
        "code_group": rules.prefix_group(F.col("code"), groups, "Others"),
        "outcome": rules.outcome_group(F.col("paid"), [F.col("reason"), F.col("remark")], incomplete),
        "uid": text.key_of(["provider", "site"]),
    })
    seen = estimates.groupBy("member").agg(F.max_by("region", F.struct("service_date", "estimate")).alias("latest_region"))
    df = attach(df, seen, ["member"])
    return lookup(df, tiers, {"member": "member"}, ["tier"])


def roster_silver(raw: DataFrame, snapshot: Column, regions: Mapping[str, str], specialties: Mapping[str, str]) -> DataFrame:
    """Provider roster: snapshot date, mapped specialty, padded id, billing flag, region, prefix and area.

    raw: provider, specialty, postal, direct (Y/N), joined_on
    """
    df = text.map_values(text.trim_strings(raw), ["specialty"], specialties)
    postal = F.col("postal")
    return df.withColumns({
        "provider": text.zero_pad(F.col("provider"), 9), "direct": rules.yes_no(F.col("direct")),
        "region": text.region_from_code(postal, regions), "prefix": text.leading(postal), "area": text.area_type(postal),
        "snapshot": snapshot, "enrolled": F.lit(True),
    })


def applications_silver(raw: DataFrame, labels: Sequence[str], words: Mapping[str, str], first: Sequence[str]) -> DataFrame:
    """Counts by label: blanks to Unknown, labels in a second language, first filled of several columns."""
    df = text.map_values(raw, labels, {})
    second = {f"{c}_2": text.mapped(F.col(c), words) for c in labels}
    return df.withColumns({**second, "channel": F.coalesce(*[F.col(c) for c in first])}).drop(*first)


def postal_silver(raw: DataFrame, active: str, names_by_region: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postal codes in use with area and region name, and the prefix table derived from them.

    raw: postal (without blank), region, status, place
    """
    df = text.map_values(raw.where(F.col("status") == active), ["place"], {})
    df = df.withColumns({"area": text.area_type(F.col("postal")), "postal": text.insert_at(F.col("postal"), " ", [3])})
    df = lookup(df, names_by_region, {"region": "region"}, ["region_name"])
    codes = keep_and_rename(df, ["postal", "region", "region_name", "area", "place"])
    prefixes = codes.withColumn("prefix", text.leading(F.col("postal")))
    return codes, first_by(prefixes.drop("place", "postal"), ["prefix"], ["region", "area", "region_name"])


def members_silver(raw: DataFrame, zone: str, regions: Mapping[str, str], kinds: Sequence[str]) -> DataFrame:
    """Member records: local times, address in use, eligibility and enrolment.

    raw: id, kind, home_street, home_region, mail_street, mail_region, applied_at, enrolled_at,
    coverage_start, coverage_end
    """
    df = text.map_values(raw, ["home_region", "mail_region"], regions)
    local = lambda c: dates.to_local(F.col(c), zone).cast("date")
    df = df.withColumns({"applied_on": local("applied_at"), "enrolled_on": local("enrolled_at")}).drop("applied_at", "enrolled_at")
    df = df.withColumns(rules.either_address(
        {"street": "home_street", "region": "home_region"}, {"street": "mail_street", "region": "mail_region"}, "region"))
    df = df.withColumn("empty_period", rules.same_day(F.col("coverage_start"), F.col("coverage_end")))
    df = df.withColumn("eligible", rules.eligible(F.col("empty_period"), F.col("kind"), kinds))
    return df.withColumn("enrolled", rules.enrolled(F.col("eligible"), F.col("enrolled_on")))


def wide_counts(raw: DataFrame, ids: Sequence[str], counts: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """Monthly counts in columns as rows, without their totals."""
    return wide_to_long(drop_present(raw, totals), ids, counts, "kind", "count")


def gold_funding(funding: DataFrame, dimension: DataFrame, tiers: DataFrame) -> DataFrame:
    """Funding with site validity, the member's latest region and tier.

    funding: claim, provider, site, member, region, claim_date
    """
    df = cut(funding.withColumn("uid", text.key_of(["provider", "site"])))  # the facts are joined once
    df = latest_value(df, ["member"], ["claim_date", "claim"], {"region": "latest_region"})
    df = lookup(df, dimension, {"uid": "uid"}, ["valid", "active"])
    return lookup(df, tiers, {"member": "member"}, ["tier"])


def code_investigation(claims: DataFrame, reference: DataFrame, stand_ins: DataFrame, excluded: str) -> DataFrame:
    """Claims by list tag and resolved code, with paid totals, for codes of paid claims.

    claims: code, specialty, paid; reference: code; stand_ins: code, dummy
    """
    paid = claims.where((F.col("paid") > 0) & (F.col("specialty") != excluded))
    # codes repeat over the claims: totals per code come first, so each code is resolved once
    per_code = paid.groupBy("code", "specialty").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("paid").cast("decimal(18,2)")).alias("amount"))
    found = resolve_code(per_code, "code", reference, "code", stand_ins, "code", "dummy")
    return found.groupBy("list_tag", "resolved", "specialty").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("amount").alias("amount"), F.count_distinct("code").alias("n_codes"))
