"""Classification rules: bands, prefixes, outcome groups and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule that holds."""
    (condition, value), *rest = rules
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def band(c: Column, bands: Sequence[tuple[float, float | None, str]], default: str = "Unknown") -> Column:
    """Label of the closed range a number falls in; a range without upper end is open."""
    rules = [((c >= low) if high is None else c.between(low, high), F.lit(label)) for low, high, label in bands]
    return first_match(rules, F.lit(default))


def yes_no(c: Column, null_as_false: bool = False) -> Column:
    """Boolean from the first letter, Y or N; anything else is null."""
    letter = F.lower(F.substring(c, 1, 1))
    flag = F.when(letter == "y", F.lit(True)).when(letter == "n", F.lit(False))
    return flag.when(c.isNull(), F.lit(False)) if null_as_false else flag


def prefix_group(c: Column, groups: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Label of the first group one of whose prefixes starts the text."""
    rules = [(reduce(or_, [c.startswith(p) for p in prefixes]), F.lit(label)) for label, prefixes in groups]
    return first_match(rules, F.lit(default))


def outcome_group(paid: Column, codes: Sequence[Column], incomplete: Sequence[str],
                  labels: Sequence[str] = ("Approved", "Incomplete", "Declined", "Other")) -> Column:
    """Approved, incomplete, declined or other; null and negative amounts are other."""
    approved, lacking, declined, other = (F.lit(x) for x in labels)
    listed = reduce(or_, [F.coalesce(code.isin(*incomplete), F.lit(False)) for code in codes])
    return first_match(
        [(paid > 0, approved), ((paid == 0) & listed, lacking), (paid == 0, declined)], other,
    )


def same_day(start: Column, end: Column) -> Column:
    """1 where a period has no length; an unknown bound counts as 0."""
    return F.when(start == end, 1).otherwise(0)


def eligible(empty_period: Column, kind: Column, kinds: Sequence[str]) -> Column:
    return F.when((empty_period != 1) & kind.isin(*kinds), 1).otherwise(0)


def enrolled(is_eligible: Column, enrolled_on: Column) -> Column:
    return F.when((is_eligible == 1) & enrolled_on.isNotNull(), 1).otherwise(0)


def either_address(home: Mapping[str, str], mailing: Mapping[str, str], region: str,
                   unknown: str = "Unknown") -> dict[str, Column]:
    """Home address where its region is known, else the mailing address, under one condition."""
    at_home = F.col(home[region]).isNotNull() & (F.col(home[region]) != unknown)
    chosen = {part: F.when(at_home, F.col(home[part])).otherwise(F.col(mailing[part])) for part in home}
    return {**chosen, "address_kind": F.when(at_home, F.lit("Home")).otherwise(F.lit("Mailing"))}


def listed_tag(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit("In list")).otherwise(F.lit("Not in list"))


def filled_count(cols: Sequence[str]) -> Column:
    """Number of columns that are neither null nor blank."""
    return reduce(add, [F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), 1).otherwise(0) for c in cols])


def is_true(condition: Column) -> Column:
    """Condition as a boolean; unknown is false."""
    return F.coalesce(condition, F.lit(False))


def split_system(region: Column, region_name: str, inside: str, outside: str) -> Column:
    """Code system of a region; an unknown region belongs to the outside system."""
    return F.when(region == region_name, F.lit(inside)).otherwise(F.lit(outside))


def surgical(reference_code: Column, specialty: Column, surgeon: str) -> Column:
    """True where a code is in the surgical list and a surgeon used it."""
    return reference_code.isNotNull() & F.coalesce(specialty == surgeon, F.lit(False))


def overrides(current: Column, rules: Sequence[tuple[Column, str]]) -> Column:
    """Later rules win over earlier ones."""
    for condition, value in rules:
        current = F.when(condition, F.lit(value)).otherwise(current)
    return current
