"""String cleaning, keys and code handling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = " \t\n\r\f\x0b\x85\xa0"
#: Maps of so few entries become plain comparisons.
FEW = 3
PLACEHOLDERS = ("N/A", "NULL", "NAN", "NONE", "")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def strip(c: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.btrim(c, F.lit(WHITESPACE))


def trim_strings(df: DataFrame) -> DataFrame:
    return df.withColumns({c: strip(F.col(c)) for c in string_columns(df)})


def value_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def mapped(c: Column, mapping: Mapping, on_missing: str = "keep") -> Column:
    """Look a value up in a literal map; a missing value is kept, or null with on_missing='null'."""
    if not mapping:
        return c if on_missing == "keep" else F.lit(None).cast("string")
    known = [k for k in mapping if k is not None]
    if len(known) <= FEW:
        found = F
        for k in known:
            found = found.when(c == F.lit(k), F.lit(mapping[k]))
        return c if found is F else found.otherwise(c if on_missing == "keep" else F.lit(None))
    hit = F.try_element_at(value_map({k: mapping[k] for k in known}), c)
    if on_missing == "null":
        return hit
    return F.when(c.isin(known), hit).otherwise(c)


def map_values(
    df: DataFrame, cols: Sequence[str], mapping: Mapping, default: str | None = "Unknown"
) -> DataFrame:
    """Map values; null and blank (also when mapped to null) become the default."""
    out = {}
    for name in cols:
        value = mapped(F.col(name), mapping)
        if default is not None:
            value = F.coalesce(F.when(F.trim(value) != "", value), F.lit(default))
        out[name] = value
    return df.withColumns(out)


def map_known(c: Column, mapping: Mapping, default: str) -> Column:
    """Map values; whatever the map does not know becomes the default."""
    return F.coalesce(mapped(c, mapping, on_missing="null"), F.lit(default))


def zero_pad(c: Column, width: int) -> Column:
    """Pad on the left with zeros, after a sign if there is one; longer text is left whole."""
    signed = c.rlike("^[+-]")
    return (
        F.when(F.length(c) >= width, c)
        .when(signed, F.concat(F.substring(c, 1, 1), F.lpad(c.substr(F.lit(2), F.length(c)), width - 1, "0")))
        .otherwise(F.lpad(c, width, "0"))
    )


def zero_pad_filled(c: Column, width: int) -> Column:
    """Pad only where there is text: blanks stay blank."""
    return F.when(F.trim(c) == "", c).otherwise(zero_pad(c, width))


def insert_at(c: Column, mark: str, positions: Sequence[int]) -> Column:
    """Insert a mark at zero-based positions of the text; positions past its end append it."""
    cuts = sorted(set(positions))
    pieces = [c.substr(F.lit(1), F.lit(cuts[0]))]
    for start, stop in zip(cuts, [*cuts[1:], None]):
        size = F.length(c) if stop is None else F.lit(stop - start)
        pieces += [F.lit(mark), c.substr(F.lit(start + 1), size)]
    return F.concat(*pieces)


def leading(c: Column, n: int = 3) -> Column:
    return F.substring(c, 1, n)


def region_from_code(c: Column, mapping: Mapping) -> Column:
    """Region of a postal code: the three-character entry wins over the one-character entry."""
    regions = value_map(mapping)
    return F.coalesce(F.try_element_at(regions, leading(c, 3)), F.try_element_at(regions, leading(c, 1)))


def area_type(c: Column, null_as_urban: bool = False) -> Column:
    """Rural where the second character is '0'."""
    kind = F.when(F.substring(c, 2, 1) == "0", F.lit("Rural"))
    return kind.otherwise(F.lit("Urban")) if null_as_urban else kind.when(c.isNotNull(), F.lit("Urban"))


def drop_decimal_suffix(c: Column) -> Column:
    return F.regexp_replace(c, r"\.0$", "")


def digits_to_double(c: Column) -> Column:
    """Number made of the digits and decimal points of a text; signs are dropped."""
    return F.regexp_replace(c, r"[^0-9.]", "").try_cast("double")


def to_number(c: Column, dtype: str = "double") -> Column:
    """Number in a text with thousands separators; anything else is null."""
    return F.regexp_replace(c, ",", "").try_cast(dtype)


def to_int_or_zero(c: Column) -> Column:
    return F.coalesce(c.try_cast("double").try_cast("long"), F.lit(0).cast("long"))


def tidy_pair(c: Column, pattern: str) -> Column:
    """Put exactly one blank between the two groups of a pattern."""
    return F.regexp_replace(c, pattern, "$1 $2")


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, null where there is none."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def key_of(cols: Sequence[str | Column], sep: str = "-", blank_as_null: bool = False) -> Column:
    """Join key parts and skip nulls."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    if blank_as_null:
        parts = [F.nullif(c, F.lit("")) for c in parts]
    return F.concat_ws(sep, *parts)


def filled_names(cols: Sequence[str], sep: str = "|") -> Column:
    """Names of the columns that hold a value."""
    return F.concat_ws(sep, *[F.when(F.col(c).isNotNull(), F.lit(c)) for c in cols])


def overwrite_where_present(target: Column, source: Column) -> Column:
    return F.coalesce(source, target)


def blank_to_null(c: Column, placeholders: Sequence[str] = PLACEHOLDERS) -> Column:
    return F.when(F.upper(F.trim(c)).isin(*placeholders), F.lit(None)).otherwise(c)


def clean_placeholders(df: DataFrame, placeholders: Sequence[str] = PLACEHOLDERS) -> DataFrame:
    return df.withColumns({c: blank_to_null(F.col(c), placeholders) for c in string_columns(df)})


def code_key(code: Column, system: Column, specialty: Column, surgical: Column,
             own_specialties: Sequence[str], split_system: str) -> Column:
    """Key that joins a code to its reference row.

    Some specialties have code lists of their own; within the split system, and for surgical
    codes, the specialty is part of the key; elsewhere the system alone is.
    """
    return (
        F.when(code.isNull(), F.lit(None).cast("string"))
        .when(specialty.isin(*own_specialties), F.concat(code, F.lit("-"), specialty))
        .when((system == split_system) | F.coalesce(surgical, F.lit(False)),
              F.concat(code, F.lit("-"), system, F.lit("-"), specialty))
        .otherwise(F.concat(code, F.lit("-"), system))
    )


def notes_after(c: Column, code_pattern: str) -> Column:
    """Free text that follows a run of codes."""
    return F.nullif(strip(F.regexp_extract(c, f"(?:{code_pattern}\\s*)+(.*)", 1)), F.lit(""))


# Letters allowed in the first and in the later letter places of a postal code.
POSTAL_FIRST = "ABCEGHJKLMNPRSTVXY"
POSTAL_LATER = "ABCEGHJKLMNPRSTVWXYZ"
POSTAL_PATTERN = f"^[{POSTAL_FIRST}][0-9][{POSTAL_LATER}] [0-9][{POSTAL_LATER}][0-9]$"


def postal_ok(c: Column) -> Column:
    return F.coalesce(c.rlike(POSTAL_PATTERN), F.lit(False))


def row_hash(cols: Sequence[str], algorithm: str = "md5") -> Column:
    """Hash of a row in which null, blank and shifted values all differ."""
    encoded = F.concat_ws(
        "\x1f", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("0")) for c in cols]
    )
    return F.md5(encoded) if algorithm == "md5" else F.sha2(encoded, 256)
