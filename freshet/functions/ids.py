"""Identifiers, headers and dirty text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SITE_WIDTH = 8


def zero_filled(c: Column, width: int = SITE_WIDTH) -> Column:
    """Zeros on the left up to the width; longer ids stay as they are (``lpad`` would cut them)."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def without_float_tail(c: Column, everywhere: bool = False) -> Column:
    """Drops one ``.0`` at the end, or every ``.0``."""
    return F.replace(c, F.lit(".0"), F.lit("")) if everywhere else F.regexp_replace(c, r"\.0$", "")


def site(c: Column) -> Column:
    return zero_filled(without_float_tail(F.trim(c)))


def prefixed(c: Column, prefix: str) -> Column:
    """The prefix is added where it is missing."""
    return F.when(c.startswith(prefix), c).otherwise(F.concat(F.lit(prefix), c))


def number_after_dash(c: Column) -> Column:
    return F.split(c, "-", 2)[1].cast("long")


def whole_number_text(c: Column) -> Column:
    """A float-typed id as text without its fraction."""
    return c.cast("long").cast("string")


def extracted(c: Column, pattern: str, group: int = 1) -> Column:
    """A regular expression's group; null without a match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip().lower().replace(" ", "_").replace("-", "_") for c in df.columns))


def resolved(df: DataFrame, candidates: Iterable[str]) -> str:
    """The first of the candidate names that is a column, whatever its case."""
    own = {c.lower(): c for c in df.columns}
    for c in candidates:
        if c.lower() in own:
            return own[c.lower()]
    raise KeyError(f"none of {list(candidates)} in {df.columns}")


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def number_or_null(c: Column) -> Column:
    return F.expr(f"try_cast(nullif(trim({_name(c)}), '') AS double)") if isinstance(c, str) else F.nullif(F.trim(c), F.lit("")).try_cast("double")


def time_or_null(c: Column, *formats: str) -> Column:
    """The first format that fits, else null."""
    tries = [F.try_to_timestamp(c, F.lit(f)) for f in formats] or [F.try_to_timestamp(c)]
    return F.coalesce(*tries)


def _name(c: str) -> str:
    return f"`{c}`"


def valid_place(lon: Column, lat: Column) -> Column:
    """Whether both coordinates are present and within their ranges."""
    return F.coalesce(lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0), F.lit(False))


def gauge_tag(c: Column) -> Column:
    return F.concat(F.lit("gage-"), c)
