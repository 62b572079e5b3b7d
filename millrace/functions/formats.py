"""Figures, identifiers and paths as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def thousands(n: Column) -> Column:
    """A whole number with commas."""
    return F.format_number(n, 0)


def fixed(value: Column, decimals: int) -> Column:
    """A number with a fixed number of decimals (up to 3), as printf gives it; ``nan``, ``inf`` and ``-inf`` stay words."""
    value = value.cast("double")
    endless = F.isnan(value) | (F.abs(value) == float("inf"))
    size = _fixed_size(F.when(endless, 0.0).otherwise(F.abs(value)), decimals)
    return (F.when(F.isnan(value), "nan").when(endless, F.when(value > 0, "inf").otherwise("-inf"))
            .otherwise(F.concat(F.when(value < 0, "-").otherwise(""), size)))


def _fixed_size(value: Column, decimals: int) -> Column:
    """The same of a non-negative number below 9e15.

    The double is rounded by its exact binary value, ties to even. Its fraction times 2^62 is a
    whole number, so the rounding is done on integers.
    """
    unit = 10 ** decimals
    scaled = (F.lit(unit) * ((value - F.floor(value)) * F.lit(2.0 ** 62)).cast("bigint").cast("decimal(20,0)")).cast("decimal(38,0)")
    one = F.lit(2 ** 62).cast("decimal(20,0)")
    below = F.floor(scaled / one).cast("bigint")
    twice = (scaled - below.cast("decimal(15,0)") * one) * 2
    lower = F.floor(value) * unit + below
    up = (twice > one) | ((twice == one) & (lower % 2 != 0))
    units = lower + up.cast("bigint")
    whole = F.floor(units / unit).cast("string")
    return whole if decimals == 0 else F.concat(whole, F.lit("."), F.lpad((units % unit).cast("string"), decimals, "0"))


def percent(share: Column, decimals: int = 1, sign: bool = False) -> Column:
    """A share as per cent; a negative share keeps its minus, even at 0.0."""
    mark = F.when(share < 0, "-").otherwise("+" if sign else "")
    return F.concat(mark, fixed(F.abs(share * 100), decimals), F.lit("%"))


def signed_percent(difference: Column, decimals: int = 1) -> Column:
    return percent(difference, decimals, sign=True)


def student_id(raw: Column) -> tuple[Column, Column]:
    """(verdict, two-digit id or null) for a job parameter given as text."""
    is_int = raw.rlike("^[+-]?[0-9]+$")
    number = raw.try_cast("bigint")
    in_range = is_int & number.between(0, 99)
    verdict = (
        F.when(raw.isNull(), "no student_id supplied")
        .when(~is_int, "not an integer")
        .when(in_range, "ok")
        .otherwise("out of range (0-99)")
    )
    return verdict, F.when(in_range, F.lpad(number.cast("string"), 2, "0"))


def run_paths(sid: Column) -> tuple[Column, Column]:
    """(output folder, application name) of a run; all follow from the padded id."""
    return F.format_string("curated/student-%s/watch_events", sid), F.format_string("curate-events-student-%s", sid)
