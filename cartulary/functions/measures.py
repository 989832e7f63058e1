"""Derived measures used by the loads and the indicator tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartulary.functions.documents import digits_of


def ratio(part: Column | str, whole: Column | str) -> Column:
    """`part / whole` with four decimals, null unless `whole` is positive."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.when(whole > 0, F.round(part / whole, 4))


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def per_head(total: Column, members: Column) -> Column:
    return F.round(total / F.greatest(members, F.lit(1)), 2)


def age_on(birth: Column, day: Column) -> Column:
    """Completed years."""
    return F.floor(F.months_between(day, birth) / 12).cast("int")


def age_group(age: Column) -> Column:
    return F.when(age >= 60, "60+").when(age >= 18, "18-59").when(age < 18, "0-17")


def zip_area(text: Column) -> Column:
    found = digits_of(text)
    return F.when(F.length(found) == 8, F.left(found, F.lit(5)))


def ceiling_of_band(band: Column, ceilings: Mapping[int, float]) -> Column:
    """Ceiling of a known band, null for any other."""
    known = F.lit(None).cast("double")
    for number, ceiling in sorted(ceilings.items()):
        known = F.when(band == number, F.lit(float(ceiling))).otherwise(known)
    return known


def band_of_income(income: Column, ceilings: Mapping[int, float]) -> Column:
    """Lowest band whose ceiling covers the income; the top band above them all."""
    ladder: Sequence[tuple[int, float]] = sorted(ceilings.items(), key=lambda pair: pair[1])
    band = F.lit(ladder[-1][0])
    for number, ceiling in reversed(ladder[:-1]):
        band = F.when(income <= F.lit(float(ceiling)), F.lit(number)).otherwise(band)
    return F.when(income.isNotNull(), band)
