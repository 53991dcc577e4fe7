"""Rounding, ratios and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CRORE = 1e7


def halfup(c: Column, digits: int = 2) -> Column:
    """Round half away from zero, as a double.

    The value passes through decimal(38,9) first, which removes floating point
    noise such as 2.6749999999 so that ties do not depend on summation order.
    """
    return F.round(c.try_cast("decimal(38,9)"), digits).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL when den is zero or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    return halfup(ratio(num, den) * 100, digits)


def money_label(c: Column) -> Column:
    """Rupee amount as crore / lakh / thousand text."""
    v, size = c.cast("double"), F.abs(c.cast("double"))
    return (
        F.when(c.isNull() | (v == 0), F.lit("₹0"))
        .when(size >= 1e7, F.concat(F.lit("₹"), F.format_number(v / 1e7, 2), F.lit(" Cr")))
        .when(size >= 1e5, F.concat(F.lit("₹"), F.format_number(v / 1e5, 2), F.lit(" L")))
        .when(size >= 1e3, F.concat(F.lit("₹"), F.format_number(v / 1e3, 1), F.lit("K")))
        .otherwise(F.concat(F.lit("₹"), F.format_number(v, 0)))
    )


def short_label(c: Column) -> Column:
    """Count as M / K text. Values of a million and more carry no thousands separator."""
    v, size = c.cast("double"), F.abs(c.cast("double"))
    plain = lambda x: F.regexp_replace(F.format_number(x, 1), ",", "")
    return (
        F.when(c.isNull() | (v == 0), F.lit("0"))
        .when(size >= 1e6, F.concat(plain(v / 1e6), F.lit("M")))
        .when(size >= 1e3, F.concat(plain(v / 1e3), F.lit("K")))
        .otherwise(F.format_number(v, 0))
    )


def fixed_label(c: Column, digits: int, suffix: str = "", missing: str = "N/A") -> Column:
    text = F.regexp_replace(F.format_number(c.cast("double"), digits), ",", "")
    return F.coalesce(F.concat(text, F.lit(suffix)), F.lit(missing))
