"""Dirty text -> typed value. Unparseable input always becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as vocab
from .numbers import halfup
from .text import folded
from .vocabulary import FALSE_WORDS, FIRST_DATE, LAST_DATE, TRUE_WORDS


def date_of(c: Column, first: str = FIRST_DATE, last: str = LAST_DATE) -> Column:
    """yyyy-M-d, d/M/yyyy or d-M-yy (20yy) to a date from first to last; others are typing errors.

    The two day-first shapes are rewritten to ISO and one cast parses all
    three, so a row is parsed once and no failed attempt raises internally.
    """
    t = F.trim(c)
    iso = F.regexp_replace(t, vocab.DAY_FIRST_SLASH, "$3-$2-$1")
    iso = F.regexp_replace(iso, vocab.DAY_FIRST_DASH, "20$3-$2-$1")
    # Most rows are ISO as they are.
    iso = F.when(t.rlike(vocab.ISO_DATE), t).otherwise(F.when(iso.rlike(vocab.ISO_DATE), iso))
    day = iso.try_cast("date")
    return F.when(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")), day)


def price_of(c: Column) -> Column:
    """Rupee text to double. Any ASCII letter voids the value ('Rs. 500' too)."""
    digits = F.trim(F.regexp_replace(F.trim(c), vocab.PRICE_MARKS, ""))
    return F.when(~c.rlike(vocab.LETTERS), digits.try_cast("double"))


def rating_of(c: Column) -> Column:
    """'4.5', '4 stars' or a fraction 'a/b' scaled to five; outside [1, 5] is NULL."""
    t = folded(c)
    num = F.regexp_extract(t, vocab.FRACTION, 1).try_cast("double")
    den = F.regexp_extract(t, vocab.FRACTION, 2).try_cast("double")
    scaled = F.when(den == 5, num).when(den == 10, num / 2).otherwise(F.try_divide(num, den) * 5)
    leading = F.regexp_extract(t, vocab.LEADING_NUMBER, 1).try_cast("double")
    return within(F.when(t.rlike(vocab.FRACTION), halfup(scaled, 2)).otherwise(leading), 1, 5)


def delivery_days_of(c: Column) -> Column:
    """'Same Day' -> 0, 'a-b' -> midpoint, leading number otherwise; outside [0, 30] is NULL."""
    t = folded(c)
    lo = F.regexp_extract(t, vocab.DAY_SPAN, 1).try_cast("double")
    hi = F.regexp_extract(t, vocab.DAY_SPAN, 2).try_cast("double")
    number = F.regexp_extract(t, vocab.SIGNED_NUMBER, 1).try_cast("double")
    days = (
        F.when(t.contains("same day"), F.lit(0.0))
        .when(t.rlike(vocab.DAY_SPAN), (lo + hi) / 2)
        .otherwise(number)
    )
    return within(days, 0, 30)


def flag_of(c: Column) -> Column:
    """Yes/no spellings to a three-valued boolean."""
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin(TRUE_WORDS), F.lit(True)).when(t.isin(FALSE_WORDS), F.lit(False))


def within(c: Column, lo: float, hi: float) -> Column:
    return F.when(c.between(lo, hi), c)


def stored_flag_of(c: Column) -> Column:
    """Warehouse flag: only the plain spellings true/yes/1 and false/no/0 count."""
    t = F.lower(c.cast("string"))
    return F.when(t.isin("true", "yes", "1"), F.lit(True)).when(
        t.isin("false", "no", "0"), F.lit(False)
    )
