"""Text normalisation expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocabulary import NULL_WORDS


def folded(c: Column) -> Column:
    """Trimmed lower-case text; the tokens that mean "no value" become NULL."""
    t = F.lower(F.trim(c.cast("string")))
    return F.when(~t.isin(NULL_WORDS), t)


def first_alternative(c: Column) -> Column:
    """First part of 'a/b' or 'a|b', trimmed; NULL when that part is empty or a null word."""
    t = F.trim(F.split(c, r"[/|]", 2)[0])
    return F.when(~t.isin(NULL_WORDS), t)


def title_case(c: Column) -> Column:
    """Capitalise the first letter after every non-letter of lower-case text.

    `initcap` only starts a word after a blank, so a marker blank is placed
    after each non-letter and taken out again. All three steps generate code;
    a `transform` lambda over split pieces would not.
    """
    marked = F.regexp_replace(c, r"([^\p{L}])", "$1\u0001 ")
    return F.regexp_replace(F.initcap(marked), "\u0001 ", "")


def lookup(c: Column, table: dict[str, str]) -> Column:
    """Value of a small fixed table, NULL for a missing key."""
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.try_element_at(literal, c)


def canonical(c: Column, table: dict[str, str]) -> Column:
    """Alias table value, or the title-cased text when the table lacks it."""
    return F.coalesce(lookup(c, table), title_case(c))


def tier_of(city: Column, table: dict[str, str], default: str) -> Column:
    return F.coalesce(lookup(city, table), F.lit(default))
