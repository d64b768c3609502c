"""Combinators for ordered business rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def first_match(branches: list[tuple[Column, object]], default=None) -> Column:
    """Value of the first true condition."""
    (cond, value), *rest = branches
    chain = F.when(cond, as_column(value))
    for cond, value in rest:
        chain = chain.when(cond, as_column(value))
    return chain.otherwise(as_column(default))


def last_match(branches: list[tuple[Column, object]], base=None) -> Column:
    """Value of the last true condition, as when each one overwrites the result."""
    return first_match(list(reversed(branches)), base)


def holds(cond: Column) -> Column:
    """Comparison with an unknown counts as false."""
    return F.coalesce(cond, F.lit(False))


def differs(a: Column, b) -> Column:
    """Not equal, where an unknown differs from everything."""
    return F.coalesce(a != as_column(b), F.lit(True))


def monitored(flag: Column) -> Column:
    """Only an explicit ``Não`` switches monitoring off."""
    return differs(flag, "Não")


def any_of(*flags: Column) -> Column:
    return reduce(lambda a, b: a | b, [holds(f) for f in flags])


def latest_of(*dates: Column) -> Column:
    """Latest of several dates, unknown ones skipped."""
    return F.greatest(*dates)
