"""Text expressions: codes, unit lists, escaped text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Escape codes found in exported texts and what they stand for.
ESCAPES = {
    "_x0020_": " ",
    "_x002F_": "/",
    "_x0028_": "(",
    "_x0029_": ")",
    "_x003D_": "=",
    "_x002C_": ",",
}


def class_code(col: Column) -> Column:
    """Plant class: the two characters after the first four."""
    return F.substring(col, 5, 2)


def drop_suffix(col: Column, n: int) -> Column:
    return F.substring(col, F.lit(1), F.greatest(F.length(col) - n, F.lit(0)))


def decode_escapes(col: Column) -> Column:
    for code, char in ESCAPES.items():
        col = F.replace(col, F.lit(code), F.lit(char))
    return col


def listed(pairs: list[tuple[Column, str]], separator: str = ", ") -> Column:
    """Labels of the true conditions joined in order; empty text when none holds."""
    return F.concat_ws(separator, *[F.when(cond, F.lit(label)) for cond, label in pairs])


def has_split_digits(col: Column) -> Column:
    """Two numbers parted only by blanks, which a unit list must not contain."""
    return col.rlike(r"\d\s+\d")


def _unit_runs(col: Column) -> Column:
    """Numbers of a unit list, one inner array per run between range marks."""
    marks = F.regexp_replace(F.translate(col, "e- ", ",a"), ",+", ",")
    return F.transform(
        F.split(marks, "a"), lambda run: F.transform(F.split(run, ","), lambda n: n.try_cast("int"))
    )


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed a single time."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pairs(runs: Column, combine) -> Column:
    rest = F.size(runs) - 1
    return F.zip_with(F.slice(runs, F.lit(1), rest), F.slice(runs, F.lit(2), rest), combine)


def _readable(runs: Column) -> Column:
    return F.forall(F.flatten(runs), lambda n: n.isNotNull())


def unit_list(col: Column) -> Column:
    """``'01 a 04 e 06'`` to the sorted numbers ``[1, 2, 3, 4, 6]``; NULL if unreadable."""

    def between(left: Column, right: Column) -> Column:
        low, high = F.element_at(left, -1) + 1, F.element_at(right, 1) - 1
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    def expand(runs: Column) -> Column:
        filled = F.flatten(_pairs(runs, between))
        return F.when(_readable(runs), F.array_sort(F.concat(F.flatten(runs), filled)))

    return _once(_unit_runs(col), expand)


def unit_count(col: Column) -> Column:
    """Length of ``unit_list`` without building the list."""

    def gap(left: Column, right: Column) -> Column:
        return F.greatest(F.element_at(right, 1) - F.element_at(left, -1) - 1, F.lit(0))

    def count(runs: Column) -> Column:
        extra = F.aggregate(_pairs(runs, gap), F.lit(0), lambda total, n: total + n)
        return F.when(_readable(runs), F.size(F.flatten(runs)) + extra)

    return _once(_unit_runs(col), count)


def percent_text(col: Column) -> Column:
    return F.format_string("%.1f %%", col)


def stamp_text(col: Column) -> Column:
    return F.date_format(col, "dd/MM/yyyy, HH:mm:ss")
