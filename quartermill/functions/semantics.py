"""Missing-value and coercion rules of the reporting scripts, as Column builders.

The scripts this package replaces treat a missing value differently from SQL
NULL in several places (a NOT IN keeps missing values, an all-missing sum is 0,
a pasted missing value prints "NA", a bad number becomes missing instead of an
error). Each helper below is one of those rules; all of them are plain Catalyst
expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    """A column name or a Column, as a Column."""
    return F.col(c) if isinstance(c, str) else c


def in_set(c: Column | str, values: Iterable) -> Column:
    """Membership that is never NULL; a ``None`` among ``values`` matches NULL.

    Written with null tests instead of a coalesce, so a scan can use it.
    """
    values = list(values)
    c = as_column(c)
    known = [v for v in values if v is not None]
    if len(known) < len(values):
        return (c.isNull() | c.isin(known)) if known else c.isNull()
    return (c.isNotNull() & c.isin(known)) if known else F.lit(False)


def not_in(c: Column | str, values: Iterable) -> Column:
    """NOT IN that keeps NULL rows (unless ``None`` is listed)."""
    values = list(values)
    c = as_column(c)
    known = [v for v in values if v is not None]
    if len(known) < len(values):
        return (c.isNotNull() & ~c.isin(known)) if known else c.isNotNull()
    return (c.isNull() | ~c.isin(known)) if known else F.lit(True)


def code_in(c: Column | str, codes: Iterable) -> Column:
    """Membership of a code column in numbers or strings, compared as text."""
    return in_set(as_column(c).cast("string"), [None if v is None else str(v) for v in codes])


def if_else(condition: Column, yes, no) -> Column:
    """Three-way conditional: a NULL condition gives NULL, not the else branch."""
    return F.when(condition.isNull(), F.lit(None)).when(condition, yes).otherwise(no)


def na_sum(c: Column | str) -> Column:
    """Sum that skips NULL and is 0 for an all-NULL group."""
    return F.coalesce(F.sum(as_column(c)), F.lit(0.0))


def unite(*cols: Column | str, sep: str = "_") -> Column:
    """Paste columns together; a NULL prints as ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(as_column(c).cast("string"), F.lit("NA")) for c in cols])


def extract(c: Column | str, pattern: str, group: int = 0) -> Column:
    """First match of ``pattern`` (or of one of its groups); NULL when there is none."""
    return F.nullif(F.regexp_extract(as_column(c), java_pattern(pattern), group), F.lit(""))


def java_pattern(pattern: str) -> str:
    """Rewrite bare POSIX classes, which Java would read as a set of letters."""
    return pattern.replace("[:space:]", r"\s").replace("[:digit:]", r"\d")


def to_number(c: Column | str) -> Column:
    """Text to double; NULL when it is not a number."""
    return as_column(c).try_cast("double")


def ratio(num: Column | str, den: Column | str) -> Column:
    """Division that gives NULL for a zero denominator."""
    return F.try_divide(as_column(num), as_column(den))


def ratio_exceeds(num: Column | str, den: Column | str, limit: float) -> Column:
    """``num / den > limit`` where a positive value over zero counts as exceeding."""
    num, den = as_column(num), as_column(den)
    return F.when(den == 0, F.when(num > 0, F.lit(True))).otherwise(ratio(num, den) > limit)


def round_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even."""
    return F.bround(as_column(c), digits)


def strip_decimal_code(c: Column | str) -> Column:
    """Undo a numeric read of a code column: ``"12340.0"`` becomes ``"12340"``."""
    return F.regexp_replace(as_column(c), r"\.0$", "")
