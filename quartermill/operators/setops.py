"""Appends and differences."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.operators.joins import not_matched


def strict_append(*frames: DataFrame) -> DataFrame:
    """Append frames that must have the same set of columns."""
    want = set(frames[0].columns)
    for f in frames[1:]:
        if set(f.columns) != want:
            raise ValueError(f"columns differ: {sorted(want ^ set(f.columns))}")
    return reduce(lambda a, b: a.unionByName(b), frames)


def loose_append(*frames: DataFrame) -> DataFrame:
    """Append frames; columns one of them lacks are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def join_vintages(
    frozen: DataFrame, current: DataFrame, closed: Iterable[int], open_years: Iterable[int], year: str = "fiscal_year"
) -> DataFrame:
    """Closed years from the frozen extract, open years from the current one; the sets must not overlap."""
    closed, open_years = sorted(set(closed)), sorted(set(open_years))
    both = set(closed) & set(open_years)
    if both:
        raise ValueError(f"years taken from both extracts: {sorted(both)}")
    return strict_append(
        current.filter(F.col(year).isin(open_years)), frozen.filter(F.col(year).isin(closed))
    )


def rows_only_in(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` does not have, columns aligned by name."""
    # Distinct first: partial sums shrink hot rows before anything meets on them.
    return a.distinct().subtract(b.select(*a.columns).distinct())


def keys_only_in(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key values of ``a`` that ``b`` does not have (NULL equals NULL)."""
    return not_matched(a.select(*keys).distinct(), b, keys)
