"""Grouped sums, counts and roll-ups; all are partial aggregates, so hot groups combine map-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.functions.selectors import strings
from quartermill.functions.semantics import as_column, na_sum
from quartermill.operators.joins import matched, not_matched


def sum_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum each measure per group; an all-NULL group sums to 0."""
    return df.groupBy(*keys).agg(*[na_sum(m).alias(m) for m in measures])


def side_by_side(df: DataFrame, keys: Sequence[str], value: str, parts: Mapping[str, str | None]) -> DataFrame:
    """Sums of several subsets of one table next to each other, in one pass.

    ``parts`` maps an output to the SQL condition of its rows (None: all). A subset
    without rows in a group is NULL there, one whose values are all NULL is 0.
    """
    sums = []
    for name, condition in parts.items():
        rows = F.lit(True) if condition is None else F.coalesce(F.expr(condition), F.lit(False))
        sums.append(F.sum(F.when(rows, F.coalesce(F.col(value), F.lit(0.0)))).alias(name))
    return df.groupBy(*keys).agg(*sums)


def sum_by_strings(df: DataFrame, measures: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Group by every string column and sum the measures; other numerics go away."""
    return sum_by(df, [c for c in strings(df) if c not in set(drop)], measures)


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Exact number of distinct values per group; NULL counts as a value.

    The distinct pairs are built first with a shuffle on (keys, value), so one
    group with most of the values is still spread over many tasks.
    """
    return df.select(*keys, column).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def keys_with_more_than(df: DataFrame, keys: Sequence[str], limit: int, name: str = "n") -> DataFrame:
    """Keys that occur on more than ``limit`` rows."""
    return count_by(df, keys, name).filter(F.col(name) > limit)


def collapse_bands(
    df: DataFrame, band: str, into: Mapping[str, str], measures: Sequence[str], when: Column | None = None
) -> DataFrame:
    """Fold fine bands into coarse ones and re-sum in a single aggregation.

    Rows outside the mapping (and rows without a band) keep their band and go
    through the same grouping; nothing is split off and appended again.
    """
    keys = [c for c in df.columns if c not in set(measures)]
    folded = F.col(band)
    for target in dict.fromkeys(into.values()):
        sources = [b for b, t in into.items() if t == target]
        test = F.col(band).isin(sources)
        folded = F.when(test if when is None else (test & when), F.lit(target)).otherwise(folded)
    return sum_by(df.withColumn(band, folded), keys, measures)


def row_total(columns: Sequence[Column | str], skip_null: bool = True) -> Column:
    """Sum across columns of one row; with ``skip_null=False`` one NULL makes it NULL."""
    cols = [as_column(c) for c in columns]
    return reduce(add, [F.coalesce(c, F.lit(0.0)) for c in cols] if skip_null else cols)


def roster(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of the given columns."""
    return df.select(*columns).distinct()


def resum_repeats(df: DataFrame, selected: DataFrame, on: Sequence[str], keys: Sequence[str], value: str) -> DataFrame:
    """Drop exact copies and re-sum per key, but only for the selected key values.

    ``selected`` lists the ``on`` values to clean; all other rows pass through
    untouched. Columns outside ``keys`` and ``value`` are NULL on re-summed rows.
    """
    cleaned = sum_by(matched(df, selected, on).distinct(), keys, [value])
    return not_matched(df, selected, on).unionByName(cleaned, allowMissingColumns=True)
