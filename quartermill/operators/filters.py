"""Row filters that add something over a plain ``DataFrame.filter``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.functions.semantics import as_column, in_set
from quartermill.operators.joins import match


def exclude_where(df: DataFrame, *conditions: Column) -> DataFrame:
    """Drop rows for which every condition holds; a NULL comparison drops the row too."""
    test = conditions[0]
    for c in conditions[1:]:
        test = test & c
    return df.filter(~test)


def latest_period(df: DataFrame, period: str) -> DataFrame:
    """Rows of the latest period, found by a scalar subquery over the same input."""
    return df.where(F.col(period) == df.agg(F.max(period)).scalar())


def latest_rows(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows at the latest ``order`` value of each group (all ties kept).

    The maximum is a partial aggregate and the rows are matched back by an
    equi-join, so a group that holds most of the rows is never one task's work.
    """
    newest = df.groupBy(*by).agg(F.max(order).alias(order))
    return match(df, newest, by + [order], how="left_semi", null_safe=True)


def inside_box(df: DataFrame, x: str, y: str, xmin: float, xmax: float, ymin: float, ymax: float) -> DataFrame:
    """Rows whose coordinates fall inside a bounding box (edges included)."""
    return df.filter(F.col(x).between(xmin, xmax) & F.col(y).between(ymin, ymax))


def current_rows(df: DataFrame, flag: Column | str, keep: list[str], mark: str | None = None) -> DataFrame:
    """Current rows of a reference table, projected, with an optional ``Yes`` marker column."""
    out = df.filter(as_column(flag)).select(*keep)
    return out.withColumn(mark, F.lit("Yes")) if mark else out


def keep_listed(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose column is in a short list fixed by the caller."""
    return df.filter(in_set(column, values))
