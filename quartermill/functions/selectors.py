"""Schema-driven column selection, resolved on the driver from ``df.schema``."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strings(df: DataFrame) -> list[str]:
    """Names of the string columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numbers(df: DataFrame) -> list[str]:
    """Names of the numeric columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def starting(df: DataFrame, prefix: str) -> list[str]:
    """Columns whose name starts with ``prefix``."""
    return [c for c in df.columns if c.startswith(prefix)]


def containing(df: DataFrame, text: str) -> list[str]:
    """Columns whose name contains ``text``, ignoring case."""
    return [c for c in df.columns if text.lower() in c.lower()]


def span(df: DataFrame, first: str, last: str) -> list[str]:
    """Columns from ``first`` to ``last`` in schema order."""
    i, j = df.columns.index(first), df.columns.index(last)
    return df.columns[i : j + 1] if i <= j else df.columns[j : i + 1][::-1]


def without(df: DataFrame, drop: list[str]) -> list[str]:
    """All columns but those in ``drop``."""
    return [c for c in df.columns if c not in set(drop)]


def leading(df: DataFrame, first: list[str]) -> DataFrame:
    """Move ``first`` to the front, keep the rest in order."""
    return df.select(*[F.col(f"`{c}`") for c in first + without(df, first)])


def relocate(df: DataFrame, column: str, *, before: str | None = None, after: str | None = None) -> DataFrame:
    """Move one column next to another."""
    rest = without(df, [column])
    anchor = before if before is not None else after
    at = rest.index(anchor) + (0 if before is not None else 1)
    return df.select(*[F.col(f"`{c}`") for c in rest[:at] + [column] + rest[at:]])


def rename_with(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """Apply ``fn`` to every column name."""
    return df.toDF(*[fn(c) for c in df.columns])


def snake_case(name: str) -> str:
    """``Agency lookback`` or ``aGencyLookback`` to ``agency_lookback``."""
    name = name.replace("%", "_percent_").replace("#", "_number_").replace("'", "")
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    name = re.sub(r"[^0-9A-Za-z]+", "_", name).strip("_").lower()
    return f"x{name}" if not name or name[0].isdigit() else name


def clean_names(df: DataFrame) -> DataFrame:
    """Snake-case every name; repeats get ``_2``, ``_3``…"""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        n = snake_case(c)
        seen[n] = seen.get(n, 0) + 1
        names.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return df.toDF(*names)
