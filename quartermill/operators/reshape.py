"""Wide, long and semi-wide forms of the indicator fact, grids and mirror columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.functions.periods import year_label
from quartermill.operators.series import completed, pack, unpack

QUARTERS = ("qtr1", "qtr2", "qtr3", "qtr4")
MEASURES = ("targets", *QUARTERS, "cumulative")


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns to rows; NULLs stay."""
    return df.unpivot(list(ids), list(values), name, value)


def reshape_long(
    df: DataFrame, year: str = "fiscal_year", measures: Sequence[str] = MEASURES, keep_type: bool = True, drop_null: bool = True
) -> DataFrame:
    """Wide fact to one row per period: ``period``, ``period_type`` and ``value``.

    Quarters become ``FY22Q1`` results, the yearly columns become ``FY22`` with
    their own type. One generate step over the scan, no shuffle.
    """
    present = [m for m in measures if m in df.columns]
    ids = [c for c in df.columns if c not in set(present) and c != year]
    label = year_label(year)

    def period(m: str) -> Column:
        return F.concat(label, F.lit("Q" + m[3:])) if m.startswith("qtr") else label

    def kind(m: str) -> str:
        return "results" if m.startswith("qtr") else m

    entries = F.array(
        *[
            F.struct(period(m).alias("period"), F.lit(kind(m)).alias("period_type"), F.col(m).cast("double").alias("value"))
            for m in present
        ]
    )
    if drop_null:
        entries = F.filter(entries, lambda e: e["value"].isNotNull())
    out = df.select(*ids, F.inline(entries))
    return out if keep_type else out.drop("period_type")


def reshape_wide(df: DataFrame, periods: Sequence[str], keys: Sequence[str], period: str = "period", value: str = "value") -> DataFrame:
    """Long rows to one column per period (``FY22Q1`` becomes ``fy2022q1``)."""

    def column(p: str) -> str:
        return ("fy19" if p[2:4] >= "70" else "fy20") + p[2:].lower()

    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(period) == p, F.col(value))).alias(column(p)) for p in periods])


def reshape_semi_wide(df: DataFrame, year: str = "fiscal_year", measures: Sequence[str] = MEASURES) -> DataFrame:
    """One row per period with separate results, cumulative and targets columns.

    The yearly row carries cumulative and targets, each quarter's row carries
    results. Built by one generate per input row, no aggregation.
    """
    present = [m for m in measures if m in df.columns]
    ids = [c for c in df.columns if c not in set(present) and c != year]
    label = year_label(year)
    nothing = F.lit(None).cast("double")

    def row(period: Column, results: Column, cumulative: Column, targets: Column) -> Column:
        return F.struct(
            period.alias("period"), results.alias("results"), cumulative.alias("cumulative"), targets.alias("targets")
        )

    rows = [
        row(F.concat(label, F.lit("Q" + q[3:])), F.col(q).cast("double"), nothing, nothing)
        for q in present
        if q.startswith("qtr")
    ]
    yearly = [F.col(m).cast("double") if m in present else nothing for m in ("cumulative", "targets")]
    rows.append(row(label, nothing, *yearly))
    filled = F.filter(
        F.array(*rows), lambda e: e["results"].isNotNull() | e["cumulative"].isNotNull() | e["targets"].isNotNull()
    )
    return df.select(*ids, F.inline(filled))


def pivot_values(
    df: DataFrame, keys: Sequence[str], names_from: str, values: Sequence, value: str = "value", fill: float | None = None
) -> DataFrame:
    """Rows to columns for an explicit list of values, as conditional sums in one pass."""
    cols = []
    for v in values:
        name = "NA" if v is None else str(v)
        test = F.col(names_from).isNull() if v is None else F.col(names_from) == F.lit(v)
        cell = F.sum(F.when(test, F.col(value)))
        cols.append((cell if fill is None else F.coalesce(cell, F.lit(fill))).alias(name))
    return df.groupBy(*keys).agg(*cols)


def mirror_columns(df: DataFrame, names_from: str, values: Sequence[str], value: str = "value") -> DataFrame:
    """Keep each long row and add one column per indicator repeating its value (map-only)."""
    return df.select("*", *[F.when(F.col(names_from) == v, F.col(value)).alias(v) for v in values])


def complete_grid(
    df: DataFrame, period: str, tuples: Sequence[str], fill: Mapping[str, object], periods: Sequence[str] | None = None
) -> DataFrame:
    """One row for every observed tuple in every period; implicit gaps get ``fill``.

    Expects rows that are summed to one per tuple and period. Only the appended rows
    are filled; NULLs that were reported stay NULL. Without ``periods`` the list is
    that of all observed ones. A tuple is one array on the way
    (:mod:`quartermill.operators.series`), so the input is read once.
    """
    values = [c for c in df.columns if c not in (*tuples, period)]
    return unpack(completed(pack(df, tuples, period, values), fill, periods)).select(*df.columns)


def stack_bands(df: DataFrame, bands: Mapping[str, str], name: str, value: str) -> DataFrame:
    """Several age columns to rows: ``{column: label of its disaggregate system}``."""
    ids = [c for c in df.columns if c not in bands]
    entries = F.array(
        *[F.struct(F.lit(label).alias(name), F.col(c).cast("string").alias(value)) for c, label in bands.items()]
    )
    return df.select(*ids, F.inline(entries))


def cross_tab(df: DataFrame, keys: Sequence[str], columns_from: str, values: Sequence[str], value: str = "value") -> DataFrame:
    """Sense-check table: summed value by keys, one column per listed value."""
    return df.groupBy(*keys).agg(
        *[F.sum(F.when(F.col(columns_from) == v, F.coalesce(F.col(value), F.lit(0.0)))).alias(v) for v in values]
    )
