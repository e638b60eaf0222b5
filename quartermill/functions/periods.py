"""Fiscal calendar: labels, conversions and range predicates that reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quartermill.functions.semantics import as_column, extract

#: First month of the fiscal year (October).
FISCAL_START = 10


def _shifted(c: Column | str, start_month: int) -> Column:
    return F.add_months(as_column(c).cast("date"), (13 - start_month) % 12)


def fiscal_year(c: Column | str, start_month: int = FISCAL_START) -> Column:
    """Fiscal year of a date (the year in which it ends)."""
    return F.year(_shifted(c, start_month))


def fiscal_quarter(c: Column | str, start_month: int = FISCAL_START) -> Column:
    """Fiscal quarter 1..4 of a date."""
    return F.quarter(_shifted(c, start_month))


def year_label(c: Column | str) -> Column:
    """``FY23`` from a four-digit year (number or text)."""
    return F.concat(F.lit("FY"), F.substring(as_column(c).cast("string"), 3, 2))


def quarter_label(c: Column | str, start_month: int = FISCAL_START) -> Column:
    """``FY23Q1`` from a date."""
    return F.concat(
        year_label(fiscal_year(c, start_month)), F.lit("Q"), fiscal_quarter(c, start_month).cast("string")
    )


def in_fiscal_years(c: Column | str, years: Iterable[int], start_month: int = FISCAL_START) -> Column:
    """Fiscal-year filter written as plain date ranges, so a parquet scan can use it."""
    c = as_column(c)
    test = None
    for first, last in _runs(sorted(set(years))):
        low = dt.date(first if start_month == 1 else first - 1, start_month, 1)
        high = dt.date(last + 1 if start_month == 1 else last, start_month, 1)
        inside = (c >= F.lit(low)) & (c < F.lit(high))
        test = inside if test is None else (test | inside)
    return F.lit(False) if test is None else test


def _runs(years: list[int]) -> list[tuple[int, int]]:
    """Consecutive years as (first, last) runs."""
    runs: list[tuple[int, int]] = []
    for y in years:
        if runs and runs[-1][1] == y - 1:
            runs[-1] = (runs[-1][0], y)
        else:
            runs.append((y, y))
    return runs


def serial_date(c: Column | str) -> Column:
    """Spreadsheet serial number to date."""
    return F.date_add(F.lit("1899-12-30").cast("date"), as_column(c).try_cast("double").cast("int"))


def month_year(c: Column | str) -> Column:
    """First day of a ``MM-yyyy`` month; NULL when it does not parse."""
    return F.try_to_timestamp(as_column(c), F.lit("MM-yyyy")).cast("date")


def calendar_quarter_to_year(c: Column | str) -> Column:
    """``CY2023Q3`` to the fiscal year it falls in (``FY23``)."""
    c = as_column(c)
    year = extract(c, r"^CY(\d{4})Q[1-4]$", 1).cast("int")
    quarter = extract(c, r"^CY\d{4}Q([1-4])$", 1).cast("int")
    return year_label(year + F.when(quarter == 4, 1).otherwise(0))


def fiscal_to_calendar_quarter(c: Column | str, pivot: int = 70) -> Column:
    """``FY22Q4`` to the calendar quarter it covers (``2022Q3``); two-digit years from ``pivot`` on are 19xx."""
    c = as_column(c)
    short = extract(c, r"^FY(\d{2})Q[1-4]$", 1).cast("int")
    year = short + F.when(short >= pivot, F.lit(1900)).otherwise(F.lit(2000))
    quarter = extract(c, r"^FY\d{2}Q([1-4])$", 1).cast("int")
    return F.when(quarter == 1, F.concat((year - 1).cast("string"), F.lit("Q4"))).otherwise(
        F.concat(year.cast("string"), F.lit("Q"), (quarter - 1).cast("string"))
    )


def iso_period_label(period_type: Column | str, iso: Column | str) -> Column:
    """Label of an ISO period by its type (daily, weekly, monthly, longer)."""
    kind, iso = as_column(period_type), as_column(iso)
    year, rest = F.substring(iso, 3, 2), F.substring(iso, F.lit(5), F.length(iso))
    return (
        F.when(
            kind == "Daily",
            F.concat(F.lit("FY"), year, F.lit("M"), F.substring(iso, 5, 2), F.lit("D"), F.substring(iso, 7, 2)),
        )
        .when(kind.contains("Weekly"), F.concat(F.lit("FY"), year, rest))
        .when(kind == "Monthly", F.concat(F.lit("FY"), year, F.lit("M"), rest))
        .otherwise(F.concat(F.lit("FY"), year, rest))
    )


def drop_century(c: Column | str) -> Column:
    """``FY2017Q2`` to ``FY17Q2``."""
    return F.regexp_replace(as_column(c), r"^FY\d\d(?=\d\d)", "FY")


def heading_months(headings: Iterable[str]) -> dict[str, str]:
    """Serial-number column headings mapped to ``MM-yyyy`` names; others are left out."""
    origin = dt.date(1899, 12, 30)
    out = {}
    for h in headings:
        if h.replace(".", "", 1).isdigit():
            out[h] = (origin + dt.timedelta(days=int(float(h)))).strftime("%m-%Y")
    return out
