"""Series and group operators.

True windows are used only where a group is bounded by the number of reporting
periods (one row per series and period). Everything that would gather a whole
group in one task (shares, repeat counts, carried codes) is a partial aggregate
joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermill.functions.semantics import as_column, na_sum, ratio
from quartermill.operators.joins import match


def lag_periods(df: DataFrame, value: str, series: Sequence[str], period: str, steps: Sequence[int] = (1, 2)) -> DataFrame:
    """Add ``<value>_lag<k>``: the value ``k`` periods earlier in the same series.

    Expects one row per series and period (the output of ``complete_grid``), so
    a window group is never longer than the list of periods.
    """
    w = Window.partitionBy(*series).orderBy(period)
    return df.withColumns({f"{value}_lag{k}": F.lag(value, k).over(w) for k in steps})


def fill_within(
    df: DataFrame, columns: Sequence[str], group: Sequence[str], order: Sequence[str], direction: str = "downup"
) -> DataFrame:
    """Fill NULLs from the nearest earlier position of the group, then the nearest later one.

    ``order`` is the reporting period (or another short list of positions). The
    rows are first reduced to one row per group and position, the fill runs on
    those, and the result is joined back; a group that holds a large share of
    the rows is therefore never sorted in one task. At one position the
    smallest non-NULL value speaks for its rows.
    """
    if direction not in ("down", "up", "downup"):
        raise ValueError(f"unknown direction {direction!r}")
    # Distinct first: it hashes, and leaves little for the sorting minimum of strings.
    known = df.select(*group, *order, *columns).distinct()
    positions = known.groupBy(*group, *order).agg(*[F.min(c).alias(f"__fill_{c}") for c in columns])
    ordering = [F.col(c).asc_nulls_last() for c in order]
    before = Window.partitionBy(*group).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(*group).orderBy(*ordering).rowsBetween(Window.currentRow, Window.unboundedFollowing)

    def carried(c: str) -> Column:
        own = F.col(f"__fill_{c}")
        steps = {
            "down": [F.last(own, ignorenulls=True).over(before)],
            "up": [F.first(own, ignorenulls=True).over(after)],
            "downup": [F.last(own, ignorenulls=True).over(before), F.first(own, ignorenulls=True).over(after)],
        }
        return F.coalesce(*steps[direction])

    filled = positions.select(*group, *order, *[carried(c).alias(f"__fill_{c}") for c in columns])
    out = match(df, filled, list(group) + list(order), "left", null_safe=True)
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"__fill_{c}")) for c in columns}).drop(
        *[f"__fill_{c}" for c in columns]
    )


def share_of_total(df: DataFrame, value: str, within: Sequence[str], name: str = "share") -> DataFrame:
    """Each row's value as a share of its group's total; NULL when the total is 0."""
    totals = df.groupBy(*within).agg(na_sum(value).alias("__total"))
    out = match(df, totals, within, "left", null_safe=True)
    return out.withColumn(name, ratio(value, "__total")).drop("__total")


def find_repeats(df: DataFrame, columns: Sequence[str] | None = None, name: str = "dupe_count") -> DataFrame:
    """All rows whose ``columns`` (default: all) occur more than once, with the count.

    For all columns the copies are identical, so they are rebuilt from the
    counted group; for chosen columns the repeated keys are joined back.
    """
    if columns is None:
        counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)
        copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(name)))
        return counted.select("*", copies.alias("__copy")).drop("__copy")
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)
    return match(df, counted, columns, "inner", null_safe=True)


def add_count(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    """Group size on every row, as an aggregate joined back."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))
    return match(df, counted, columns, "left", null_safe=True)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first by ``order`` (which must break all ties).

    Spark keeps only the top row per key on each map task before the shuffle,
    so a hot key sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*[as_column(o) for o in order])
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") == 1).drop("__rank")


def period_differences(
    df: DataFrame, keys: Sequence[str], period: str, value: str, base: str, others: Sequence[str]
) -> DataFrame:
    """One row per key with the value of each period and ``base`` minus every other period."""

    def at(p: str) -> Column:
        return F.sum(F.when(F.col(period) == p, F.col(value)))

    wide = df.groupBy(*keys).agg(*[at(p).alias(p) for p in [base, *others]])
    return wide.withColumns({f"difference_{base}_{p}": F.col(f"`{base}`") - F.col(f"`{p}`") for p in others})


def repair_codes(
    df: DataFrame, code: str, facility: Sequence[str], listed: DataFrame, on: tuple[str, str], new_code: str, min_length: int = 6,
    one_row_per_code: bool = False,
) -> DataFrame:
    """Replace short codes from a facility list, then carry the longest code to the gaps.

    ``on`` pairs the facility-name column with its name in ``listed``. Works on
    the distinct (facility, code) pairs: longest code first, ties by
    the code itself; a code shorter than ``min_length`` takes the facility
    list's code, and what is still missing takes the last code before it. The
    repaired pairs are joined back to the rows. Where ``df`` is already summed to one
    row per facility and code, say so: nothing is then read or joined a second time.
    """
    pairs = df if one_row_per_code else df.select(*facility, code).distinct()
    by_name = listed.groupBy(on[1]).agg(F.min(new_code).alias("__listed"))
    pairs = match(pairs, by_name, {on[0]: on[1]}, "left")
    length = F.length(F.col(code))
    fixed = F.when(length.isNull(), F.lit(None)).when(length < min_length, F.col("__listed")).otherwise(F.col(code))
    w = (
        Window.partitionBy(*facility)
        .orderBy(length.desc_nulls_last(), F.col(code).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    pairs = pairs.withColumn("__fixed", fixed)
    pairs = pairs.withColumn("__fixed", F.last("__fixed", ignorenulls=True).over(w)).drop("__listed")
    out = pairs if one_row_per_code else match(df, pairs, list(facility) + [code], "left", null_safe=True)
    return out.withColumn(code, F.col("__fixed")).drop("__fixed")
