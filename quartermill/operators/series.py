"""Period series as one row each: a dense array over the period axis.

A series is packed once, from rows that are already summed to one per series and
period, so an array is never longer than the list of periods. Completion, lags, fills
and comparisons are then functions over that array, and one ``inline`` turns it back
into rows: no join, no window and no second pass over the input. The list of periods,
where it is not given, comes from a scalar subquery over the packed rows, which reuses
their shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTRIES = "__entries"


def pack(df: DataFrame, series: Sequence[str], period: str, columns: Sequence[str]) -> DataFrame:
    """One row per series; its entries (period, then ``columns``) are sorted by period."""
    entry = F.struct(F.col(period), *[F.col(c) for c in columns])
    return df.groupBy(*series).agg(F.sort_array(F.collect_list(entry)).alias(ENTRIES))


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows dealt by ``keys`` into a set number of tasks, twice the shuffle partitions.

    To be called before a series is packed and completed: its few bytes become many rows,
    so tasks that Spark joins until their bytes are worth it would be few and long (next
    to a larger branch of a union, one or two). Twice, as a deal that equals the one
    before it (of a join on ``keys``) is left out of the plan.
    """
    parts = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys)


def names_of(packed: DataFrame) -> list[str]:
    """Fields of an entry; the first one is the period."""
    return packed.schema[ENTRIES].dataType.elementType.names


def with_entries(packed: DataFrame, entries: Column) -> DataFrame:
    return packed.withColumn(ENTRIES, entries)


def extended(packed: DataFrame, added: Callable[[Column, Column], Mapping[str, Column]]) -> DataFrame:
    """Entries with further fields, made from the entry and its place (from 0)."""
    names = names_of(packed)

    def entry(e: Column, at: Column) -> Column:
        new = added(e, at)
        return F.struct(*[e[n].alias(n) for n in names if n not in new], *[c.alias(n) for n, c in new.items()])

    return with_entries(packed, F.transform(ENTRIES, entry))


def axis_of(packed: DataFrame, periods: Sequence[str] | None = None) -> Column:
    """The sorted list of periods: the given ones, or all that any series has."""
    if periods is not None:
        return F.array(*[F.lit(p) for p in periods])
    period = names_of(packed)[0]
    seen = packed.select(F.explode(F.transform(ENTRIES, lambda e: e[period])).alias(period)).distinct()
    return seen.agg(F.sort_array(F.collect_list(period))).scalar()


def completed(packed: DataFrame, fill: Mapping[str, object], periods: Sequence[str] | None = None) -> DataFrame:
    """Every series in every period; periods that it lacked get ``fill`` and NULL elsewhere."""
    element = packed.schema[ENTRIES].dataType.elementType
    period = element.names[0]
    gaps = F.array_except("__axis", F.transform(ENTRIES, lambda e: e[period]))
    missing = F.transform(
        gaps, lambda p: F.struct(p.alias(period), *[F.lit(fill.get(f.name)).cast(f.dataType).alias(f.name) for f in element.fields[1:]])
    )
    # A column of its own: a subquery can't be part of a function over arrays.
    wide = packed.withColumn("__axis", axis_of(packed, periods))
    return with_entries(wide, F.sort_array(F.concat(ENTRIES, missing))).drop("__axis")


def lagged(packed: DataFrame, value: str, steps: Sequence[int] = (1, 2)) -> DataFrame:
    """Add ``<value>_lag<k>``: the value ``k`` entries earlier."""
    return extended(packed, lambda e, at: {f"{value}_lag{k}": F.get(F.col(ENTRIES), at - F.lit(k))[value] for k in steps})


def _carried(values: Column, size: Column) -> Column:
    """Each of ``size`` values, or the last one before it that is not NULL.

    Every known value is repeated up to the place of the next one: work in proportion
    to the length, where an accumulated array would be copied at each step.
    """
    known = F.filter(F.transform(values, lambda v, at: F.struct(at.alias("at"), v.alias("v"))), lambda e: e["v"].isNotNull())
    runs = F.zip_with(known, F.slice(known, F.lit(2), size), lambda e, after: F.array_repeat(e["v"], F.coalesce(after["at"], size) - e["at"]))
    before = F.array_repeat(F.lit(None), F.coalesce(F.get(known, F.lit(0))["at"], size))
    return F.concat(before, F.flatten(runs))


def filled(packed: DataFrame, columns: Sequence[str], direction: str = "downup") -> DataFrame:
    """Fill NULLs of the entries from the nearest earlier entry, then from the nearest later one."""
    if direction not in ("down", "up", "downup"):
        raise ValueError(f"unknown direction {direction!r}")
    names = names_of(packed)

    def into(column: str) -> Callable[[Column, Column], Column]:
        return lambda e, v: F.struct(*[(F.coalesce(e[n], v) if n == column else e[n]).alias(n) for n in names])

    out, size = F.col(ENTRIES), F.size(ENTRIES)
    for c in columns:
        values = F.col(ENTRIES)[c]
        # The carried values are an argument: inside the function they would be made again for every entry.
        if "down" in direction:
            out = F.zip_with(out, _carried(values, size), into(c))
        if "up" in direction:
            out = F.zip_with(out, F.reverse(_carried(F.reverse(values), size)), into(c))
    return with_entries(packed, out)


def kept(packed: DataFrame, test: Callable[[Column], Column]) -> DataFrame:
    """Only the entries for which a test holds."""
    return with_entries(packed, F.filter(ENTRIES, test))


def unpack(packed: DataFrame) -> DataFrame:
    """Back to one row per entry."""
    # Not the bare column: Spark would then test its size first, and for that test make
    # the whole array again, a lagged one once for each of its entries.
    return packed.select(*[c for c in packed.columns if c != ENTRIES], F.inline(F.concat(ENTRIES)))


def fill_within(df: DataFrame, columns: Sequence[str], group: Sequence[str], period: str, direction: str = "downup") -> DataFrame:
    """Fill NULLs from the nearest earlier period of the group, then the nearest later one.

    For groups with a bounded number of rows per period (the series of one site); the
    rows of a period travel inside its entry, so nothing is joined back. At one period
    the smallest non-NULL value speaks for its rows. For groups of any size see
    :func:`quartermill.operators.windows.fill_within`.
    """
    rest = [c for c in df.columns if c not in (*group, period)]
    rows = F.collect_list(F.struct(*rest)).alias("__rows")
    positions = df.groupBy(*group, period).agg(*[F.min(c).alias(f"__near_{c}") for c in columns], rows)
    near = [f"__near_{c}" for c in columns]
    out = unpack(filled(pack(positions, group, period, [*near, "__rows"]), near, direction))
    out = out.select(*group, period, *near, F.inline("__rows"))
    return out.withColumns({c: F.coalesce(c, f"__near_{c}") for c in columns}).drop(*near)
