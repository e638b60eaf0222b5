"""Equi-join operators: lookups, null-safe map joins, overwrites, reconciliation.

No operator forces a broadcast. Spark broadcasts a side when its own size
estimate (or the measured size, under AQE) is below
``spark.sql.autoBroadcastJoinThreshold``; beyond that the same plan runs as a
sort-merge join and AQE splits hot key partitions. Only tables written out in
code (:func:`literal_table`) are known to be small, and those are local
relations whose exact size the planner sees.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Keys = Sequence[str] | Mapping[str, str]


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """A rule table written out in code, as a local relation with an exact size."""

    def text(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).upper()
        if isinstance(v, int | float):
            return repr(v)
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")


def _pairs(on: Keys) -> list[tuple[str, str]]:
    return list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]


def match(left: DataFrame, right: DataFrame, on: Keys, how: str = "left", null_safe: bool = False) -> DataFrame:
    """Join on equal keys and keep only the left copy of each key.

    ``on`` is a list of shared names or a ``{left: right}`` mapping. With
    ``null_safe`` a NULL key matches a NULL key; Spark still plans that as an
    equi-join. For semi and anti joins only left columns come back.
    """
    pairs = _pairs(on)
    if not pairs:
        raise ValueError("a join needs keys")
    renamed = right
    for i, (_, r) in enumerate(pairs):
        renamed = renamed.withColumnRenamed(r, f"__key{i}")
    test = None
    for i, (l, _) in enumerate(pairs):
        a, b = left[f"`{l}`"], renamed[f"__key{i}"]
        one = a.eqNullSafe(b) if null_safe else a == b
        test = one if test is None else test & one
    return left.join(renamed, test, how).drop(*[f"__key{i}" for i in range(len(pairs))])


def one_per_key(dim: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """The same table, one row per key, with a check inside the plan that a key has one value only.

    A key on rows that differ ends the query with an error that names it; no job runs
    beforehand, and equal rows count as one. The table is grouped by its keys, which is
    the shuffle that a join on them needs anyway. Without ``null_safe`` rows with a NULL
    key go, as they match nothing.
    """
    rest = [c for c in dim.columns if c not in keys]
    rows = dim if null_safe else dim.dropna(subset=list(keys))
    if not rest:
        return rows.distinct()
    whole = F.struct(*rest)
    ends = rows.groupBy(*keys).agg(F.min(whole).alias("__least"), F.max(whole).alias("__most"))
    named = F.concat(F.lit("not unique on " + ", ".join(keys) + ": "), F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys]))
    same = F.col("__least").eqNullSafe(F.col("__most"))
    first = F.when(same, F.col(keys[0])).otherwise(F.raise_error(named).cast(dim.schema[keys[0]].dataType))
    return ends.withColumn(keys[0], first).select(*[F.col(c) if c in keys else F.col(f"__least.{c}") for c in dim.columns])


def lookup(
    left: DataFrame, dim: DataFrame, on: Keys, columns: Sequence[str] | None = None, null_safe: bool = False, unique: bool = True
) -> DataFrame:
    """Left join that adds attribute ``columns`` (default: all non-key columns) of ``dim``.

    A key that ``dim`` holds twice would multiply the rows of ``left``; it is an error
    (:func:`one_per_key`), unless ``unique`` is switched off.
    """
    keys = [r for _, r in _pairs(on)]
    wanted = dim if columns is None else dim.select(*keys, *[c for c in columns if c not in keys])
    if unique:
        wanted = one_per_key(wanted, keys, null_safe)
    return match(left, wanted, on, "left", null_safe)


def map_join(left: DataFrame, mapping: DataFrame, on: Keys) -> DataFrame:
    """Null-safe left join to a disaggregate map; the map is reduced to distinct rows first."""
    return match(left, mapping.distinct(), on, "left", null_safe=True)


def partial_key_map(
    feed: DataFrame,
    mapping: DataFrame,
    on: Keys,
    keep: Sequence[str],
    value: str,
    element: Sequence[str],
    only=None,
) -> DataFrame:
    """Map a feed on fewer keys than the map has.

    The feed is summed over everything but ``keep`` and the keys, the map is
    restricted by ``only`` and projected to keys and ``element`` columns before
    the null-safe join, so map rows that differ only in a dropped key collapse
    and cannot fan out.
    """
    pairs = _pairs(on)
    group = list(dict.fromkeys(list(keep) + [l for l, _ in pairs]))
    summed = feed.groupBy(*group).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(value))
    narrowed = (mapping.filter(only) if only is not None else mapping).select(*[r for _, r in pairs], *element)
    return map_join(summed, narrowed, on)


def reconcile(left: DataFrame, right: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Full outer join that keeps both key columns; all column names must differ.

    Built as a left join plus the right rows without a match: a full outer
    sort-merge join holds all rows of one key in memory and cannot be split,
    these two can. NULL keys match each other.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    matched_rows = left.join(right, left[f"`{on[0]}`"].eqNullSafe(right[f"`{on[1]}`"]), "left")
    return matched_rows.unionByName(not_matched(right, left, {on[1]: on[0]}), allowMissingColumns=True)


def full_lookup(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join on shared keys with one key column each, built like :func:`reconcile`."""
    return lookup(left, right, on, null_safe=True, unique=False).unionByName(not_matched(right, left, on), allowMissingColumns=True)


def not_matched(left: DataFrame, right: DataFrame, on: Keys, null_safe: bool = True) -> DataFrame:
    """Rows of ``left`` with no counterpart; NULL keys count as equal, as the scripts do."""
    keys = [r for _, r in _pairs(on)]
    return match(left, right.select(*keys).distinct(), on, "left_anti", null_safe)


def matched(left: DataFrame, right: DataFrame, on: Keys, null_safe: bool = True) -> DataFrame:
    """Rows of ``left`` with a counterpart in ``right`` (used for key lists, never collected)."""
    keys = [r for _, r in _pairs(on)]
    return match(left, right.select(*keys).distinct(), on, "left_semi", null_safe)


def overwrite(left: DataFrame, crosswalk: DataFrame, on: Keys, replace: Mapping[str, str], when=None, unique: bool = True) -> DataFrame:
    """Overwrite columns from a crosswalk where it has a value: ``{column: new_column}``.

    ``when`` limits the overwrite (for example to one fiscal year). A crosswalk that
    gives a key two values is an error, as in :func:`lookup`.
    """
    hit = lookup(left, crosswalk.select(*[r for _, r in _pairs(on)], *replace.values()), on, unique=unique)
    new_values = {}
    for column, new in replace.items():
        fresh = F.coalesce(F.col(new), F.col(column))
        new_values[column] = fresh if when is None else F.when(when, fresh).otherwise(F.col(column))
    return hit.withColumns(new_values).drop(*replace.values())


def overlap_join(left: DataFrame, right: DataFrame, on: Keys, prefer: str = "left", how: str = "left") -> DataFrame:
    """Join whose shared non-key columns collapse to one: the preferred side, else the other."""
    keys = {r for _, r in _pairs(on)}
    shared = [c for c in right.columns if c in left.columns and c not in keys]
    renamed = right
    for c in shared:
        renamed = renamed.withColumnRenamed(c, f"__right_{c}")
    out = match(left, renamed, on, how)
    pick = {}
    for c in shared:
        a, b = F.col(c), F.col(f"__right_{c}")
        pick[c] = F.coalesce(a, b) if prefer == "left" else F.coalesce(b, a)
    return out.withColumns(pick).drop(*[f"__right_{c}" for c in shared]) if shared else out


def compare_totals(a: DataFrame, b: DataFrame, keys: list[str], value: str, names: tuple[str, str]) -> DataFrame:
    """Two sums of the same grain side by side, with their gap; left side drives."""
    left = a.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(names[0]))
    right = b.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(names[1]))
    return match(left, right, keys, "left", null_safe=True).withColumn("gap", F.col(names[0]) - F.col(names[1]))
