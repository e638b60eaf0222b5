"""Data-quality rules: one declarative rule table, evaluated in one pass over the fact.

A rule compares a few *terms*; a term is the summed value of the rows that
satisfy an SQL condition. All terms of all rules become conditional sums of a
single ``groupBy`` on the site keys (partial aggregates, one shuffle), then
each group yields its findings by evaluating the rules on the summed terms. A
term with no rows at a site is NULL, and a comparison with NULL gives no
finding; ``missing_as_zero`` changes that.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartermill.functions.periods import year_label
from quartermill.operators.joins import compare_totals, not_matched
from quartermill.operators.setops import loose_append
from quartermill.operators.series import kept, lagged, unpack

LEVEL_1, LEVEL_2 = "Level 1", "Level 2"


@dataclass(frozen=True)
class Rule:
    """A named check.

    ``terms`` maps a term name to an SQL condition on the fact's columns;
    ``fails_when`` is an SQL condition on the term names. A term's value in the
    quarter before is available as ``<name>__prior``; ``<name>__any`` tells
    whether any period has a value other than 0.
    """

    name: str
    message: str
    terms: Mapping[str, str]
    fails_when: str
    level: str = LEVEL_2
    type_check: str = "IntraIndicator"
    indicator: str | None = None


def less_than(name: str, message: str, a: str, b: str, **kw) -> Rule:
    """Fails when the first term is smaller than the second."""
    return Rule(name, message, {"a": a, "b": b}, "a < b", **kw)


def greater_than(name: str, message: str, a: str, b: str, **kw) -> Rule:
    """Fails when the first term is larger than the second."""
    return Rule(name, message, {"a": a, "b": b}, "a > b", **kw)


def differs(name: str, message: str, a: str, b: str, **kw) -> Rule:
    """Fails when the two terms differ."""
    return Rule(name, message, {"a": a, "b": b}, "a <> b", **kw)


def numerator_over_denominator(name: str, message: str, rows: str, **kw) -> Rule:
    """Fails when the numerator exceeds the denominator."""
    return Rule(
        name, message, {"n": f"({rows}) AND numeratordenom = 'N'", "d": f"({rows}) AND numeratordenom = 'D'"}, "n > d", **kw
    )


def less_than_sum(name: str, message: str, a: str, parts: Sequence[str], **kw) -> Rule:
    """Fails when the first term is smaller than the sum of the parts (each part must exist)."""
    terms = {"a": a, **{f"p{i}": p for i, p in enumerate(parts)}}
    return Rule(name, message, terms, "a < " + " + ".join(f"p{i}" for i in range(len(parts))), **kw)


def greater_than_sum(name: str, message: str, a: str, parts: Sequence[str], **kw) -> Rule:
    """Fails when the first term is larger than the sum of the parts (each part must exist)."""
    terms = {"a": a, **{f"p{i}": p for i, p in enumerate(parts)}}
    return Rule(name, message, terms, "a > " + " + ".join(f"p{i}" for i in range(len(parts))), **kw)


def share_above(name: str, message: str, part: str, whole: str, limit: float, **kw) -> Rule:
    """Fails when part / whole exceeds the limit; a positive part over zero fails too."""
    return Rule(
        name, message, {"part": part, "whole": whole},
        f"CASE WHEN whole = 0 THEN part > 0 ELSE try_divide(part, whole) > {limit!r} END", **kw,
    )


def prior_missing(name: str = "prior_missing", rows: str = "true", strict_parity: bool = False, **kw) -> Rule:
    """Value in the previous quarter, none or zero in this one.

    ``strict_parity`` also flags a current zero or gap whose previous quarter was
    empty too, as long as some other quarter has a value.
    """
    test = "t__prior > 0 AND coalesce(t, 0) = 0"
    if strict_parity:
        test = "coalesce(t, 0) = 0 AND t__any"
    return Rule(
        name, "Value reported in previous quarter but missing in this quarter", {"t": rows}, test,
        level=LEVEL_1, type_check="Result in previous quarter", **kw,
    )


FINDING = (
    "mech_code", "prime_partner_name", "level", "today_date", "type_check", "period", "indicator", "check", "psnu", "sitename",
)


def term_totals(
    fact: DataFrame, keys: Sequence[str], conditions: Sequence[str], measures: Sequence[str], missing_as_zero: bool = False
) -> DataFrame:
    """Sum each measure over the rows of each condition: one row per group.

    Columns are ``term<condition>_<measure>`` by position. Rows that satisfy no
    condition are left out before the grouping, so a group takes part when at
    least one of its terms has rows.
    """
    relevant = " OR ".join(f"({c})" for c in conditions)
    sums = []
    for i, condition in enumerate(conditions):
        for j, measure in enumerate(measures):
            total = F.sum(F.when(F.expr(condition), F.coalesce(F.col(measure), F.lit(0.0))))
            sums.append((F.coalesce(total, F.lit(0.0)) if missing_as_zero else total).alias(f"term{i}_{j}"))
    return fact.filter(F.expr(relevant)).groupBy(*keys).agg(*sums)


def _bound(rule: Rule, column: Mapping[str, int], period: int, periods: int) -> str:
    """The rule's condition for one period, its term names replaced by summed columns."""
    names = "|".join(re.escape(t) for t in sorted(rule.terms, key=len, reverse=True))

    def cell(m: re.Match) -> str:
        i = column[rule.terms[m.group(1)]]
        if m.group(2) == "__prior":
            return f"term{i}_{period - 1}" if period else "CAST(NULL AS DOUBLE)"
        if m.group(2) == "__any":
            return "(" + " OR ".join(f"coalesce(term{i}_{j}, 0) <> 0" for j in range(periods)) + ")"
        return f"term{i}_{period}"

    return re.sub(rf"(?<![\w.])({names})(__prior|__any)?(?!\w)", cell, rule.fails_when)


def findings(
    fact: DataFrame,
    keys: Sequence[str],
    rules: Sequence[Rule],
    measures: Mapping[str, str],
    today: dt.date | None = None,
    missing_as_zero: bool = False,
    only_periods: Sequence[str] | None = None,
) -> DataFrame:
    """One row per failed rule, group and period.

    ``measures`` maps a period label (an SQL expression over the keys) to the
    measure column of that period, in time order. Conditions that several rules
    share are summed once; the rules are evaluated on the summed row, so only
    failures are expanded.
    """
    column = {c: i for i, c in enumerate(dict.fromkeys(c for r in rules for c in r.terms.values()))}
    summed = term_totals(fact, keys, list(column), list(measures.values()), missing_as_zero)
    indicator = F.col("indicator") if "indicator" in keys else F.lit(None).cast("string")
    hits = F.array_compact(F.array(*_failures(rules, column, list(measures), indicator)))
    out = summed.select(*keys, F.inline(hits)).drop("indicator").withColumnRenamed("__indicator", "indicator")
    if only_periods is not None:
        out = out.filter(F.col("period").isin(list(only_periods)))
    return out.withColumn("today_date", F.lit(today) if today else F.current_date())


def _found(when: Column, period: Column, level: str, type_check: str, indicator: Column, check: str) -> Column:
    """A finding where a condition holds, else NULL."""
    cells = {"period": period, "level": F.lit(level), "type_check": F.lit(type_check), "__indicator": indicator, "check": F.lit(check)}
    return F.when(when, F.struct(*[c.cast("string").alias(n) for n, c in cells.items()]))


def _failures(rules: Sequence[Rule], column: Mapping[str, int], labels: Sequence[str], indicator: Column) -> list[Column]:
    """The finding of every rule in every period, on a row of summed terms."""
    return [
        _found(F.expr(_bound(r, column, i, len(labels))), F.expr(labels[i]), r.level, r.type_check, F.lit(r.indicator) if r.indicator else indicator, r.message)
        for i in range(len(labels)) for r in rules
    ]


#: Level 1 checks and their check types.
TARGET_CHECK = ("Target without result", "Targets reported but results blank")
PRIOR_CHECK = ("Result in previous quarter", "Value reported in previous quarter but missing in this quarter")


def target_findings(fact: DataFrame, keys: Sequence[str], period: str, today: dt.date | None = None) -> DataFrame:
    """Level 1: a target above zero whose cumulative result is zero, per group."""
    summed = fact.groupBy(*keys).agg(
        F.coalesce(F.sum("targets"), F.lit(0.0)).alias("targets"),
        F.coalesce(F.sum("cumulative"), F.lit(0.0)).alias("cumulative"),
    )
    return summed.filter((F.col("targets") > 0) & (F.col("cumulative") == 0)).select(
        *keys,
        F.expr(period).cast("string").alias("period"),
        F.lit(LEVEL_1).alias("level"),
        F.lit(TARGET_CHECK[0]).alias("type_check"),
        F.lit(TARGET_CHECK[1]).alias("check"),
        (F.lit(today) if today else F.current_date()).alias("today_date"),
    )


def _gaps(at, year: str, quarters: int, last: Column, checks: Sequence[tuple[str, str]], indicator: Column) -> list[Column]:
    """Level 1 findings of one series on a yearly row; ``at(k)`` is a summed measure.

    Measures are ``targets``, ``cumulative``, the quarters by number (from 0) and
    ``next``, the first quarter of the year that follows (NULL where it has no row).
    """
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    label = lambda y, q: F.concat(year_label(y), F.lit(f"Q{q}"))
    found = []
    if TARGET_CHECK in checks:
        blank = (zero(at("targets")) > 0) & (zero(at("cumulative")) == 0)
        found.append(_found(blank, year_label(year), LEVEL_1, TARGET_CHECK[0], indicator, TARGET_CHECK[1]))
    if PRIOR_CHECK in checks:
        for i in range(quarters):
            at_end = i == quarters - 1
            later = at("next") if at_end else at(i + 1)
            gap = (at(i) > 0) & (zero(later) == 0) & (F.col(year) * quarters + (i + 1) <= last)
            period = label(F.col(year) + 1, 1) if at_end else label(F.col(year), i + 2)
            found.append(_found(gap, period, LEVEL_1, PRIOR_CHECK[0], indicator, PRIOR_CHECK[1]))
    return found


def _last_due(through: tuple[int, int] | Column, quarters: int) -> Column:
    """The last due period as one number: year times quarters, plus the quarter from 0."""
    return through if isinstance(through, Column) else F.lit(through[0] * quarters + through[1] - 1)


def level_one(
    fact: DataFrame,
    keys: Sequence[str],
    year: str,
    quarters: Sequence[str],
    through: tuple[int, int] | Column,
    today: dt.date | None = None,
    checks: Sequence[tuple[str, str]] = (TARGET_CHECK, PRIOR_CHECK),
) -> DataFrame:
    """Level 1 report in one pass: targets without results, and values missing after a reported quarter.

    ``keys`` include the indicator but not ``year``. Quarters are a continuous axis:
    the first quarter of a year follows the last one of the year before, and a key
    that has no row at all in the next year is missing there too. No gap is reported
    after ``through``, the last period that is due: (year, quarter), or a column
    with the year times the quarters of a year, plus the quarter from 0.
    """
    measures = ["targets", "cumulative", *quarters]
    summed = fact.groupBy(*keys, year).agg(*[F.sum(m).alias(m) for m in measures])
    summed = _with_next(summed, [k for k in keys], year, {"__next": quarters[0]}).withColumn("__last", _last_due(through, len(quarters)))
    at = lambda k: F.col("__next" if k == "next" else k if isinstance(k, str) else quarters[k])
    found = _gaps(at, year, len(quarters), F.col("__last"), checks, F.lit(None))
    return summed.select(*keys, F.inline(F.array_compact(F.array(*found)))).drop("__indicator").withColumn(
        "today_date", F.lit(today) if today else F.current_date())


def _with_next(summed: DataFrame, keys: Sequence[str], year: str, first: Mapping[str, str]) -> DataFrame:
    """The first quarters of the following year, by name. A key has one row per year, so the window is short."""
    following = Window.partitionBy(*keys).orderBy(year)
    is_next = F.lead(year).over(following) == F.col(year) + 1
    return summed.withColumns({name: F.when(is_next, F.lead(c).over(following)) for name, c in first.items()})


def both_levels(
    rows: DataFrame,
    keys: Sequence[str],
    year: str,
    indicators: Sequence[str],
    measures: Mapping[str, str],
    quarters: Mapping[int, str],
    through: tuple[int, int] | Column,
    rules: Sequence[Rule],
    value: str,
    period: str,
    today: dt.date | None = None,
) -> DataFrame:
    """Level 1 of the listed indicators and the yearly level 2 rules, from one pass over the rows.

    ``measures`` are the SQL expressions of ``targets`` and ``cumulative``, ``quarters``
    those of the quarterly results by number (from 1); ``value`` is what the rules sum
    and ``period`` the label of a year. One ``groupBy`` on ``keys`` and ``year`` holds a sum
    per indicator and measure and one per rule condition; only findings are expanded.
    """
    cells = {**measures, **{str(q): e for q, e in quarters.items()}}
    column = {c: i for i, c in enumerate(dict.fromkeys(c for r in rules for c in r.terms.values()))}
    own = [F.sum(F.when(F.col("indicator") == i, F.expr(e))).alias(f"{m}__{n}") for n, i in enumerate(indicators) for m, e in cells.items()]
    terms = [F.sum(F.when(F.expr(c), F.coalesce(F.col(value), F.lit(0.0)))).alias(f"term{k}_0") for c, k in column.items()]
    first = min(quarters)
    summed = _with_next(rows.groupBy(*keys, year).agg(*own, *terms), keys, year, {f"next__{n}": f"{first}__{n}" for n in range(len(indicators))})
    summed = summed.withColumn("__last", _last_due(through, len(quarters)))
    found = _failures(rules, column, [period], F.lit(None))
    for n, i in enumerate(indicators):
        at = lambda k, n=n: F.col(f"{k if isinstance(k, str) else k + first}__{n}")
        found += _gaps(at, year, len(quarters), F.col("__last"), (TARGET_CHECK, PRIOR_CHECK), F.lit(i))
    out = summed.select(*keys, F.inline(F.array_compact(F.array(*found)))).withColumnRenamed("__indicator", "indicator")
    return out.withColumn("today_date", F.lit(today) if today else F.current_date())


def report(*found: DataFrame) -> DataFrame:
    """Findings of one or more checks in the finding layout; columns they lack are NULL."""
    both = loose_append(*found)
    missing = {c: F.lit(None).cast("string") for c in FINDING if c not in both.columns}
    return both.withColumns(missing).select(*FINDING)


def lagged_comparison(packed: DataFrame, value: str, against: str, steps: int, message: str) -> DataFrame:
    """Fails where a value ``steps`` periods ago is larger than another value now.

    ``packed`` is a completed series per row (:mod:`quartermill.operators.series`); only
    the failures become rows.
    """
    late = f"{value}_lag{steps}"
    return unpack(kept(lagged(packed, value, [steps]), lambda e: e[late] > e[against])).withColumn("check", F.lit(message))


def missing_from_submission(
    reported: DataFrame,
    submitted: DataFrame,
    on: Mapping[str, str],
    value: str,
    columns: Sequence[str],
    period: str,
    today: dt.date | None = None,
) -> DataFrame:
    """Level 1, import form: a value in the previous quarter and nothing in the new submission.

    ``on`` maps the fact's key columns to the submission's; ``value`` is the
    submission's measure. Both sides may have many rows per key.
    """
    present = submitted.filter(F.col(value).isNotNull())
    missing = not_matched(reported, present, on)
    return missing.select(
        *columns,
        F.lit(period).alias("period"),
        F.lit(LEVEL_1).alias("level"),
        F.lit("Result in previous quarter").alias("type_check"),
        F.lit("Value reported in previous quarter but missing in this quarter").alias("check"),
        (F.lit(today) if today else F.current_date()).alias("today_date"),
    )


#: Check type and text of the comparison of a submission with its source.
SOURCE_CHECK = ("TriangulationWithSource", "Value in import does not match source")


def value_mismatch(
    submitted: DataFrame, source: DataFrame, keys: Sequence[str], value: str, columns: Sequence[str], period: str, today: dt.date | None = None
) -> DataFrame:
    """Level 1: totals of a submission that differ from its source, in the finding layout.

    Both sides may have many rows per key and are summed first (missing values count as
    0). A key that the source lacks gives no finding; both totals stay on the row.
    """
    both = compare_totals(submitted, source, list(keys), value, ("submitted", "source"))
    return both.filter(F.col("submitted") != F.col("source")).select(
        *columns, "submitted", "source",
        F.expr(period).cast("string").alias("period"),
        F.lit(LEVEL_1).alias("level"),
        F.lit(SOURCE_CHECK[0]).alias("type_check"),
        F.lit(SOURCE_CHECK[1]).alias("check"),
        (F.lit(today) if today else F.current_date()).alias("today_date"),
    )


def completeness(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Pass, fail and missing counts per rule; every rule is a conditional count of one scan."""
    cells = []
    for name, condition in rules.items():
        test = F.expr(condition)
        cells += [
            F.count(F.when(test, 1)).alias(f"{name}__pass"),
            F.count(F.when(~test, 1)).alias(f"{name}__fail"),
            F.count(F.when(test.isNull(), 1)).alias(f"{name}__na"),
        ]
    one = df.agg(F.count(F.lit(1)).alias("items"), *cells)
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col("items").alias("items"),
            F.col(f"{name}__pass").alias("passes"),
            F.col(f"{name}__fail").alias("fails"),
            F.col(f"{name}__na").alias("missing"),
        )
        for name in rules
    ]
    return one.select(F.inline(F.array(*rows)))


def key_prefixes(df: DataFrame, columns: Sequence[str], margin: float = 0.1) -> DataFrame:
    """For each prefix of ``columns``: is it a key? (prefix, columns, is_key), in one lazy plan.

    One scan makes a mergeable sketch of the distinct values of every prefix. Prefixes
    whose estimate is ``margin`` or more below the number of rows are ruled out (a sketch
    of this size errs by under 1 percent; ten times that never happens in practice, and
    a prefix ruled out wrongly would be reported as no key). The shortest of the
    others is counted exactly. Only if it has repeats are the longer ones counted, all
    at once. Prefixes behind a key are keys; NULL counts as a value.
    """
    n = len(columns)
    sketches = [F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*columns[:k], F.lit(k)), F.lit(14))).alias(f"e{k}") for k in range(1, n + 1)]
    measured = df.agg(F.count(F.lit(1)).alias("rows"), *sketches)
    likely = F.array_compact(F.array(*[F.when(F.col(f"e{k}") >= (1 - margin) * F.col("rows"), F.lit(k)) for k in range(1, n + 1)]))
    candidates = measured.select(likely.alias("likely"))

    def repeated(prefixes: DataFrame) -> DataFrame:
        """One row: the listed prefixes, and those of them that have repeats."""
        tagged = df.select(*columns).withColumn("__all", prefixes.scalar()).withColumn("__prefix", F.explode("__all")).drop("__all")
        masked = [F.when(F.col("__prefix") >= k, F.col(c)).alias(c) for k, c in enumerate(columns, 1)]
        several = tagged.select("__prefix", *masked).groupBy("__prefix", *columns).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
        return several.agg(F.collect_set("__prefix").alias("doubled"))

    shortest = candidates.select(F.slice("likely", 1, 1).alias("p"))
    first = repeated(shortest)
    # The longer ones are read only where the shortest has repeats.
    longer = candidates.withColumn("doubled", first.scalar()).select(
        F.when(F.size("doubled") > 0, F.slice("likely", 2, n)).otherwise(F.array().cast("array<int>")).alias("p"))
    state = candidates.withColumn("first", first.scalar()).withColumn("rest", repeated(longer).scalar())
    doubled = F.array_union("first", "rest")
    good = F.array_min(F.array_except("likely", doubled))
    rows = [F.struct(F.lit(k).alias("prefix"), F.lit(", ".join(columns[:k])).alias("columns"), F.coalesce(F.lit(k) >= good, F.lit(False)).alias("is_key")) for k in range(1, n + 1)]
    return state.select(F.inline(F.array(*rows)))
