"""Finished reporting products, composed from the operators.

Every function takes DataFrames and returns one lazy DataFrame. Long-form
products share one shape: project early, unpivot on the map side, aggregate
once by the string dimensions, then add mirror columns and attributes without a
further shuffle of the fact unless an attribute table is too big to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.functions.periods import drop_century
from quartermill.functions.semantics import as_column, in_set, na_sum, ratio, round_even, unite
from quartermill.functions.selectors import strings
from quartermill.operators.aggregates import roster, sum_by, sum_by_strings
from quartermill.operators.joins import lookup, match, reconcile
from quartermill.operators.reshape import MEASURES, mirror_columns, reshape_long, reshape_semi_wide
from quartermill.operators.series import completed, fill_within, lagged, pack, spread, unpack
from quartermill.operators.setops import loose_append
from quartermill.operators.windows import period_differences, share_of_total
from quartermill.sources.writers import write_ranked
from quartermill.plans.context import (
    area_flags, area_key, labels_by_code, pair_flag, programme_class, with_denominator_suffix,
)


def long_totals(fact: DataFrame, indicators: Sequence[str], year: str = "fiscal_year") -> DataFrame:
    """Long form of the listed indicators, summed by every string column, with mirror columns.

    Measures are summed in wide form first: that aggregation sees one row per
    fact row instead of one per period.
    """
    rows = fact.filter(in_set("indicator", indicators))
    measures = [m for m in MEASURES if m in fact.columns]
    keys = [*strings(rows), year]
    wide = rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    return mirror_columns(reshape_long(wide, year), "indicator", indicators)


def treatment_fact(
    fact: DataFrame,
    indicators: Sequence[str],
    attributes: DataFrame,
    labels: Mapping[str, str],
    disaggregates: DataFrame | None = None,
    priority: str | None = "snuprioritization",
    high_burden: Iterable[str] | None = None,
) -> DataFrame:
    """Treatment dashboard: context, long form, mirror columns, partner attributes and labels.

    ``attributes`` is keyed by ``DSPID`` and ``disaggregates`` by ``disagg_key``
    (indicator, numerator/denominator and disaggregate pasted with ``_``).
    """
    burden = {} if high_burden is None else {"high_burden": high_burden}
    out = long_totals(area_flags(area_key(fact), priority=priority, **burden), indicators)
    out = lookup(out, attributes, ["DSPID"])
    out = out.withColumn("partner_other", labels_by_code("mech_code", labels, "prime_partner_name"))
    if disaggregates is None:
        return out
    keyed = out.withColumn("disagg_key", unite("indicator", "numeratordenom", "standardizeddisaggregate"))
    return lookup(keyed, disaggregates, ["disagg_key"]).drop("disagg_key")


def site_series(
    long_fact: DataFrame,
    indicator: str,
    series: Sequence[str],
    attributes: Sequence[str],
    group: Sequence[str],
    steps: Sequence[int] = (1, 2),
    periods: Sequence[str] | None = None,
) -> DataFrame:
    """Complete period series of one indicator with its lags appended as derived indicators.

    ``series`` identifies a series, ``attributes`` are columns that follow from it and
    are carried into the periods that were missing (within ``group``, ordered by
    period). With ``periods`` the list need not be read from the series.
    """
    observed = (
        long_fact.filter((F.col("indicator") == indicator) & (F.col("period_type") == "results"))
        .groupBy(*series, *attributes, "period")
        .agg(na_sum("value").alias("value"))
    )
    # By group, so that the completed series stay where they are for the fill.
    packed = completed(pack(spread(observed, group), series, "period", ["value", *attributes]), {"value": 0.0}, periods)
    late = lagged(packed, "value", steps)
    rows = fill_within(unpack(late), attributes, group, "period")
    versions = [(indicator, "value", "Reported")] + [(f"{indicator}_LAG{k}", f"value_lag{k}", "Derived") for k in steps]
    each = F.array(
        *[
            F.struct(F.lit(name).alias("indicator"), F.col(c).alias("value"), F.lit(source).alias("source_name"))
            for name, c, source in versions
        ]
    )
    return rows.select(*series, *attributes, "period", F.inline(each))


def site_fact(
    fact: DataFrame,
    indicators: Sequence[str],
    lagged_indicator: str,
    series: Sequence[str],
    carried: Sequence[str],
    group: Sequence[str],
    rows: Column | None = None,
    steps: Sequence[int] = (1, 2),
) -> DataFrame:
    """Site dashboard: long totals with mirror columns, plus the lagged series of one indicator.

    ``rows`` limits the series (for example to one disaggregate). Lag rows carry
    ``period_type`` results and ``source_name`` Derived; area context is added
    to both.
    """
    totals = long_totals(fact, indicators)
    source = fact if rows is None else fact.filter(rows)
    # Four-digit years while periods are put in order, so a series may go over the turn of a century.
    quarters = [q for q in MEASURES if q.startswith("qtr") and q in fact.columns]
    full = lambda q: F.concat(F.col("fiscal_year").cast("string"), F.lit("Q" + q[3:]))
    entries = F.array(*[F.struct(full(q).alias("period"), F.lit("results").alias("period_type"), F.col(q).cast("double").alias("value")) for q in quarters])
    long = source.select(*[c for c in strings(source)], F.inline(F.filter(entries, lambda e: e["value"].isNotNull())))
    lags = site_series(long, lagged_indicator, series, carried, group, steps).filter(F.col("source_name") == "Derived")
    lags = lags.withColumn("period", F.concat(F.lit("FY"), F.substring("period", 3, 4)))
    names = [f"{lagged_indicator}_LAG{k}" for k in steps]
    lags = mirror_columns(lags.withColumn("period_type", F.lit("results")), "indicator", names)
    return area_flags(area_key(loose_append(totals, lags)), priority=None)


def prevention_fact(
    fact: DataFrame, indicators: Sequence[str], remap: Mapping[str, str], remap_year: int, programme: Column, original: Iterable[str]
) -> DataFrame:
    """Prevention dashboard: programme class, year-scoped code remap, long form and mirror columns."""
    code = F.col("mech_code")
    moved = code
    for old, new in remap.items():
        moved = F.when((F.col("fiscal_year") == remap_year) & (code == old), F.lit(new)).otherwise(moved)
    tagged = area_flags(area_key(fact), priority=None).withColumns(
        {"programme_class": programme_class(programme, "psnu", original), "mech_code": moved}
    )
    return long_totals(tagged, indicators)


def semi_wide_fact(fact: DataFrame, keys: Sequence[str], attributes: DataFrame | None = None) -> DataFrame:
    """Semi-wide treatment fact: summed by keys, one row per period, attributes attached."""
    measures = [m for m in MEASURES if m in fact.columns]
    out = reshape_semi_wide(sum_by(fact, [*keys, "fiscal_year"], measures))
    return out if attributes is None else lookup(out, attributes, ["DSPID"])


def with_estimates(fact_long: DataFrame, estimates: Sequence[DataFrame], indicators: Sequence[str]) -> DataFrame:
    """Programme rows and estimate sources appended, summed by string columns, mirrored.

    Each source is summed before the append so the wide union carries totals only.
    """
    sources = [sum_by_strings(s, ["value"]) for s in (fact_long, *estimates)]
    merged = loose_append(*sources)
    return mirror_columns(sum_by_strings(merged, ["value"]), "indicator", indicators)


def outlays_and_results(
    results: DataFrame, outlays: DataFrame, budget_columns: Sequence[str], indicators: Sequence[str], period: str, keys: Sequence[str]
) -> DataFrame:
    """Results by mechanism next to budgets and outlays in one long table with mirror columns."""
    spent = outlays.unpivot(list(keys), list(budget_columns), "indicator", "value").withColumn("period", F.lit(period))
    return mirror_columns(loose_append(spent, results), "indicator", [*budget_columns, *indicators])


def executive_extract(fact_long: DataFrame, indicators: Sequence[str], disaggregates: Sequence[str], agency: str) -> DataFrame:
    """Listed indicators of one agency with denominator suffix and ``period period_type`` labels."""
    return (
        fact_long.filter(
            F.col("indicator").isin(list(indicators))
            & F.col("standardizeddisaggregate").isin(list(disaggregates))
            & (F.col("funding_agency") == agency)
        )
        .withColumn("indicator", with_denominator_suffix("indicator", "numeratordenom"))
        .withColumn("period", unite("period", "period_type", sep=" "))
    )


def partner_geography(fact: DataFrame, columns: Sequence[str], areas: Mapping[str, str]) -> DataFrame:
    """Distinct site-partner roster with the partner's technical area."""
    return roster(fact, columns).withColumn("technical_area", labels_by_code("mech_code", areas))


def achievement_table(
    fact: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    masked: Sequence[str] = (),
    bands: Sequence[tuple[float, str]] = (),
    digits: int = 2,
    measures: Sequence[str] = ("qtr1", "qtr2", "qtr3", "qtr4", "cumulative", "targets"),
) -> DataFrame:
    """Results against targets for every partner or area at once.

    ``achievement`` is rounded half to even, ``diff`` is the gap to 1. Status
    ``bands`` are ``(upper bound, label)`` pairs in rising order; indicators in
    ``masked`` keep their row without achievement.
    """
    out = sum_by(fact.filter(in_set("indicator", order)), [*by, "indicator"], measures)
    reached = round_even(ratio("cumulative", "targets"), digits)
    hidden = in_set("indicator", masked)
    out = out.withColumns(
        {"achievement": reached, "diff": F.lit(1.0) - reached, "order_index": custom_order("indicator", order)}
    )
    if bands:
        status = F.when(hidden, F.lit("NA"))
        for bound, label in bands[:-1]:
            status = status.when(F.col("achievement") < bound, F.lit(label))
        status = status.when(F.col("achievement").isNotNull(), F.lit(bands[-1][1]))
        out = out.withColumn("status", status)
    return out.withColumns({c: F.when(~hidden, F.col(c)) for c in ("achievement", "cumulative")})


def custom_order(c: Column | str, order: Sequence[str]) -> Column:
    """Position of a value in a fixed order (1-based); values outside it come last."""
    at = F.array_position(F.array(*[F.lit(o) for o in order]), as_column(c))
    return F.when(at > 0, at).otherwise(F.lit(len(order) + 1).cast("bigint")).cast("int")


def partner_transition(
    fact: DataFrame, keys: Sequence[str], base: str, others: Sequence[str], exclude_area: str | None = None
) -> DataFrame:
    """Non-zero quarterly results by area and partner, with the change from ``base`` to each other period."""
    rows = fact if exclude_area is None else fact.filter(~F.col("psnu").rlike(exclude_area))
    quarters = [m for m in ("qtr1", "qtr2", "qtr3", "qtr4") if m in fact.columns]
    summed = sum_by(rows, [*keys, "fiscal_year"], quarters)
    long = reshape_long(summed, measures=quarters, keep_type=False).filter(F.col("value") != 0)
    return period_differences(long, keys, "period", "value", base, others)


def target_share(fact: DataFrame, keys: Sequence[str], within: Sequence[str], value: str = "targets") -> DataFrame:
    """Target per partner and its share of the indicator's total."""
    return share_of_total(sum_by(fact, [*keys, *within], [value]), value, within)


def _with_total(df: DataFrame, category: str, value: str) -> DataFrame:
    totals = df.groupBy(category).agg(na_sum(value).alias("__total"))
    return match(df, totals, [category], "left", null_safe=True)


def _by_total(category: str, descending: bool) -> list[Column]:
    return [F.col("__total").desc() if descending else F.col("__total").asc(), F.col(category).asc_nulls_last()]


def sort_by_total(df: DataFrame, category: str, value: str, descending: bool = False) -> DataFrame:
    """Rows sorted by the total of their category (then by the category itself)."""
    return _with_total(df, category, value).orderBy(*_by_total(category, descending)).drop("__total")


def write_by_total(
    df: DataFrame, category: str, value: str, path: str, ties: Sequence[Column | str], descending: bool = False, parts: int | None = None
) -> None:
    """The same order, with ``ties`` to settle it within a category, as files to be read with their position."""
    write_ranked(_with_total(df, category, value), path, [*_by_total(category, descending), *ties], parts)


def staffing_fact(
    sheet: DataFrame,
    periods: Sequence[str],
    indicators: Sequence[str],
    pairs: Mapping[str, Iterable[str] | None] | None = None,
    attributes: DataFrame | None = None,
    cadre: str = "occ_classification",
    model: str = "service_delivery_model",
) -> DataFrame:
    """Staffing dashboard: period columns to rows, worker-class flag, area context, mirror columns.

    ``periods`` are the sheet's period columns (``FY2022Q4`` becomes ``FY22Q4``).
    The sheet is summed by its string columns while still wide.
    """
    wide = sum_by_strings(sheet, periods)
    ids = [c for c in wide.columns if c not in set(periods)]
    long = wide.unpivot(ids, list(periods), "period", "value").withColumn("period", drop_century("period"))
    flagged = pair_flag(long, cadre, model) if pairs is None else pair_flag(long, cadre, model, pairs)
    out = mirror_columns(area_flags(area_key(flagged), priority=None), "indicator", indicators)
    return out if attributes is None else lookup(out, attributes, ["DSPID"])


def site_attributes(
    listed: DataFrame, hierarchy: DataFrame, names: tuple[str, str], extras: Mapping[str, DataFrame] | None = None, uid: str = "orgunituid"
) -> DataFrame:
    """Two site lists reconciled by name (both names kept), with per-site reference tables attached."""
    out = reconcile(listed, hierarchy, names)
    for column, table in (extras or {}).items():
        out = lookup(out, table, [uid], [column])
    return out


def prevention_coverage(
    fact: DataFrame, agency: DataFrame, areas: Mapping[str, str], agencies: Sequence[str], keys: Sequence[str] = ("psnu", "psnuuid")
) -> DataFrame:
    """Areas where an orphan-care partner works, with the agency that leads treatment there.

    ``agency`` gives ``agency_lookback`` by ``DSPID``.
    """
    keyed = lookup(area_key(fact), agency, ["DSPID"], ["agency_lookback"])
    led = keyed.filter(in_set("agency_lookback", agencies)).withColumn("technical_area", labels_by_code("mech_code", areas))
    covered = F.max(F.when(F.col("technical_area") == "OVC", F.lit(1)).otherwise(0))
    by_area = led.groupBy(*keys, "agency_lookback").agg(covered.alias("__covered"), na_sum("targets").alias("targets"))
    return by_area.withColumn("ovc_coverage", F.when(F.col("__covered") == 1, "Y").otherwise("N")).drop("__covered")
