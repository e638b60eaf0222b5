"""From source sheets to submission records: conform, map, attach mechanisms, consolidate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.functions.selectors import starting
from quartermill.functions.semantics import as_column, if_else, in_set, na_sum, not_in
from quartermill.functions.text import first_matching, recode, remove_all, remove_first
from quartermill.operators.aggregates import keys_with_more_than, row_total, sum_by
from quartermill.operators.joins import full_lookup, lookup, map_join, match, matched, not_matched, overwrite, partial_key_map
from quartermill.operators.setops import loose_append
from quartermill.operators.windows import find_repeats
from quartermill.plans import lists

#: Columns of a submission record.
SUBMISSION = ("mech_uid", "orgUnit_uid", "dataElement_uid", "categoryOptionCombo_uid", "value", "period")


def facility_periods(
    mfl: DataFrame, ids: Sequence[str], prefix: str = "fy", merged: Mapping[str, str] | None = None, support: str = "DSD_TA"
) -> DataFrame:
    """Facility list with one column per period to one row per period.

    The period is the first six characters of the column name in upper case;
    combined support types fold into one.
    """
    merged = {"DSD+Roving TA": "DSD"} if merged is None else merged
    long = mfl.unpivot(list(ids), starting(mfl, prefix), "period", support)
    return long.withColumns(
        {"period": F.upper(F.substring("period", 1, 6)), support: recode(support, merged)}
    )


def conform(
    feed: DataFrame,
    value: str,
    indicator: str = "indicator",
    age: str = "CoarseAgeGroup",
    sources: Mapping[str, str] = lists.SOURCE_INDICATORS,
    plain: Mapping[str, str] = lists.PLAIN_INDICATORS,
    bands: Mapping[str, str] = lists.OVER_FIFTY,
    keep_fine: Iterable[str] = ("TX_CURR",),
    strict_parity: bool = False,
) -> DataFrame:
    """Settle indicator names, add numerator/denominator, fold age bands and re-sum.

    One aggregation; rows without an age band are kept. ``strict_parity`` drops
    them, as a filter on the band would.
    """
    named = feed.withColumn(indicator, recode(indicator, sources))
    named = named.withColumn("numeratordenom", if_else(F.col(indicator).contains("_D"), F.lit("D"), F.lit("N")))
    fold = not_in(indicator, keep_fine)
    named = named.withColumn(age, F.when(fold, recode(age, bands)).otherwise(F.col(age)))
    named = named.withColumn(indicator, recode(indicator, plain))
    if strict_parity:
        named = named.filter(F.col(age).isNotNull())
    return sum_by(named, [c for c in named.columns if c != value], [value])


def attach_mechanism(df: DataFrame, sites: DataFrame, mechanisms: DataFrame, site: Mapping[str, str], code: str = "mech_code") -> DataFrame:
    """Site to mechanism code, then mechanism code to its uid and names."""
    return lookup(lookup(df, sites, site), mechanisms, [code])


def to_submission(df: DataFrame, columns: Mapping[str, str], period: Column | None = None) -> DataFrame:
    """Project mapped rows to the submission record; unmapped elements are left out."""
    out = df.withColumn("period", period) if period is not None else df
    names = {**columns, "period": columns.get("period", "period")}
    return out.select(*[F.col(names[c]).alias(c) for c in SUBMISSION]).filter(F.col("dataElement_uid").isNotNull())


def submission_import(
    feed: DataFrame,
    value: str,
    mapping: DataFrame,
    on: Mapping[str, str],
    sites: DataFrame,
    mechanisms: DataFrame,
    site: Mapping[str, str],
    columns: Mapping[str, str],
    period: Column | None = None,
    **conform_options,
) -> DataFrame:
    """Source feed to submission records: conform and sum, map, attach the mechanism, project.

    The feed is summed to the map's grain before any join, so the joins see one
    row per site and element combination. ``columns`` names the mapped columns
    of the record.
    """
    settled = conform(feed, value, **conform_options)
    return to_submission(attach_mechanism(map_join(settled, mapping, on), sites, mechanisms, site), columns, period)


def map_dispensing(feed: DataFrame, mapping: DataFrame, keep: Sequence[str], on: Mapping[str, str], packs: str = "Packs") -> DataFrame:
    """Regimen and age band to data element, packs summed.

    Packs are summed per regimen before the map join and per element after it,
    so the rows that reach the join are already few.
    """
    summed = feed.groupBy(*keep, *on).agg(na_sum(packs).alias(packs))
    mapped = map_join(summed, mapping, on)
    elements = [c for c in mapping.columns if c not in set(on.values())]
    return mapped.groupBy(*keep, *elements).agg(na_sum(packs).alias(packs))


def denominator_variants(
    feed: DataFrame,
    mapping: DataFrame,
    variants: Iterable[tuple[Column, Mapping[str, str], Column | None]],
    keep: Sequence[str],
    value: str,
    element: Sequence[str],
) -> DataFrame:
    """Several disaggregate variants of one feed, each mapped on its own keys, appended.

    ``variants`` are (rows, keys, map rows). A feed row becomes one row per variant it
    is in, tagged with its number and without the keys that variant does not use, so
    the feed is read, summed and joined once.
    """
    variants = list(variants)
    keys = list(dict.fromkeys(l for _, on, _ in variants for l in on))
    tags, maps = [], []
    for n, (rows, on, only) in enumerate(variants):
        nothing = {l: F.lit(None).cast(feed.schema[l].dataType) for l in keys}
        tag = F.struct(F.lit(n).alias("__variant"), *[(F.col(l) if l in on else nothing[l]).alias(f"__{l}") for l in keys])
        tags.append(F.when(rows, tag))
        part = mapping if only is None else mapping.filter(only)
        maps.append(part.select(F.lit(n).alias("__variant"), *[(F.col(on[l]) if l in on else nothing[l]).alias(f"__{l}") for l in keys], *element))
    tagged = feed.select(*keep, value, F.inline(F.array_compact(F.array(*tags))))
    summed = sum_by(tagged, [*keep, "__variant", *[f"__{l}" for l in keys]], [value])
    return map_join(summed, loose_append(*maps), ["__variant", *[f"__{l}" for l in keys]]).select(*keep, *element, value)


def unmapped(mapped: DataFrame, element: str, required: str, columns: Sequence[str]) -> DataFrame:
    """Distinct source combinations for which the map had no element."""
    return mapped.filter(F.col(element).isNull() & F.col(required).isNotNull()).select(*columns).distinct()


def rename_sites(df: DataFrame, renames: DataFrame, site: str, code: str, value: str) -> DataFrame:
    """New site name and code from a rename table, then one re-aggregation."""
    renamed = overwrite(df, renames, {site: "old_name"}, {site: "new_name", code: "new_code"})
    return sum_by(renamed, [c for c in df.columns if c != value], [value])


def consolidate(files: Sequence[DataFrame], period: str | Column, exclude: Column | None = None, drop_zero: bool = False) -> DataFrame:
    """Append submission files, drop incomplete rows and copies, set the period."""
    out = loose_append(*files)
    if exclude is not None:
        out = out.filter(~F.coalesce(exclude, F.lit(False)))
    if drop_zero:
        out = out.filter(F.col("value") != 0)
    out = out.withColumn("period", F.lit(period) if isinstance(period, str) else period)
    return out.dropna("any").distinct()


def repeated_records(records: DataFrame) -> DataFrame:
    """Submission rows whose key (everything but the value) occurs more than once."""
    return find_repeats(records, [c for c in records.columns if c != "value"])


def delete_records(
    long_fact: DataFrame, rows: Column, elements: DataFrame, mechanisms: DataFrame, on: Sequence[str], columns: Mapping[str, str], period: str
) -> DataFrame:
    """Records to delete: filtered long fact, mapped to uids, with the period back-dated."""
    mapped = lookup(map_join(long_fact.filter(rows), elements, on), mechanisms, ["mech_code"])
    return mapped.withColumn("period", F.lit(period)).select(*[F.col(columns.get(c, c)).alias(c) for c in SUBMISSION])


def patch(records: DataFrame, drop: Sequence[Column], corrected: DataFrame) -> DataFrame:
    """Drop the listed subsets and append corrected rows."""
    out = records
    for d in drop:
        out = out.filter(~d)
    return loose_append(out, corrected)


def staffing_submission(
    counts: DataFrame,
    ids: Sequence[str],
    groups: Mapping[str, Sequence[str]],
    element: str,
    period: str,
    categories: Sequence[tuple[str, str]] = lists.STAFF_CATEGORIES,
    default: str = lists.STAFF_CATEGORY_DEFAULT,
    skip_null: bool = True,
) -> DataFrame:
    """Position counts rolled up to cadre groups, as positive staffing records.

    ``ids`` are the record's key columns (org unit, attribute option combo).
    """
    rolled = counts.select(*ids, *[row_total(cols, skip_null).alias(g) for g, cols in groups.items()])
    long = rolled.unpivot(list(ids), list(groups), "code", "Value").filter(F.col("Value") > 0)
    tagged = long.withColumns(
        {
            "Dataelement": F.lit(element),
            "Period": F.lit(period),
            "CategoryOptionCombo": first_matching("code", categories, F.lit(default)),
        }
    )
    keys = ["Dataelement", "Period", *ids, "CategoryOptionCombo"]
    return tagged.groupBy(*keys).agg(na_sum("Value").alias("Value"))


def age_bands(c: Column | str, spellings: Mapping[str, str] = lists.AGE_BAND_SPELLINGS) -> Column:
    """Age-band spellings settled: drop the word ``years``, trim, recode."""
    return recode(F.trim(remove_all(c, "years")), spellings)


def cash_age_bands(c: Column | str, spellings: Mapping[str, str] = lists.CASH_AGE_SPELLINGS) -> Column:
    """Age bands of the cash source: ``5 to 9`` and ``15 - 24`` as two-digit ranges, the listed others recoded."""
    c = F.trim(as_column(c))
    bound = lambda k: F.lpad(F.regexp_extract(c, r"^(\d+) (?:to|-) (\d+)$", k), 2, "0")
    ranged = c.rlike(r"^\d+ (?:to|-) \d+$") & ~in_set(c, list(spellings))
    return F.when(ranged, F.concat(bound(1), F.lit("-"), bound(2))).otherwise(recode(c, spellings))


def area_names(
    c: Column | str, patterns: Sequence[tuple[str, str]] = lists.DISTRICT_PATTERNS, bay: str | None = "Nelson Mandela Bay Metropolitan Municipality"
) -> Column:
    """District spellings settled by ordered patterns; one metro loses its second word."""
    c = as_column(c)
    rest = first_matching(c, patterns)
    return rest if bay is None else F.when(c == bay, remove_first(c, " Metropolitan")).otherwise(rest)


def wrong_ids(names: DataFrame, name: str, uid: str, rows_per_name: int, submitted: DataFrame, submitted_uid: str) -> DataFrame:
    """Facilities under several uids whose uid is absent from the last submission."""
    several = keys_with_more_than(names, [name], rows_per_name, "__rows")
    listed = matched(names, several, [name]).select(name, uid).distinct()
    return not_matched(listed, submitted, {uid: submitted_uid})


def without_wrong_ids(df: DataFrame, wrong: DataFrame, uid: str) -> DataFrame:
    """Rows whose uid is not among the wrong ones."""
    return match(df, wrong.select(uid).distinct(), [uid], "left_anti")


def expected_but_zero(fact: DataFrame, expected: DataFrame, site: str, expected_flag: str, value: str) -> DataFrame:
    """Site roster against fact: ``FLAG`` where a site is expected to report and reports 0."""
    joined = full_lookup(fact, expected, [site])
    return joined.withColumn(
        "flag",
        F.when((F.upper(expected_flag) == "YES") & (F.col(value) == 0), F.lit("FLAG")).otherwise(F.lit("OK")),
    )

