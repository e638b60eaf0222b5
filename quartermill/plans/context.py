"""Context columns: short area names, keys, flags, labels and official names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.functions.semantics import as_column, code_in, if_else, in_set, unite
from quartermill.functions.text import recode, replace_all
from quartermill.operators.joins import literal_table, match, overwrite
from quartermill.plans import lists


def short_area_name(c: Column | str) -> Column:
    """``District Municipality`` to ``DM`` and ``Metropolitan Municipality`` to ``MM``."""
    return replace_all(replace_all(c, "District Municipality", "DM"), "Metropolitan Municipality", "MM")


def area_key(df: DataFrame, area: str = "psnu", mechanism: str = "mech_code", key: str = "DSPID") -> DataFrame:
    """Add the short area name and the partner-area key (mechanism code + short name)."""
    return df.withColumn("short_name", short_area_name(area)).withColumn(key, unite(mechanism, "short_name", sep=""))


def yes_no(test: Column, yes: str = "YES", no: str = "NO") -> Column:
    """Flag column; a NULL test is ``no``."""
    return F.when(test, F.lit(yes)).otherwise(F.lit(no))


def area_flags(
    df: DataFrame,
    area: str = "psnu",
    priority: str | None = "snuprioritization",
    high_burden: Iterable[str] = lists.HIGH_BURDEN_AREAS,
    focus: Iterable[str] = lists.FOCUS_PRIORITIES,
) -> DataFrame:
    """Add ``HIGHBURDEN`` and ``focus_district`` flags."""
    out = df.withColumn("HIGHBURDEN", yes_no(in_set(area, high_burden)))
    return out.withColumn("focus_district", yes_no(in_set(priority, focus))) if priority else out


def programme_class(
    flag: Column, area: Column | str, original: Iterable[str] = lists.ORIGINAL_PROGRAMME_AREAS, name: str = "DREAMS"
) -> Column:
    """``original <name> district``, ``<name> expansion district`` or ``not a <name> district``."""
    return (
        F.when(flag & in_set(area, original), F.lit(f"original {name} district"))
        .when(flag, F.lit(f"{name} expansion district"))
        .otherwise(F.lit(f"not a {name} district"))
    )


def labels_by_code(c: Column | str, labels: Mapping, default: Column | str | None = None) -> Column:
    """Label by code; codes compare as text. Without ``default`` other codes get ``''``."""
    c = as_column(c).cast("string")
    result = F.when(F.lit(False), F.lit(""))
    for code, label in labels.items():
        result = result.when(c == str(code), F.lit(label))
    return result.otherwise(F.lit("") if default is None else as_column(default))


def prevention_partner(
    mechanism: Column | str,
    indicator: Column | str,
    groups: Mapping[str, str] = lists.PREVENTION_GROUPS,
    labels: Mapping[tuple[str, str], str] = lists.PREVENTION_PARTNERS,
    default: str = "NOT DREAMS PARTNER",
) -> Column:
    """Partner label by mechanism and indicator group."""
    result = F.when(F.lit(False), F.lit(""))
    for (code, group), label in labels.items():
        members = [i for i, g in groups.items() if g == group]
        result = result.when(code_in(mechanism, [code]) & in_set(indicator, members), F.lit(label))
    return result.otherwise(F.lit(default))


def rule_labels(df: DataFrame, on: Sequence[str], rules: Sequence[Sequence], label: str, default: str) -> DataFrame:
    """Label rows from a rule table written out in code (exact keys), else ``default``."""
    table = literal_table(df.sparkSession, [*on, "__label"], rules)
    out = match(df, table, on)
    return out.withColumn(label, F.coalesce(F.col("__label"), F.lit(default))).drop("__label")


def pattern_labels(df: DataFrame, column: str, rules: DataFrame, label: str, default: Column | str | None = None) -> DataFrame:
    """Label rows by the first matching pattern of a rule table (priority, pattern, label).

    The table may hold thousands of rules; it is one array, in order of priority (then
    pattern). Only the distinct values of the column are matched, each once, and the
    labels are joined back. NULL and values without a match get ``default`` (without it
    the value itself). Patterns are searched anywhere in the value.
    """
    ordered = rules.agg(F.sort_array(F.collect_list(F.struct("priority", "pattern", "label")))).scalar()
    names = df.select(F.col(column).alias("__name")).distinct().withColumn("__rules", ordered)
    first = F.get(F.filter("__rules", lambda r: F.rlike(F.col("__name"), r["pattern"])), F.lit(0))["label"]
    found = names.filter("__name IS NOT NULL").select("__name", first.alias("__label"))
    out = match(df, found, {column: "__name"})
    fallback = F.col(column) if default is None else as_column(default)
    return out.withColumn(label, F.coalesce(F.col("__label"), fallback)).drop("__label")


def pair_flag(
    df: DataFrame,
    first: str,
    second: str,
    pairs: Mapping[str, Iterable[str] | None] = lists.COMMUNITY_CADRES,
    name: str = "CHW_like",
) -> DataFrame:
    """``Yes`` for listed (first, second) pairs; ``None`` accepts any second value."""
    test = F.lit(False)
    for a, bs in pairs.items():
        one = in_set(first, [a])
        test = test | (one if bs is None else one & in_set(second, list(bs)))
    return df.withColumn(name, yes_no(test, "Yes", "No"))


def lookback_code(code: Column | str, historic: Column | str) -> Column:
    """Historic mechanism code where it differs; a NULL on either side gives NULL."""
    code, historic = as_column(code), as_column(historic)
    return if_else(code != historic, historic, code)


def with_denominator_suffix(indicator: Column | str, nd: Column | str) -> Column:
    """``TX_PVLS`` with ``D`` becomes ``TX_PVLS_D``; an unknown side gives NULL."""
    return if_else(as_column(nd) == "D", F.concat(as_column(indicator), F.lit("_D")), as_column(indicator))


def agency_short_name(c: Column | str, names: Mapping[str, str]) -> Column:
    """Short agency names (``HHS/CDC`` to ``CDC`` and the like)."""
    return recode(c, names)


def official_names(df: DataFrame, official: DataFrame, code: str = "mech_code", columns: Mapping[str, str] | None = None) -> DataFrame:
    """Replace mechanism and partner names by the official list, keyed on mechanism code."""
    columns = columns or {"mech_name": "mech_name_official", "prime_partner_name": "prime_partner_official"}
    present = {old: new for old, new in columns.items() if old in df.columns}
    return overwrite(df, official, [code], present)


def disaggregate_type(age: Column | str, sex: Column | str, no_age: str = "No age disagg", no_sex: str = "No sex disagg") -> Column:
    """Which disaggregates a row carries: Total, Sex, Age or Age/Sex."""
    a, s = as_column(age) == no_age, as_column(sex) == no_sex
    return (
        F.when(a & s, F.lit("Total")).when(a & ~s, F.lit("Sex")).when(~a & s, F.lit("Age")).when(~a & ~s, F.lit("Age/Sex"))
    )


def coarse_age(band: Column | str) -> Column:
    """``<15`` or ``15+`` from the bounds of a band such as ``05-09``, ``<01`` or ``65+``, else NULL."""
    band = as_column(band)
    low = F.regexp_extract(band, r"^(\d+)(?:-\d+|[+])$", 1).try_cast("int")
    high = F.regexp_extract(band, r"^\d+-(\d+)$", 1).try_cast("int")
    below = F.regexp_extract(band, r"^<(\d+)$", 1).try_cast("int")
    return F.when((high < 15) | (below <= 15), F.lit("<15")).when(low >= 15, F.lit("15+"))


def coarse_age_from_number(age: Column | str) -> Column:
    """``<15`` or ``15+`` from a single-year age given as text."""
    n = as_column(age).try_cast("double")
    return F.when(n < 15, F.lit("<15")).when(n >= 15, F.lit("15+"))


def flagged_members(df: DataFrame, members: DataFrame, on: Sequence[str], name: str = "flag") -> DataFrame:
    """Membership flag from a key table, without collecting it."""
    marked = members.select(*on).distinct().withColumn(name, F.lit(True))
    return match(df, marked, on, "left", null_safe=True).withColumn(name, F.coalesce(F.col(name), F.lit(False)))

