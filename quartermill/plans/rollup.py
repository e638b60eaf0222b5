"""A stored aggregate of the fact: sums at a fine grain by quarter, written once per year.

Coarser questions are answered from it, since sums of sums are sums. It lies in
yearly folders with a manifest (:mod:`quartermill.sources.vintages`): only open years are
rebuilt, and a reader never sees half of a rebuild.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermill.sources.vintages import current, read_years, replace_years

GRAIN = ("fiscal_year", "quarter")


def build(rows: DataFrame, path: str, dims: Sequence[str], measures: Sequence[str], years: Iterable[int]) -> int:
    """Sum the fact rows of some years at the grain of ``dims`` and quarter, and put them in place."""
    years = sorted(set(years))
    kept = rows.filter(F.col("fiscal_year").isin(years))
    summed = kept.groupBy(*dims, *GRAIN).agg(*[F.sum(m).alias(m) for m in measures], F.count(F.lit(1)).alias("n_rows"))
    return replace_years(summed, path, years)


def refresh(rows: DataFrame, path: str, dims: Sequence[str], measures: Sequence[str], open_years: Iterable[int]) -> int:
    """Rebuild the open years and any that the rollup lacks; closed years are not read.

    ``rows`` should be filtered by year at its scan, which the filter here is pushed to.
    """
    _, stored = current(rows.sparkSession, path)
    if not stored:
        raise FileNotFoundError(f"no rollup in {path}")
    return build(rows, path, dims, measures, open_years)


def answer(spark: SparkSession, path: str, dims: Sequence[str], measures: Sequence[str], years: Iterable[int] | None = None) -> DataFrame:
    """Sums at a coarser grain, read from the rollup only: ``dims`` and quarters it holds, fewer years if given.

    The number of fact rows behind a sum comes as ``n_rows``.
    """
    stored = read_years(spark, path, years)
    absent = [c for c in (*dims, *measures) if c not in stored.columns]
    if absent:
        raise ValueError(f"the rollup does not hold {absent}")
    return stored.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in (*measures, "n_rows")])
