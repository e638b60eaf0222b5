"""Yearly extracts that are replaced whole or not at all.

Data lie in a new folder for every write; a manifest says which folder holds which year.
A manifest is one small file, published by a single rename when its write is done, and
never changed. So a reader sees the years of the newest manifest only, and a write that
breaks off half-way leaves a folder that no manifest names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, year int, folder string"


def _manifests(spark: SparkSession, path: str) -> DataFrame:
    """Every manifest row ever published below a folder; none yet if there is no manifest."""
    found = spark.read.schema(MANIFEST).option("pathGlobFilter", "part-*").option("recursiveFileLookup", True)
    return found.json(f"{path}/manifests")


def current(spark: SparkSession, path: str) -> tuple[int, dict[int, str]]:
    """The newest version and its folder of each year (a row per year reaches the driver)."""
    manifests = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        if manifests.load(f"{path}/manifests").isEmpty():
            return 0, {}
    except Exception as e:  # noqa: BLE001 - no folder yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return 0, {}
    rows = _manifests(spark, path)
    newest = rows.where(F.col("version") == rows.agg(F.max("version")).scalar()).collect()
    return newest[0]["version"], {r["year"]: r["folder"] for r in newest}


def replace_years(df: DataFrame, path: str, years: Iterable[int], year: str = "fiscal_year") -> int:
    """Replace the given years by the rows that ``df`` has of them; other years stay as they are.

    A year without rows becomes empty. The years are visible together, once everything
    is written. Returns the new version. Writers take turns: of two at a time, the one
    that publishes last wins, with the years it had seen.
    """
    spark, years = df.sparkSession, sorted(set(years))
    version, folders = current(spark, path)
    staged = f"data/{uuid.uuid4().hex}"
    rows = df.filter(F.col(year).isin(years)).hint("rebalance", year)
    rows.write.partitionBy(year).parquet(f"{path}/{staged}")
    written = {r[0] for r in spark.read.parquet(f"{path}/{staged}").select(year).distinct().collect()} if _has_rows(spark, f"{path}/{staged}") else set()
    folders = {y: f for y, f in folders.items() if y not in years}
    folders |= {y: f"{staged}/{year}={y}" for y in years if y in written}
    table = spark.createDataFrame([(version + 1, y, f) for y, f in sorted(folders.items())] or [(version + 1, None, None)], MANIFEST)
    table.coalesce(1).write.json(f"{path}/manifests/{version + 1:012d}-{uuid.uuid4().hex}")
    return version + 1


def _has_rows(spark: SparkSession, folder: str) -> bool:
    """Whether a write left any data file (an empty one leaves none)."""
    return not spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder).isEmpty()


def read_years(spark: SparkSession, path: str, years: Iterable[int] | None = None, year: str = "fiscal_year") -> DataFrame:
    """The rows of the newest version, of all years or of some; only folders of those years are listed."""
    version, folders = current(spark, path)
    wanted = [(y, f) for y, f in sorted(folders.items()) if y is not None and (years is None or y in set(years))]
    if not wanted:
        raise FileNotFoundError(f"version {version} of {path} has no rows of these years")
    # A folder is named by its year, which comes back as a column.
    label = F.regexp_extract(F.col("_metadata.file_path"), rf"/{year}=(\d+)/[^/]*$", 1).cast("int")
    return spark.read.parquet(*[f"{path}/{f}" for _, f in wanted]).withColumn(year, label)
