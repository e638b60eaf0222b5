"""Sinks: delimited text, one folder per partner, findings by level."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def dated_name(stem: str, period: str | None = None, day: dt.date | None = None) -> str:
    """``2024-05-01_stem_FY24Q2`` for an output folder."""
    parts = [(day or dt.date.today()).isoformat(), stem] + ([period] if period else [])
    return "_".join(parts)


def write_delimited(df: DataFrame, path: str, sep: str = "\t", mode: str = "error") -> None:
    """Delimited text with a header; NULL is written as an empty field."""
    df.write.mode(mode).option("header", True).option("sep", sep).option("nullValue", "").option("emptyValue", "").csv(path)


def write_by_key(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet", mode: str = "error", max_rows: int = 5_000_000) -> None:
    """One folder per key (partner, mechanism or level) in a single write.

    Rows are rebalanced by key: a small partner ends in one file, and a partner
    with most of the rows is split over several tasks by adaptive execution.
    """
    writer = df.hint("rebalance", *keys).write.mode(mode).option("maxRecordsPerFile", max_rows).partitionBy(*keys)
    if fmt == "csv":
        writer = writer.option("header", True).option("nullValue", "").option("emptyValue", "")
    writer.format(fmt).save(path)


def write_findings(df: DataFrame, path: str, fmt: str = "csv", mode: str = "error") -> None:
    """Data-quality findings, one folder per level."""
    write_by_key(df, path, ["level"], fmt=fmt, mode=mode)


def write_ranked(df: DataFrame, path: str, order: Sequence[Column | str], parts: int | None = None) -> None:
    """Rows in a total order over many files, for :func:`read_ranked`.

    Ranges of the order are dealt to tasks and sorted there; no task sees all rows.
    ``order`` should hold tie-breakers, which also split a value that most rows share.
    """
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.parquet(path)


def read_ranked(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The rows of :func:`write_ranked` with their position (from 1) in the order.

    A file's name carries its range's number and a row knows its place in the file, so a
    position is that place plus the rows of all files before, a sum of one number per file.
    """
    rows = spark.read.parquet(path)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int")
    counts = spark.read.parquet(path).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.agg(F.collect_list(F.struct("part", "n"))).scalar()
    numbered = rows.select("*", part.alias("__part"), F.col("_metadata.row_index").alias("__row"), sizes.alias("__sizes"))
    before = F.aggregate(F.filter("__sizes", lambda s: s["part"] < F.col("__part")), F.lit(0).cast("long"), lambda total, s: total + s["n"])
    return numbered.withColumn(position, before + F.col("__row") + 1).drop("__part", "__row", "__sizes")
