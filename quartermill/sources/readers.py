"""Readers: delimited text, many files in one scan, tagged sheets, latest file, JDBC, JSON grids."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermill.functions.semantics import strip_decimal_code, to_number
from quartermill.functions.selectors import clean_names
from quartermill.operators.joins import match
from quartermill.operators.setops import loose_append


def files_in(spark: SparkSession, path: str | list[str], pattern: str | None = None, deep: bool = False) -> list[tuple[str, object]]:
    """Paths and modification times of matching files; file sets are a few, so the driver holds their names."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if deep:
        reader = reader.option("recursiveFileLookup", True)
    return [(r[0], r[1]) for r in reader.load(path).select("path", "modificationTime").collect()]


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    sep: str = "\t",
    pattern: str | None = None,
    null: str = "",
    ignore_unknown: bool = False,
    allow_absent: bool = False,
    source: str | None = None,
) -> DataFrame:
    """Delimited text with a header, bound to the declared columns by name, file by file.

    ``pattern`` picks files by name. One job finds the header lines of all files; files
    with the same one are one scan, so yearly extracts with moved columns cost one more.
    A column that is not declared is an error unless ``ignore_unknown``; a declared one
    that a file lacks is an error unless ``allow_absent``, and NULL then. ``source`` adds
    the decoded file path. A header may hold quoted separators, but no line ends.
    """
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    types = {f.name: f for f in declared.fields}
    groups = header_groups(spark, path, pattern)
    if not groups:
        raise FileNotFoundError(f"nothing to read in {path}")
    text = spark.read.option("header", True).option("sep", sep).option("nullValue", null)
    parts = []
    for line, files in groups:
        names = next(csv.reader([line], delimiter=sep))
        unknown, absent = [n for n in names if n not in types], [n for n in types if n not in names]
        if unknown and not ignore_unknown:
            raise ValueError(f"{files[0]}: columns that are not declared: {unknown}")
        if absent and not allow_absent:
            raise ValueError(f"{files[0]}: declared columns that are absent: {absent}")
        own = T.StructType([types.get(n, T.StructField(n, T.StringType())) for n in names])
        rows = text.schema(own).csv(files)
        cells = [F.col(f"`{n}`") if n in names else F.lit(None).cast(f.dataType).alias(n) for n, f in types.items()]
        parts.append(rows.select(*cells, *([decoded_path().alias(source)] if source else [])))
    return loose_append(*parts)


def text_lines(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """Lines of text files with their file, their block's first byte and a number that rises within a block."""
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    return reader.text(path).select(
        "value", "_metadata.file_path", F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))


def header_groups(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> list[tuple[str, list[str]]]:
    """Header lines and the files that begin with them, found by one job.

    The first line of each file's first block is a partial minimum, so one short row per
    file is shuffled and nothing is sorted; one row per distinct header comes back. The
    pass reads the raw lines once, without parsing them. A mark of the byte order before
    a header is dropped, as the parser does.
    """
    lines = text_lines(spark, path, pattern).filter("at = 0")
    heads = lines.groupBy("file_path").agg(F.min_by("value", "n").alias("head"))
    heads = heads.withColumn("head", F.ltrim(F.col("head"), F.lit("\ufeff")))
    groups = heads.groupBy("head").agg(F.sort_array(F.collect_list(decoded("file_path"))).alias("files"))
    return sorted(((r[0], r[1]) for r in groups.collect()), key=lambda g: g[1])


def decoded(path: Column | str) -> Column:
    """A path without percent escapes; a plus sign stays one."""
    return F.url_decode(F.replace(F.col(path) if isinstance(path, str) else path, F.lit("+"), F.lit("%2B")))


def decoded_path() -> Column:
    """The file a row comes from, as :func:`decoded`."""
    return decoded("_metadata.file_path")


def entry_of(path: Column, folder: str) -> Column:
    """The entry of a folder that a file is, or is in: what follows the folder's whole path.

    Globs in the folder's path are matched as Spark does. An entry may have the folder's
    own name, at any depth.
    """
    body = re.sub(r"^[a-z][a-z0-9+.-]*:/*", "/", folder.rstrip("/"))
    # One folder per part of the path, a star for any name; then the entry itself.
    parts = [re.escape(p).replace(r"\*", "[^/]*").replace(r"\?", "[^/]") for p in body.split("/")]
    before = "^(?:[a-z][a-z0-9+.-]*:/*[^/]*)??" if body.startswith("/") else "^.*?/"
    return F.regexp_extract(path, before + "/".join(parts) + "/([^/]+)", 1)


def read_many(
    spark: SparkSession,
    path: str,
    pattern: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    source: str | None = None,
    merge: bool = False,
    sep: str = "\t",
    null: str = "",
) -> DataFrame:
    """Every file or file set of a folder that matches ``pattern``, as one scan (no union loop).

    ``source`` names a column with the matching entry of the folder: the file
    itself, or the directory its part files are in. ``merge`` unites differing
    columns, which reads every file's footer. Delimited text (``fmt="csv"``) has
    a header and is read by :func:`read_delimited`, so it needs a schema.
    """
    path = path.rstrip("/")
    entry = lambda full: entry_of(full, path)
    if fmt == "csv":
        if schema is None:
            raise ValueError("delimited text needs a schema")
        rows = read_delimited(spark, f"{path}/{pattern}", schema, sep, null=null, source="__path")
        return (rows.withColumn(source, entry(F.col("__path"))) if source else rows).drop("__path")
    reader = spark.read.format(fmt)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", merge)
    df = reader.load(f"{path}/{pattern}")
    return df.withColumn(source, entry(decoded_path())) if source else df


def latest_folder(spark: SparkSession, path: str, pattern: str = "part-*") -> str:
    """The folder with the newest matching file: an extract of several part files is read whole."""
    return latest_file(spark, path, pattern).rsplit("/", 1)[0]


def latest_file(spark: SparkSession, path: str, pattern: str) -> str:
    """Path of the newest matching file (modification time, then name)."""
    found = files_in(spark, path, pattern)
    if not found:
        raise FileNotFoundError(f"nothing matches {pattern!r} in {path}")
    return max(found, key=lambda f: (f[1], f[0]))[0]


def tagged_source(df: DataFrame, name: str, columns: Sequence[str], measure: str = "Total", code: str = "Code") -> DataFrame:
    """One source sheet: its columns by position, a source tag, measure as number, code without ``.0``."""
    out = df.toDF(*columns).withColumn("indicator", F.lit(name))
    if measure in columns:
        out = out.withColumn(measure, to_number(measure))
    if code in columns:
        out = out.withColumn(code, strip_decimal_code(F.col(code).cast("string")))
    return out


def tagged_union(sources: Mapping[str, tuple[DataFrame, Sequence[str]]], measure: str = "Total", code: str = "Code") -> DataFrame:
    """Stack several source sheets, each with its own column list; absent columns are NULL."""
    return loose_append(*[tagged_source(df, name, cols, measure, code) for name, (df, cols) in sources.items()])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict,
    where: str | None = None,
    columns: Sequence[str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Database table with filter and projection pushed to the source.

    ``split`` is (numeric column, lower bound, upper bound, partitions); without
    it Spark reads the table over one connection.
    """
    ranges = {}
    if split:
        ranges = dict(zip(("column", "lowerBound", "upperBound", "numPartitions"), split, strict=True))
    df = spark.read.jdbc(url, table, properties=properties, **ranges)
    if where:
        df = df.filter(where)
    return df.select(*columns) if columns else df


GRID_SCHEMA = "struct<listGrid:struct<headers:array<struct<column:string>>,rows:array<array<string>>>>"


def flatten_grid(df: DataFrame, json: str, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """A JSON grid (headers plus row arrays) to one row per grid row.

    Cells are found by header name, so documents may order their columns
    differently; a header a document lacks gives NULL.
    """
    parsed = df.select(*keep, F.from_json(F.col(json), GRID_SCHEMA)["listGrid"].alias("__grid"))
    headers = F.transform(F.col("__grid.headers"), lambda h: h["column"])
    rows = parsed.select(*keep, headers.alias("__headers"), F.explode("__grid.rows").alias("__row"))
    cells = []
    for c in columns:
        at = F.array_position(F.col("__headers"), F.lit(c)).cast("int")
        cells.append(F.when(at > 0, F.try_element_at(F.col("__row"), F.nullif(at, F.lit(0)))).alias(c))
    return rows.select(*keep, *cells)


def promote_header(spark: SparkSession, path: str, header_line: int, sep: str = ",", skip_after: int = 0, multiline: bool = False) -> DataFrame:
    """Text files whose names stand on a later line: skip to it, promote it, clean it.

    Lines are told apart by their place in their file, never by content: those up to
    the header and ``skip_after`` more go, for every file of a folder. All files must
    have the same header, which may hold quoted separators. Only the first few lines
    of a file are ever ranked; where they end is one number per file, joined to the
    lines, so nothing is sorted per file and compressed files cost no more.

    With ``multiline`` a quoted cell may hold line ends. Places then count records, and
    each file is parsed by one task, since only a reader from its beginning can tell
    where a quotation ends.
    """
    if multiline:
        wide = spark.read.option("sep", sep).option("multiLine", True).csv(path)
        cells = F.array(*[F.col(c) for c in wide.columns])
        lines = wide.select(cells.alias("value"), "_metadata.file_path", F.lit(0).alias("at"), F.monotonically_increasing_id().alias("n"))
    else:
        lines = text_lines(spark, path)
    first = lines.filter("at = 0")
    place = F.row_number().over(Window.partitionBy("file_path").orderBy("n"))
    few = first.withColumn("place", place).filter(F.col("place") <= header_line + skip_after)
    ends = few.groupBy("file_path").agg(F.max("n").alias("end"), F.max(F.when(F.col("place") == header_line, F.col("value"))).alias("head"))
    heads = [r[0] for r in ends.select("head").distinct().collect()]
    if len(heads) != 1 or heads[0] is None:
        raise ValueError(f"{path}: {len(heads)} different header lines")
    names = [(n or "").strip() for n in (heads[0] if multiline else next(csv.reader(heads, delimiter=sep)))]
    kept = match(lines, ends.drop("head"), ["file_path"], "left").filter((F.col("at") > 0) | (F.col("n") > F.col("end")))
    if multiline:
        rows = kept.filter(F.exists("value", lambda v: F.coalesce(F.trim(v) != "", F.lit(False))))
        return clean_names(rows.select(*[F.get("value", F.lit(i)).alias(n) for i, n in enumerate(names)]))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    cells = F.from_csv("value", schema, {"sep": sep, "mode": "PERMISSIVE"})
    return clean_names(kept.filter(F.trim("value") != "").select(cells.alias("row")).select("row.*").toDF(*names))
