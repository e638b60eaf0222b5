"""Shared helpers: frames that keep their other columns, Arrow text buffers, shared storage."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A folder of our own is set only where neither that setting nor a checkpoint
    folder is there, and only in a local session; a cluster without it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="quartermill-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Compute a frame once, in the shared folder, and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


PART = 4 << 20


def parts_of(batch: pa.RecordBatch, text: str) -> list[pa.RecordBatch]:
    """A batch in parts of about ``PART`` bytes of a text column; a longer text is a part of its own."""
    _, offsets, _ = text_buffer(batch.column(batch.schema.names.index(text)))
    return [batch.slice(a, b - a) for a, b in slices(offsets, PART)]


def extend(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], list], text: str) -> DataFrame:
    """Add the columns of ``schema``, which ``fn`` makes for parts of Arrow batches.

    Parts are of bounded size by the column ``text``, so memory does not follow the batch.

    Every other column passes through. An input column that has the name of an
    output (in any case) is replaced by the output.
    """
    added = T.StructType.fromDDL(schema)
    names = {f.name.lower() for f in added.fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    # Inputs that an output replaces still reach ``fn``, behind the kept ones.
    given = [f.name for f in [*kept, *(f for f in df.schema.fields if f.name.lower() in names)]]
    n, out_names = len(kept), [f.name for f in [*kept, *added.fields]]

    def run(batches):
        for batch in batches:
            for part in parts_of(batch.rename_columns(given), text):
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *fn(part)], names=out_names)

    # Plain names on the way in, since the call can't take names with dots.
    plain = df.select(*[F.col(quoted(name)).alias(f"c{k}") for k, name in enumerate(given)])
    return plain.mapInArrow(run, T.StructType([*kept, *added.fields]))


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, ``n + 1`` offsets and null mask of a string column; nulls have no bytes."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, bool)
    null = np.asarray(column.is_null())
    if null.any():
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0], null


def slices(offsets: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    out, first, n = [], 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        out.append((first, last))
        first = last
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of several ranges, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)


def list_array(values: pa.Array, lengths) -> pa.ListArray:
    """A list column from its flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def runs(batches, keys: int):
    """Arrow tables of the groups in sorted batches; the first ``keys`` columns tell groups apart."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        table = table.combine_chunks()
        new = np.zeros(table.num_rows, bool)
        for k in range(keys):
            v = table.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        edges = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(edges, edges[1:]):
            yield table.slice(a, b - a)
        held = table.slice(edges[-1])
    if held is not None and held.num_rows:
        yield held


def grouped(df: DataFrame, keys: list[str], solve, schema: str) -> DataFrame:
    """``solve(table)`` of every group of ``keys`` (longs, not null), many groups to a task."""
    n = len(keys)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for group in runs(batches, n):
            arrays = solve(group)
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=names)

    rest = [c for c in df.columns if c not in keys]
    return df.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
