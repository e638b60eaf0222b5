"""Removal of passages that already stand in another document.

Anchors are hashes of short runs of words at the positions of a difference cover: for
any two offsets there is a shift, below the period, that puts both on the cover. So
two texts that share a long enough window share an anchor inside it, at cover
positions of both, though only one position in five is hashed. Only where an anchor
also stands in another document are windows hashed at all, so the table of windows
follows the repeats, not the corpus. An extension is then exact: a window belongs to
the smallest document that starts it, and all others lose it.

Exact copies are one text here: only the row with the smallest id takes part, and a
text that has a window goes whole from the other rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermill.llm.common import ensure_checkpoint_dir, grouped, list_array, parts_of, quoted, ranges, text_buffer
from quartermill.llm.slots import bitmap, passes
from quartermill.llm.wordcodes import Sequences, byte_class, word_codes, word_spans

#: Perfect difference sets: every difference modulo the period, each but 0 once. Fixed values.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18)}
BLANK = byte_class(b" \t\n\x0b\x0c\r")


def cover_of(window: int) -> tuple[int, tuple[int, ...]]:
    """Period and cover for windows of so many words: the anchors keep a third of them at least."""
    period = max(p for p in COVERS if p <= max(1, (window + 1) * 2 // 3))
    return period, COVERS[period]


class Words:
    """The words of the texts of a batch, as hashes; ``place`` is a word's number in its text."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets, self.null = text_buffer(column)
        self.starts, self.ends = word_spans(self.data, self.offsets, BLANK)
        self.doc = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=len(column))
        self.first = np.cumsum(self.counts) - self.counts
        self.place = np.arange(len(self.doc)) - self.first[self.doc]
        #: Words of the text from this one on.
        self.left = self.counts[self.doc] - self.place

    def sequences(self, lane: int) -> Sequences:
        return Sequences(word_codes(self.data, self.starts, self.ends, lane), lane)

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray, Sequences]:
        """Positions on the cover and the hashes there, in texts that have a window."""
        period, cover = cover_of(window)
        length = window - period + 1
        on = np.isin(np.arange(period), cover)
        at = np.flatnonzero(on[self.place % period] & (self.left >= length) & (self.counts[self.doc] >= window))
        sequences = self.sequences(0)
        return at, sequences.at(at, length), sequences

    def candidates(self, window: int, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the windows that hold a shared anchor, and two hashes of each."""
        period, _ = cover_of(window)
        at, hashes, sequences = self.anchors(window)
        at = at[passes(shared, hashes)]
        reach = np.zeros(len(self.doc) + 1, np.int32)
        np.add.at(reach, np.maximum(at - period + 1, self.first[self.doc[at]]), 1)
        np.add.at(reach, at + 1, -1)
        starts = np.flatnonzero((np.cumsum(reach[:-1]) > 0) & (self.left >= window))
        return starts, sequences.at(starts, window), self.sequences(1).at(starts, window)


def own(batch: pa.RecordBatch, first) -> pa.RecordBatch:
    """Rows that stand for their text (and a few others, which only cost time)."""
    return batch.filter(pa.array(passes(first.value, batch.column(1).to_numpy())))


def anchor_hashes(texts: DataFrame, window: int, first) -> DataFrame:
    """Hashes of the anchors that stand in two documents or more."""
    def run(batches):
        for batch in batches:
            for part in parts_of(batch, "text"):
                part = own(part, first)
                words = Words(part.column(2))
                at, hashes, _ = words.anchors(window)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), part.column(0).take(pa.array(words.doc[at]))], names=["hash", "id"])

    rows = texts.select("id", "row", "text").mapInArrow(run, T.StructType([T.StructField("hash", T.LongType()), texts.schema["id"]]))
    return rows.groupBy("hash").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").select("hash")


def window_rows(texts: DataFrame, window: int, first, shared) -> DataFrame:
    """(h1, h2, id, k1, k2, place) of every window that may repeat."""
    def run(batches):
        for batch in batches:
            for part in parts_of(batch, "text"):
                part = own(part, first)
                words = Words(part.column(4))
                at, h1, h2 = words.candidates(window, shared.value)
                doc = pa.array(words.doc[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), *[part.column(k).take(doc) for k in (0, 2, 3)], pa.array(words.place[at])],
                    names=out.names)

    out = T.StructType([LONG("h1"), LONG("h2"), texts.schema["id"], LONG("k1"), LONG("k2"), LONG("place")])
    return texts.select("id", "row", "k1", "k2", "text").mapInArrow(run, out)


def spans_of(rows: DataFrame, window: int) -> DataFrame:
    """Repeated windows (k1, k2, place) as one row per text: merged spans of words."""
    def solve(table):
        place = np.unique(table.column("place").to_numpy())
        new = np.concatenate([[True], place[1:] > place[:-1] + window])
        starts, stops = place[new], place[np.append(new[1:], True)] + window
        spans = pa.StructArray.from_arrays([pa.array(starts), pa.array(stops)], names=["start", "stop"])
        return [table.column(k).to_numpy()[:1] for k in ("k1", "k2")] + [list_array(spans, [len(starts)])]

    return grouped(rows.select("k1", "k2", "place"), ["k1", "k2"], solve, "k1 long, k2 long, spans array<struct<start:long,stop:long>>")


def LONG(name: str) -> T.StructField:  # noqa: N802
    return T.StructField(name, T.LongType())


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
ADDED = [
    T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("removal", T.ArrayType(SPAN)), T.StructField("kept_text", T.StringType()),
]


def without_spans(column: pa.Array, spans: pa.Array | None, whole: pa.Array | None, window: int) -> list[pa.Array]:
    """The added columns for texts and what they lose: spans of words, or all of a text with a window."""
    words = Words(column)
    kept = np.ones(len(words.doc), bool)
    if spans is None:
        spans = pa.array([None] * len(column), SPANS)
    if whole is not None:
        gone = whole.to_numpy(zero_copy_only=False) & (words.counts >= window)
        kept[gone[words.doc]] = False
        everything = pa.StructArray.from_arrays([pa.array(np.zeros(len(column), np.int64)), pa.array(words.counts.astype(np.int64))], names=["start", "stop"])
        spans = pa.compute.if_else(pa.array(gone), list_array(everything, np.ones(len(column), np.int64)).cast(SPANS), spans.cast(SPANS))
    flat, owner = spans.flatten(), np.repeat(np.arange(len(spans)), pa.compute.list_value_length(spans).fill_null(0).to_numpy())
    if len(flat):
        starts, stops = (words.first[owner] + flat.field(k).to_numpy() for k in (0, 1))
        kept[ranges(starts, stops - starts)] = False
    doc, starts = words.doc[kept], words.starts[kept]
    # One blank before each word but a text's first.
    led = np.zeros(len(doc), np.int64)
    led[1:] = doc[1:] == doc[:-1]
    sizes = words.ends[kept] - starts + led
    text = words.data[ranges(starts - led, sizes)]
    text[(np.cumsum(sizes) - sizes)[led == 1]] = 32
    offsets = np.zeros(len(column) + 1, np.int64)
    np.cumsum(np.bincount(doc, sizes, len(column)).astype(np.int64), out=offsets[1:])
    lost = words.counts - np.bincount(doc, minlength=len(column))
    clean = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(offsets), pa.py_buffer(text)).cast(pa.string())
    return [
        pa.array(words.counts.astype(np.int64)), pa.array(lost.astype(np.int64)), pa.compute.if_else(spans.is_null(), pa.scalar([], spans.type), spans),
        pa.compute.if_else(pa.array(words.null), pa.scalar(None, pa.string()), clean),
    ]


def drop_repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = 50) -> DataFrame:
    """Texts without the words of every window that also starts in a document of a smaller id.

    Words are runs of anything but blanks (``[^\\x20\\x09-\\x0D]+``), a window is
    ``window`` consecutive words of one text, judged on the input. Adds ``n_words``,
    ``n_removed``, ``removal`` (merged spans of word numbers, from 0, stop excluded) and
    ``kept_text`` (kept words joined by one blank). Empty texts and those below a window
    lose nothing; a null text has no words and stays null. A row without an id gives no
    one a repeat and loses nothing. Rows of one id don't repeat each other; each row is
    judged on its own. Texts are taken whole. Other columns pass through, save those
    named like an output. Memory follows the longest text (about 30 bytes per byte).
    """
    spark = docs.sparkSession
    key, body = F.col(quoted(doc_id)), F.col(quoted(text))
    # Two hashes of the text tell texts apart.
    k1, k2 = F.xxhash64(body), F.xxhash64(F.lit(text), body)
    texts = docs.select(key.alias("id"), F.xxhash64(key, k1, k2).alias("row"), k1.alias("k1"), k2.alias("k2"), body.alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")

    folder = f"{ensure_checkpoint_dir(spark)}/windows-{uuid.uuid4().hex}"

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    copies = stored(texts.groupBy("k1", "k2").agg(F.min("id").alias("least"), F.max("id").alias("most")), "copies")
    first = spark.sparkContext.broadcast(bitmap(copies.select(F.xxhash64("least", "k1", "k2").alias("row")), "row"))
    shared = spark.sparkContext.broadcast(bitmap(anchor_hashes(texts, window, first), "hash"))
    every = stored(window_rows(texts, window, first, shared), "all")
    owned = every.groupBy("h1", "h2").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most")
    repeats = every.join(stored(owned.select("h1", "h2", "least"), "owned"), ["h1", "h2"]).filter("id > least")
    spans = spans_of(repeats, window)
    losing = stored(copies.filter("least < most").select("k1", "k2", "least").join(spans, ["k1", "k2"], "full"), "losing")
    losers = spark.sparkContext.broadcast(bitmap(losing, "k1"))

    # Only texts that lose words are shuffled to meet what they lose.
    names = {f.name for f in ADDED}
    kept = [f for f in docs.schema.fields if f.name.lower() not in names]
    n = len(kept)
    columns = [F.col(quoted(f.name)).alias(f"c{k}") for k, f in enumerate(kept)]
    at = next((k for k, f in enumerate(kept) if f.name == text), n)
    if at == n:  # an output takes its name
        columns.append(body.alias(f"c{n}"))
    plain = docs.select(k1.alias("k1"), k2.alias("k2"), key.alias("id"), *columns)

    def halves(batches, which):
        for batch in batches:
            for part in parts_of(batch, f"c{at}"):
                yield part.filter(pa.array(passes(losers.value, part.column(0).to_numpy()) == which))

    def untouched(batches):
        for part in halves(batches, False):
            yield pa.RecordBatch.from_arrays([*part.columns[3 : n + 3], *without_spans(part.column(at + 3), None, None, window)], names=out.names)

    def touched(batches):
        yield from halves(batches, True)

    def cut(batches):
        for batch in batches:
            for part in parts_of(batch, f"c{at}"):
                yield pa.RecordBatch.from_arrays([*part.columns[2 : n + 2], *without_spans(part.column(at + 2), part.column(0), part.column(1), window)], names=out.names)

    out = T.StructType([*kept, *ADDED])
    met = plain.mapInArrow(touched, plain.schema).join(losing, ["k1", "k2"], "left")
    later = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    met = met.select(F.when(F.col("id").isNotNull() & ~later, F.col("spans")).alias("spans"), later.alias("whole"), *plain.columns[3:])
    return plain.mapInArrow(untouched, out).unionByName(met.mapInArrow(cut, out))
