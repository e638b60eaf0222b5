"""Exact line de-duplication through a sharded minimal perfect hash.

The first pass hashes the key of every line and counts, per key, the documents
that hold it and the largest document id. Keys that repeat often enough are dealt
into shards; each shard builds a minimal perfect hash over its keys and compact
arrays of fingerprints, counts and owners, addressed by the hash. The second pass
looks the lines of each document up in these arrays.

An index up to ``broadcast_bytes`` goes to every task. A larger one stays sharded:
line hashes are sent to their shard (split into groups of bounded size by document and
line, so one very common line does not meet in a single task), and only the hits return
to the documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import cut, extend, text_buffer

#: Stripped from both ends of a line to get its key: space and the five controls 0x09 to 0x0D.
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
KEYS_PER_SHARD = 1 << 18
LINES_PER_GROUP = 1 << 20
BROADCAST_BYTES = 32 << 20
PAIR = np.dtype([("h1", "<i8"), ("h2", "<i8")])


def line_hashes(text: bytes, min_chars: int) -> tuple[list[bytes], list[int], np.ndarray]:
    """Lines, indices of those with a long enough key, and the 128-bit hashes of these keys."""
    lines = text.split(b"\n")
    at, digests = [], []
    for k, line in enumerate(lines):
        if len(line) < min_chars:
            continue
        key = line.strip(BLANK).lower()
        if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
            at.append(k)
            digests.append(xxhash.xxh3_128_digest(key))
    return lines, at, np.frombuffer(b"".join(digests), PAIR)


def mixed(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    """A hash of the pair for one level of the perfect hash."""
    x = h1.view(np.uint64) ^ (h2.view(np.uint64) * np.uint64(2 * level + 1))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class LineIndex:
    """A minimal perfect hash over distinct pairs, with arrays addressed by it.

    Level by level, keys that are alone at their position of a bit array take it; the
    others go on to the next level. A key's number is the count of bits before its own.
    """

    def __init__(self, bits: list[np.ndarray], fingerprints: np.ndarray, counts: np.ndarray, owners: np.ndarray):
        self.bits, self.fingerprints, self.counts, self.owners = bits, fingerprints, counts, owners
        self.before, total = [], 0
        for b in bits:
            self.before.append(np.cumsum(b, dtype=np.int64) - b + total)
            total += int(b.sum())

    @staticmethod
    def build(h1, h2, counts, owners, gamma: float = 1.6) -> "LineIndex":
        """The index of distinct keys."""
        bits, left = [], np.arange(len(h1))
        while len(left):
            size = max(2, int(gamma * len(left)))
            at = (mixed(h1[left], h2[left], len(bits)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone)
            left = left[~alone[at]]
        index = LineIndex(bits, h2, counts, owners)
        order = np.empty(len(h1), np.int64)
        order[index.number(h1, h2)] = np.arange(len(h1))
        return LineIndex(bits, h2[order], counts[order], owners[order])

    def number(self, h1, h2) -> np.ndarray:
        """The number of each key; -1 or another key's for keys that are not there."""
        out, left = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, (bits, before) in enumerate(zip(self.bits, self.before)):
            if not len(left):
                break
            at = (mixed(h1[left], h2[left], level) % np.uint64(len(bits))).astype(np.int64)
            here = bits[at]
            out[left[here]] = before[at[here]]
            left = left[~here]
        return out

    def probe(self, h1, h2) -> np.ndarray:
        """The number of each key, -1 where its fingerprint is not there."""
        number = self.number(h1, h2)
        if not len(self.fingerprints):
            return number
        return np.where((number >= 0) & (self.fingerprints[number] == h2), number, -1)

    def pack(self) -> tuple[list[int], bytes, bytes, bytes, bytes]:
        """Level sizes, bits, fingerprints, counts and owners."""
        bits = b"".join(np.packbits(b).tobytes() for b in self.bits)
        return [len(b) for b in self.bits], bits, self.fingerprints.tobytes(), self.counts.astype("<i8").tobytes(), self.owners.tobytes()

    @staticmethod
    def unpack(sizes, bits, fingerprints, counts, owners) -> "LineIndex":
        """The index from its packed form."""
        raw, out, at = np.frombuffer(bits, np.uint8), [], 0
        for n in sizes:
            out.append(np.unpackbits(raw[at : at + -(-n // 8)], count=n).astype(bool))
            at += -(-n // 8)
        return LineIndex(out, *(np.frombuffer(x, "<i8") for x in (fingerprints, counts, owners)))


def count_lines(docs: DataFrame, doc: str, text: str, min_chars: int) -> DataFrame:
    """One row per document and distinct key: ``h1``, ``h2`` and ``doc``."""

    def run(batches):
        for batch in batches:
            data, offsets, _ = text_buffer(batch.column(1))
            raw, at, owners, found = data.tobytes(), offsets.tolist(), [], []
            for k in range(len(batch)):
                keys = np.unique(line_hashes(raw[at[k] : at[k + 1]], min_chars)[2])
                found.append(keys)
                owners.append(len(keys))
            keys = np.concatenate(found) if found else np.zeros(0, PAIR)
            rows = np.repeat(np.arange(len(batch)), owners)
            yield pa.RecordBatch.from_arrays([pa.array(keys["h1"]), pa.array(keys["h2"]), batch.column(0).take(pa.array(rows))], names=["h1", "h2", "doc"])

    return docs.select(F.col(doc).cast("long").alias("doc"), F.col(text)).mapInArrow(run, "h1 long, h2 long, doc long")


def build_index(docs: DataFrame, doc: str, text: str, min_chars: int, min_docs: int, keys_per_shard: int) -> DataFrame:
    """One row per shard with the packed index of keys found in ``min_docs`` documents or more.

    The largest id of a key is over its non-null ids; a null id counts as one document.
    """
    per_document = count_lines(docs, doc, text, min_chars).groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
    keys = cut(per_document.groupBy("h1", "h2").agg(F.count("one").alias("n"), F.max("doc").alias("owner")).filter(F.col("n") >= min_docs))
    shards = -(-keys.count() // keys_per_shard) or 1

    def pack(table):
        h1, h2, n, owner = (table.column(c).to_numpy() for c in ("h1", "h2", "n", "owner"))
        sizes, bits, fingerprints, counts, owners = LineIndex.build(h1, h2, n, owner).pack()
        return pa.table({
            "shard": [table.column("shard")[0].as_py()], "sizes": [sizes], "bits": [bits], "fingerprints": [fingerprints],
            "counts": [counts], "owners": [owners],
        }, schema=PACKED)

    dealt = keys.withColumn("owner", F.coalesce("owner", F.lit(-(2**63)))).withColumn("shard", F.pmod("h1", F.lit(shards)))
    return cut(dealt.groupBy("shard").applyInArrow(pack, PACKED_DDL)).withColumn("shards", F.lit(shards))


PACKED = pa.schema([
    ("shard", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("fingerprints", pa.binary()),
    ("counts", pa.binary()), ("owners", pa.binary()),
])
PACKED_DDL = "shard long, sizes array<long>, bits binary, fingerprints binary, counts binary, owners binary"


def rewrite(batch, text: str, find) -> list:
    """New texts, numbers of lines and of dropped lines.

    ``find(row numbers, hashes, document ids)`` tells which lines go.
    """
    data, offsets, _ = text_buffer(batch.column(batch.schema.names.index(text)))
    raw, at = data.tobytes(), offsets.tolist()
    parsed = []
    for k in range(len(batch)):
        parsed.append(find.hashes(raw[at[k] : at[k + 1]]))
    counts = [len(p[1]) for p in parsed]
    hashes = np.concatenate([p[2] for p in parsed]) if parsed else np.zeros(0, PAIR)
    gone = find(np.repeat(np.arange(len(batch)), counts), hashes, batch)
    kept, total, dropped, first = [], [], [], 0
    for (lines, where, _), n in zip(parsed, counts):
        out = {where[i] for i in np.flatnonzero(gone[first : first + n]).tolist()}
        first += n
        kept.append(b"\n".join(x for i, x in enumerate(lines) if i not in out) if out else b"\n".join(lines))
        total.append(len(lines))
        dropped.append(len(out))
    return [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())]


class ByIndex:
    """Decides by the shards' arrays."""

    def __init__(self, shards, packed, min_chars, doc):
        self.shards, self.packed, self.min_chars, self.doc, self.indexes = shards, packed, min_chars, doc, None

    def hashes(self, text):
        return line_hashes(text, self.min_chars)

    def __call__(self, rows, hashes, batch):
        if self.indexes is None:
            self.indexes = {shard: LineIndex.unpack(*rest) for shard, *rest in self.packed.value}
        ids = batch.column(batch.schema.names.index(self.doc)).cast(pa.int64())
        null = np.asarray(ids.is_null())[rows]
        ids = ids.fill_null(0).to_numpy()[rows]
        gone = np.zeros(len(rows), bool)
        of = hashes["h1"] % self.shards
        for shard, index in self.indexes.items():
            mine = np.flatnonzero(of == shard)
            number = index.probe(np.ascontiguousarray(hashes["h1"][mine]), np.ascontiguousarray(hashes["h2"][mine]))
            mine, number = mine[number >= 0], number[number >= 0]
            gone[mine] = null[mine] | (index.owners[number] != ids[mine])
        return gone


class ByList:
    """Decides by the list of hashes that were found for the document."""

    def __init__(self, min_chars):
        self.min_chars = min_chars

    def hashes(self, text):
        return line_hashes(text, self.min_chars)

    def __call__(self, rows, hashes, batch):
        lists = batch.column(batch.schema.names.index("__gone")).fill_null([])
        gone = [set(x) for x in lists.to_pylist()]
        return np.array([h in gone[r] for r, h in zip(rows.tolist(), (hashes["h1"] ^ hashes["h2"]).tolist())], bool)


def probe_shards(docs: DataFrame, index: DataFrame, shards: int, doc: str, text: str, min_chars: int, group: int) -> DataFrame:
    """Hits per document (``__doc``, ``__gone``) from lines sent to their shard.

    A shard's lines, those that occur once included, are counted first and dealt over as
    many salts as leave half of ``group`` to each on average. They are dealt by document
    and line, each pair once, so that neither a common line, a long document nor an id of
    many rows gathers in one group.
    """
    lines = count_lines(docs, doc, text, min_chars).withColumn("shard", F.pmod("h1", F.lit(shards)))
    counts = lines.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    # Lines of shards with no keys at all can't hit.
    salts = F.broadcast(cut(counts.join(index.select("shard"), "shard").select("shard", F.ceil(2 * F.col("n") / group).cast("long").alias("salts"))))
    dealt = lines.distinct().join(salts, "shard").withColumn("salt", F.pmod(F.xxhash64("doc", "h1", "h2"), "salts")).drop("salts")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))
    copies = index.drop("shards").join(salts, "shard").withColumn("salt", each).drop("salts")

    def look(left, right):
        if not right.num_rows or not left.num_rows:
            return pa.table({"__doc": pa.array([], pa.int64()), "__hash": pa.array([], pa.int64())})
        one = right.slice(0, 1).to_pylist()[0]
        found = LineIndex.unpack(*(one[c] for c in ("sizes", "bits", "fingerprints", "counts", "owners")))
        h1, h2 = left.column("h1").to_numpy(), left.column("h2").to_numpy()
        ids = left.column("doc")
        number = found.probe(h1, h2)
        owner = found.owners[np.maximum(number, 0)]
        gone = (number >= 0) & (np.asarray(ids.is_null()) | (owner != ids.fill_null(0).to_numpy()))
        return pa.table({"__doc": ids.filter(pa.array(gone)), "__hash": pa.array((h1 ^ h2)[gone])})

    hits = dealt.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInArrow(look, "__doc long, __hash long")
    return hits.distinct().groupBy("__doc").agg(F.collect_list("__hash").alias("__gone"))


def drop_repeated_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3,
                        keys_per_shard: int = KEYS_PER_SHARD, broadcast_bytes: int = BROADCAST_BYTES, group: int = LINES_PER_GROUP) -> DataFrame:
    r"""Drop lines that ``min_docs`` documents or more hold, except in the largest id that holds them.

    A text is split at ``\n``; a line's key is the line without blanks at both ends
    and with A-Z lower-cased. Keys of fewer than ``min_chars`` code points never go.
    The text becomes the other lines, joined; ``n_lines`` and ``n_dropped`` are added.
    A null or empty text is one empty line (and becomes empty text). Rows that repeat
    a document id are one document: each keeps or loses the same lines. A row without an
    id loses every line whose key is repeated (all such rows count as one document, and
    with ``min_docs=1`` a line of one of them counts as repeated). Empty tables
    give no rows; other columns pass through, save those named like an output.
    """
    spark = docs.sparkSession
    index = build_index(docs, doc, text, min_chars, min_docs, keys_per_shard)
    size = index.agg(
        F.sum(sum((F.octet_length(c) for c in ("bits", "fingerprints", "counts", "owners")), F.lit(0))), F.max("shards")
    ).first()
    schema = f"`{text}` string, n_lines long, n_dropped long"
    if (size[0] or 0) <= broadcast_bytes:
        rows = [tuple(r) for r in index.select("shard", "sizes", "bits", "fingerprints", "counts", "owners").collect()]
        find = ByIndex(size[1] or 1, spark.sparkContext.broadcast(rows), min_chars, doc)
        return extend(docs, schema, lambda batch: rewrite(batch, text, find), text)
    hits = probe_shards(docs, index, size[1], doc, text, min_chars, group)
    find = ByList(min_chars)
    joined = docs.join(hits, docs[doc].cast("long").eqNullSafe(hits["__doc"]), "left").drop("__doc")
    return extend(joined, schema, lambda batch: rewrite(batch, text, find), text).drop("__gone")
