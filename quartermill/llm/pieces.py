"""SentencePiece encoding and decoding with batched numpy steps.

A text becomes units: runs of the blank mark followed by other characters, which no
piece crosses. The distinct units of a batch are grouped by length and those of one
length advance together. Hashes of all their substrings are looked up among the sorted
hashes of the pieces, which gives a lattice of piece ids and scores; then

* a unigram model takes the path of the highest score: position by position, the best
  last piece of all units at once, with its start as the backpointer;
* a BPE model, for which the best path is not the model's own segmentation, merges the
  best-scoring neighbours of every unit until none is left, from the same lattice.

Characters without a piece become byte pieces. Models are read, never trained.
"""

from __future__ import annotations

import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermill.llm.common import extend, quoted, ranges, slices, text_buffer

MARK = "▁"
UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
#: The library's penalty for a character without a piece, below the least score.
UNKNOWN_PENALTY = 10.0
LONGEST = 64
SLICE = 1 << 20
TOKENS = 1 << 18
#: The cache of units is emptied beyond so many of them, or so many characters in them: a text without blanks is one unit.
CACHE = 1 << 19
CACHE_CHARS = 1 << 23
ODD = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """A model's pieces, ready for encoding and decoding."""

    def __init__(self, kind: int, rows: list[tuple[str, float, int]], prefix: bool):
        self.kind, self.prefix = kind, prefix
        self.texts = [p for p, _, _ in rows]
        self.types = [t for _, _, t in rows]
        self.ids = {p: k for k, (p, _, t) in enumerate(rows) if t in (NORMAL, USER)}
        self.scores = np.array([s for _, s, _ in rows], np.float64)
        self.unknown = next((k for k, t in enumerate(self.types) if t == UNKNOWN), 0)
        self.bytes = {int(p[1:-1], 16): k for k, (p, _, t) in enumerate(rows) if t == BYTE}
        self.byte_ids = np.array([self.bytes.get(k, -1) for k in range(128)])
        self.longest = max(map(len, self.ids), default=1)
        normal = [s for _, s, t in rows if t == NORMAL]
        self.least = (min(normal) if normal else 0.0) - UNKNOWN_PENALTY
        by_hash = sorted((self.hash(p), k) for p, k in self.ids.items())
        self.keys = np.array([h for h, _ in by_hash], np.uint64)
        self.values = np.array([k for _, k in by_hash], np.int64)
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("two pieces have the same hash")
        # Most substrings are no piece: their upper bits tell at once.
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.keys >> np.uint64(42)] = True
        self.forget()

    def forget(self) -> None:
        """Empty the cache: the number of each known unit, and the ids of unit k at ``pool[begins[k] : begins[k + 1]]``."""
        self.cache: dict[str, int] = {}
        self.held = 0
        self.pool, self.begins = np.zeros(0, np.int32), np.zeros(1, np.int64)

    @staticmethod
    def read(model: bytes) -> tuple:
        """What the constructor takes, from a model file's bytes.

        Models that change the text (a character map, joined or suffixed blanks, pieces
        across blanks) are refused, since units could not be encoded on their own.
        """
        from sentencepiece import sentencepiece_model_pb2

        m = sentencepiece_model_pb2.ModelProto()
        m.ParseFromString(model)
        rows = [(p.piece, p.score, p.type) for p in m.pieces]
        if m.normalizer_spec.precompiled_charsmap or m.normalizer_spec.remove_extra_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model normalises its input")
        if m.trainer_spec.model_type not in (UNIGRAM, BPE) or any(t == USER for _, _, t in rows):
            raise ValueError("only unigram and BPE models without user symbols")
        if any(MARK in p.lstrip(MARK) for p, _, t in rows if t == NORMAL):
            raise ValueError("a piece crosses a blank")
        return m.trainer_spec.model_type, rows, m.normalizer_spec.add_dummy_prefix

    @staticmethod
    def hash(piece: str) -> int:
        """Polynomial hash of the code points, as :meth:`lattice` extends it."""
        h = 0
        for c in piece:
            h = (h * int(ODD) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def lattice(self, chars: np.ndarray) -> np.ndarray:
        """Piece id of every substring: ``[unit, length - 1, start]``, -1 where there is none.

        ``chars`` holds units of one length as rows of code points.
        """
        n, length = chars.shape
        top = min(length, self.longest)
        out = np.full((n, top, length), -1, np.int64)
        h = np.zeros((n, length), np.uint64)
        for k in range(top):
            h = h[:, : length - k] * ODD + chars[:, k:] + np.uint64(1)
            unit, start = np.nonzero(self.maybe[h >> np.uint64(42)])
            asked = h[unit, start]
            at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
            out[unit, k, start] = np.where(self.keys[at] == asked, self.values[at], -1)
        return out

    def best_paths(self, ids: np.ndarray) -> np.ndarray:
        """Viterbi for units of one length: where the piece that starts at ``[unit, start]`` ends, 0 if none does."""
        n, top, length = ids.shape
        score = np.where(ids >= 0, self.scores[ids], -np.inf)
        score[:, 0] = np.where(ids[:, 0] >= 0, score[:, 0], self.least)
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0.0
        back = np.zeros((n, length + 1), np.int64)
        rows = np.arange(n)
        for stop in range(1, length + 1):
            sizes = np.arange(min(stop, top), 0, -1)  # the longest first: it wins ties
            reach = best[:, stop - sizes] + score[:, sizes - 1, stop - sizes]
            chosen = reach.argmax(axis=1)
            best[:, stop] = reach[rows, chosen]
            back[:, stop] = stop - sizes[chosen]
        # Back along the pointers, all units at once.
        stops, at = np.zeros((n, length), np.int64), np.full(n, length)
        while len(rows):
            before = back[rows, at]
            stops[rows, before] = at
            rows, at = rows[before > 0], before[before > 0]
        return stops

    def merged(self, ids: np.ndarray) -> np.ndarray:
        """BPE for units of one length: as :meth:`best_paths`.

        Each step joins, in every unit, the neighbours whose joint piece scores best;
        the leftmost of equals.
        """
        n, top, length = ids.shape
        score = np.where(ids >= 0, self.scores[ids], -np.inf).reshape(n, -1)
        out = np.zeros((n, length), np.int64)
        # Symbols as linked lists; column ``length`` takes what points outside.
        stop = np.tile(np.append(np.arange(1, length + 1), 2 * length + top), (n, 1))
        before = np.tile(np.append(np.arange(length) - 1, 0), (n, 1))
        before[:, 0] = length
        joint = np.full((n, length + 1), -np.inf)
        if top > 1:
            joint[:, : length - 1] = score[:, length : 2 * length - 1]
        row = np.arange(n)

        def offer(k, start, end):
            """Score the joint piece from ``start`` to ``end``."""
            size = end - start
            ok = (start < length) & (size > 0) & (size <= top)
            found = score[row[k], np.where(ok, (size - 1) * length + start, 0)]
            joint[k, start] = np.where(ok, found, -np.inf)

        while len(row):
            k = np.arange(len(row))
            at = joint.argmax(axis=1)
            done = joint[k, at] == -np.inf
            if done.any():
                out[row[done]] = stop[done, :length]
                row, stop, before, joint, at = row[~done], stop[~done], before[~done], joint[~done], at[~done]
                k = np.arange(len(row))
            middle = stop[k, at]
            end = stop[k, middle]
            stop[k, at] = end
            stop[k, middle] = 0
            joint[k, middle] = -np.inf
            before[k, end] = at
            stop[:, length] = 2 * length + top
            offer(k, at, stop[k, end])
            offer(k, before[k, at], end)
            joint[:, length] = -np.inf
        return out

    def long_merged(self, unit: str) -> list[tuple[int, int]]:
        """:meth:`merged` for one long unit, with a queue of joints."""
        n = len(unit)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list = []

        def offer(a):
            b = after[a]
            if b < n and after[b] - a <= self.longest and (k := self.ids.get(unit[a : after[b]])) is not None:
                heapq.heappush(queue, (-self.scores[k], a, b, after[b]))

        for a in range(n):
            offer(a)
        gone = bytearray(n)
        while queue:
            _, a, b, c = heapq.heappop(queue)
            if gone[a] or gone[b] or after[a] != b or after[b] != c:
                continue
            gone[b] = 1
            after[a] = c
            if c < n:
                before[c] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [(a, after[a]) for a in range(n) if not gone[a]]

    def long_path(self, unit: str) -> list[tuple[int, int]]:
        """:meth:`best_paths` for one long unit, without a table of all its substrings."""
        n = len(unit)
        best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
        for stop in range(1, n + 1):
            for start in range(max(0, stop - self.longest), stop):
                k = self.ids.get(unit[start:stop])
                s = self.scores[k] if k is not None else self.least if stop - start == 1 else None
                if s is not None and best[start] + s > best[stop]:
                    best[stop], back[stop] = best[start] + s, start
        path, at = [], n
        while at:
            path.append((back[at], at))
            at = back[at]
        return path[::-1]

    def ids_of(self, unit: str, path: list[tuple[int, int]]) -> np.ndarray:
        """Ids of a segmentation; bytes for what has no piece, else one unknown for a run of it."""
        out: list[int] = []
        for a, b in path:
            k = self.ids.get(unit[a:b])
            if k is not None:
                out.append(k)
            elif self.bytes:
                out += [self.bytes[x] for x in unit[a:b].encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.array(out, np.int32)

    def learn_units(self, units: set[str]) -> None:
        """Encode units that are not in the cache yet, those of a length together."""
        by_length: dict[int, list[str]] = {}
        for u in units - self.cache.keys():
            by_length.setdefault(len(u), []).append(u)
        names, sizes, parts = [], [], []
        for length, group in by_length.items():
            if length > LONGEST:
                find = self.long_path if self.kind == UNIGRAM else self.long_merged
                found = [self.ids_of(u, find(u)) for u in group]
                sizes.append(np.array([len(f) for f in found]))
                parts += found
                names += group
                continue
            for a in range(0, len(group), 4096):
                part = group[a : a + 4096]
                chars = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32).reshape(len(part), length).astype(np.uint64)
                ids = self.lattice(chars)
                stops = (self.best_paths if self.kind == UNIGRAM else self.merged)(ids)
                unit, start = np.nonzero(stops)
                flat = ids[unit, stops[unit, start] - start - 1, start]
                count = np.bincount(unit, minlength=len(part))
                plain = (flat < 0) & (chars[unit, start] < 128)
                flat[plain] = self.byte_ids[chars[unit, start][plain].astype(np.int64)]
                odd = np.unique(unit[flat < 0])
                if len(odd):  # characters without a piece
                    bounds = np.concatenate([[0], np.cumsum(count)])
                    pieces = [flat[x:y] for x, y in zip(bounds, bounds[1:])]
                    for u in odd.tolist():
                        pieces[u] = self.ids_of(part[u], [(b, e) for b, e in enumerate(stops[u].tolist()) if e])
                        count[u] = len(pieces[u])
                    flat = np.concatenate(pieces)
                names += part
                sizes.append(count)
                parts.append(flat.astype(np.int32))
        if names:
            first = len(self.cache)
            self.cache.update(zip(names, range(first, first + len(names))))
            self.held += sum(map(len, names))
            self.pool = np.concatenate([self.pool, *parts])
            self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(np.concatenate(sizes))])

    def units(self, text: str) -> list[str]:
        """The units of a text."""
        if not text:
            return []
        return UNIT.findall((MARK if self.prefix else "") + text.replace(" ", MARK))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        split = [self.units(t) for t in texts]
        if len(self.cache) > CACHE or self.held > CACHE_CHARS:
            self.forget()
        self.learn_units(set(chain.from_iterable(split)))
        counts = np.array([len(s) for s in split], np.int64)
        number = np.fromiter(map(self.cache.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        sizes = self.begins[number + 1] - self.begins[number]
        bounds = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return self.pool[ranges(self.begins[number], sizes)], np.diff(bounds)

    def decode_tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces' bytes, one after another, where each begins, and whether it begins with the blank mark."""
        raw = []
        for text, kind in zip(self.texts, self.types):
            if kind == BYTE:
                raw.append(bytes([int(text[1:-1], 16)]))
            elif kind == UNKNOWN:
                raw.append(" ⁇ ".encode())
            else:
                raw.append(b"" if kind == CONTROL else text.replace(MARK, " ").encode())
        begins = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(r) for r in raw], out=begins[1:])
        marked = np.array([t.startswith(MARK) and k == NORMAL for t, k in zip(self.texts, self.types)])
        return np.frombuffer(b"".join(raw), np.uint8), begins, marked


class Loaded:
    """Pieces built once in each task."""

    def __init__(self, plain):
        self.plain, self.pieces, self.tables = plain, None, None

    def get(self) -> Pieces:
        if self.pieces is None:
            self.pieces = Pieces(*self.plain.value)
            self.tables = self.pieces.decode_tables()
        return self.pieces


def decoded(ids: np.ndarray, lengths: np.ndarray, tables, prefix: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts behind flat ids, and their offsets: one gather for all of them."""
    raw, begins, marked = tables
    sizes = begins[ids + 1] - begins[ids]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    edges = np.concatenate([[0], np.cumsum(lengths)])
    data = raw[ranges(begins[ids], sizes)]
    offsets = bounds[edges]
    if prefix:  # the blank put in front goes
        begin = offsets[:-1][(np.diff(offsets) > 0)]
        drop = np.zeros(len(data), bool)
        drop[begin] = marked[ids[np.searchsorted(bounds, begin, side="right") - 1]]
        data = data[~drop]
        offsets = offsets - np.concatenate([[0], np.cumsum(drop)])[offsets]
    return data, offsets


def read_model(spark, path: str) -> bytes:
    """A model file's bytes, from any store that Spark reads or a local path of the driver."""
    try:
        with open(path, "rb") as f:
            return f.read()
    except OSError:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def texts_of(pieces: Pieces, tables, ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The texts behind flat ids, a bounded number of them at a time."""
    out = []
    for a, b in slices(np.concatenate([[0], np.cumsum(lengths)]), TOKENS):
        first = int(lengths[:a].sum())
        own = ids[first : first + int(lengths[a:b].sum())].astype(np.int64)
        data, offsets = decoded(own, lengths[a:b], tables, pieces.prefix)
        raw, at = data.tobytes(), offsets.tolist()
        out.append(pa.array([raw[x:y].decode(errors="replace") for x, y in zip(at, at[1:])], pa.string()))
    return pa.concat_arrays(out) if out else pa.array([], pa.string())


def encode(docs: DataFrame, model: str, text: str = "text", out: str | None = None) -> DataFrame:
    """Add ``ids`` (array of int) and ``n_tokens``; ``model`` is a path.

    The ids are those the model's own library gives, without begin and end marks. A
    null text has null ids and no tokens; an empty one has an empty list. Texts and
    words of any length are encoded whole, repeated rows alike, empty tables give no
    rows; other columns pass through, save those named like an output. With ``out``,
    the ids are decoded again in the same pass, into a column of that name.
    """
    spark = docs.sparkSession
    loaded = Loaded(spark.sparkContext.broadcast(Pieces.read(read_model(spark, model))))

    def run(batch):
        pieces = loaded.get()
        data, offsets, null = text_buffer(batch.column(batch.schema.names.index(text)))
        flat, counts, again = [], [], []
        for a, b in slices(offsets, SLICE):
            raw, at = data[offsets[a] : offsets[b]].tobytes(), (offsets[a : b + 1] - offsets[a]).tolist()
            ids, count = pieces.encode([raw[x:y].decode() for x, y in zip(at, at[1:])])
            flat.append(ids)
            counts.append(count)
            if out:
                again.append(texts_of(pieces, loaded.tables, ids, count))
        counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        begins = np.zeros(len(counts) + 1, np.int32)
        np.cumsum(counts, out=begins[1:])
        values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32), pa.int32())
        arrays = [pa.ListArray.from_arrays(pa.array(begins, mask=np.append(null, False)), values), pa.array(counts, pa.int64())]
        if out:
            texts = pa.concat_arrays(again) if again else pa.array([], pa.string())
            arrays.append(pa.compute.if_else(pa.array(null), pa.scalar(None, pa.string()), texts))
        return arrays

    return extend(docs, "ids array<int>, n_tokens long" + (f", `{out}` string" if out else ""), run, text)


def decode(docs: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text behind the ``ids``; null for null ids, empty for an empty list.

    Null ids inside a list and those outside the model are left out. Bytes that are no
    UTF-8 become replacement characters. Other columns pass through.
    """
    spark = docs.sparkSession
    loaded = Loaded(spark.sparkContext.broadcast(Pieces.read(read_model(spark, model))))

    fields = [f for f in docs.schema.fields if f.name.lower() != out.lower()]
    place = next(k for k, f in enumerate(fields) if f.name == ids)

    def run(batches):
        for batch in batches:
            pieces, column = loaded.get(), batch.column(place)
            null = np.asarray(column.is_null())
            parents = pa.compute.list_parent_indices(column).to_numpy()
            flat = pa.compute.list_flatten(column).cast(pa.int64()).fill_null(-1).to_numpy()
            good = (flat >= 0) & (flat < len(pieces.texts))
            texts = texts_of(pieces, loaded.tables, flat[good], np.bincount(parents[good], minlength=len(column)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.compute.if_else(pa.array(null), pa.scalar(None, pa.string()), texts)], names=[*(f.name for f in fields), out])

    plain = docs.select(*[F.col(quoted(f.name)).alias(f"c{k}") for k, f in enumerate(fields)])
    return plain.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.StringType())]))
