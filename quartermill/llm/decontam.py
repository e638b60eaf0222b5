"""Benchmark decontamination with an FM-index per shard of the training texts.

A shard is a few megabytes of whole texts inside one task. Its words become ids of
the benchmark's vocabulary; any other word is a separator, since no test phrase
holds it. Over these ids the shard gets a suffix array, its Burrows-Wheeler
transform in a wavelet matrix and sampled suffix positions. All test phrases are
searched backwards at once with rank queries, their occurrences are located by
walking to the next sampled position, and overlapping spans merge.

The benchmark's phrases are numbers in a few arrays, which every task holds: about ten
bytes for each byte of its text. So its size is bounded, and a larger one is an error.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import extend, list_array, ranges, slices, text_buffer

#: Words of lower-cased UTF-8: ASCII letters and digits, and all that is not ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Whole texts in one index; a longer text has one of its own.
SHARD_BYTES = 4 << 20
#: Benchmark text in all. Its phrases go through the driver and into every task.
MOST_BYTES = 32 << 20
SAMPLE = 8


class WaveletMatrix:
    """Rank and access on a sequence of small integers, for arrays of positions at once."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for b in reversed(range(bits)):
            bit = (values >> b) & 1
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(values) - int(ones[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbols: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        first, last = np.zeros_like(positions), positions
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbols >> (self.bits - 1 - level)) & 1 == 1
            a, b = ones[first], ones[last]
            first, last = np.where(bit, zeros + a, first - a), np.where(bit, zeros + b, last - b)
        return last - first

    def access(self, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and how often it occurs before it."""
        symbol, first, at = np.zeros_like(positions), np.zeros_like(positions), positions
        for ones, zeros in zip(self.ones, self.zeros):
            a, before = ones[first], ones[at]
            bit = ones[at + 1] > before
            symbol = symbol * 2 + bit
            first, at = np.where(bit, zeros + a, first - a), np.where(bit, zeros + before, at - before)
        return symbol, at - first


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling. Zeros count as different symbols, in order of position."""
    n = len(text)
    stops = text == 0
    rank = np.where(stops, np.cumsum(stops) - 1, text.astype(np.int64) + int(stops.sum()))
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(np.diff(rank[order]) != 0)
        if not n or new[order[-1]] == n - 1:
            return order
        following = np.zeros(n, np.int64)
        following[:-step] = new[step:] + 1
        rank = new * (n + 1) + following
        order = np.argsort(rank, kind="stable")
        step *= 2


class FMIndex:
    """Count and locate phrases in a sequence of ids; 0 separates and is never part of a phrase."""

    def __init__(self, text: np.ndarray, symbols: int):
        text = np.append(text, 0)
        order = suffix_array(text)
        before = text[order - 1]  # of position 0: the last, a separator
        self.n = len(text)
        self.first = np.zeros(symbols + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=symbols)[:symbols], out=self.first[1:])
        self.matrix = WaveletMatrix(before.astype(np.int64), max(1, int(symbols - 1).bit_length()))
        # Sampled: every SAMPLE-th position, and those behind a separator, so no walk crosses one.
        sampled = (order % SAMPLE == 0) | (before == 0)
        self.marks = np.zeros(self.n + 1, np.int64)
        np.cumsum(sampled, out=self.marks[1:])
        self.positions = order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of each phrase (one per row of the array), by backward search."""
        first, last = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        alive = np.arange(len(phrases))
        for t in reversed(range(phrases.shape[1])):
            symbol = phrases[alive, t]
            first[alive] = self.first[symbol] + self.matrix.rank(symbol, first[alive])
            last[alive] = self.first[symbol] + self.matrix.rank(symbol, last[alive])
            alive = alive[first[alive] < last[alive]]
        found = np.zeros(len(phrases), bool)
        found[alive] = True
        return np.where(found, first, 0), np.where(found, last, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        left = np.arange(len(rows))
        while len(left):
            at = rows[left]
            sampled = self.marks[at + 1] > self.marks[at]
            out[left[sampled]] = self.positions[self.marks[at[sampled]]] + steps[left[sampled]]
            left, at = left[~sampled], at[~sampled]
            symbol, before = self.matrix.access(at)
            rows[left] = self.first[symbol] + before
            steps[left] += 1
        return out


class Phrases:
    """Test phrases of the benchmark: every window of ``window`` words of each item, or the whole item if it has fewer words.

    ``groups`` has, for each length, the distinct phrases (a row of word numbers each) and
    their items: those of phrase k are ``owners[begins[k] : begins[k + 1]]``, places in
    ``names``.
    """

    def __init__(self, vocabulary: dict[bytes, int], shortest: int, groups: list, names: list[str | None]):
        self.vocabulary, self.shortest, self.groups, self.names = vocabulary, shortest, groups, names

    @staticmethod
    def plain(items: list[tuple[str | None, str | None]], window: int) -> tuple:
        """What the constructor takes, as plain values that any worker can unpickle."""
        vocabulary: dict[bytes, int] = {}
        ids, counts = [], []
        for _, text in items:
            words = WORD.findall((text or "").encode().lower())
            ids.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words], np.int32))
            counts.append(len(words))
        flat, counts = np.concatenate([*ids, np.zeros(0, np.int32)]), np.array(counts, np.int64)
        first = np.cumsum(counts) - counts
        groups = []
        lengths = np.minimum(counts, window)
        for length in np.unique(lengths[lengths > 0]).tolist():
            own = np.flatnonzero(lengths == length)
            starts = ranges(first[own], counts[own] - length + 1)
            owner = np.repeat(own, counts[own] - length + 1)
            rows = np.lib.stride_tricks.sliding_window_view(flat, length)[starts]
            order = np.lexsort((owner, *rows.T[::-1]))
            rows, owner = rows[order], owner[order]
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
            once = new.copy()
            once[1:] |= owner[1:] != owner[:-1]
            begins = np.append(np.flatnonzero(new[once]), int(once.sum()))
            groups.append((rows[new], begins, owner[once].astype(np.int32)))
        return vocabulary, int(lengths[lengths > 0].min(initial=window)) if len(groups) else 0, groups, [item for item, _ in items]

    def hits(self, ids: np.ndarray, stops: np.ndarray) -> list[tuple[np.ndarray, int, list[str]]]:
        """(word positions, length, items that have an id) of every phrase that occurs in the shard.

        ``ids`` are the vocabulary ids of the shard's words, ``stops`` the positions
        at which a text begins.
        """
        if not self.groups or not len(ids):
            return []
        # Runs of known words that are long enough for a phrase; nothing else can hold one.
        known = ids > 0
        breaks = np.zeros(len(ids) + 1, bool)
        breaks[stops] = breaks[0] = breaks[-1] = True
        breaks[:-1] |= ~known
        breaks[1:] |= ~known
        edges = np.flatnonzero(breaks)
        starts, lengths = edges[:-1], np.diff(edges)
        good = known[starts] & (lengths >= self.shortest)
        starts, lengths = starts[good], lengths[good]
        if not len(starts):
            return []
        origin = ranges(starts, lengths + 1)
        ends = np.cumsum(lengths + 1) - 1
        text = ids[np.minimum(origin, len(ids) - 1)]
        text[ends] = 0
        index = FMIndex(text, len(self.vocabulary) + 1)
        out = []
        here = np.zeros(len(self.vocabulary) + 1, bool)
        here[text] = True
        for phrases, begins, owners in self.groups:
            # Only phrases all of whose words the shard has can occur in it.
            asked = np.flatnonzero(here[phrases].all(axis=1))
            first, last = index.search(phrases[asked].astype(np.int64))
            rows = index.locate(ranges(first, last - first))
            begin = np.concatenate([[0], np.cumsum(last - first)])
            for k in np.flatnonzero(last > first):
                items = [self.names[i] for i in owners[begins[asked[k]] : begins[asked[k] + 1]]]
                out.append((origin[rows[begin[k] : begin[k + 1]]], phrases.shape[1], [x for x in items if x is not None]))
        return out


def scan_shard(texts: list[bytes], phrases: Phrases) -> tuple[list[int], list[int], list[set], list[list]]:
    """Per text: words, hit words, items found, and merged spans of words (first, behind the last)."""
    words = [WORD.findall(t.lower()) for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    total = int(bounds[-1])
    cover = np.zeros(total + 1, np.int32)
    items: list[set] = [set() for _ in texts]
    get = phrases.vocabulary.get
    ids = np.concatenate([np.fromiter(map(get, w, repeat(0)), np.int64, len(w)) for w in words] or [np.zeros(0, np.int64)])
    for positions, length, owners in phrases.hits(ids, bounds[:-1]):
        np.add.at(cover, positions, 1)
        np.add.at(cover, positions + length, -1)
        for d in np.unique(np.searchsorted(bounds, positions, side="right") - 1):
            items[d].update(owners)
    hit = np.cumsum(cover[:-1]) > 0
    edges = np.zeros(total + 1, bool)
    edges[bounds[:-1]] = True
    inside = np.concatenate([[False], hit])
    starts = np.flatnonzero(hit & (~inside[:-1] | edges[:-1]))
    after = np.concatenate([hit[1:], [False]])
    ends = np.flatnonzero(hit & (~after | edges[1:])) + 1
    sums = np.concatenate([[0], np.cumsum(hit)])
    owner = np.searchsorted(bounds, starts, side="right") - 1
    spans: list[list] = [[] for _ in texts]
    for d, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist()):
        spans[d].append((a - int(bounds[d]), b - int(bounds[d])))
    return counts.tolist(), (sums[bounds[1:]] - sums[bounds[:-1]]).tolist(), items, spans


def byte_spans(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of bytes."""
    found = [(m.start(), m.end()) for m in WORD.finditer(text.lower())]
    return [(found[a][0], found[b - 1][1]) for a, b in spans]


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without some spans of bytes."""
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def read_phrases(items: DataFrame, item: str, text: str, window: int, most_bytes: int) -> tuple:
    """The benchmark's phrases; a benchmark of more than ``most_bytes`` of text is an error before any of it is read."""
    size = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"the benchmark has {size} bytes of text, more than {most_bytes}: give it in parts, or more memory and a larger bound")
    return Phrases.plain([tuple(r) for r in items.select(F.col(item).cast("string"), text).collect()], window)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                  window: int = 10, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Find benchmark passages in whole texts and cut them out.

    Adds ``n_words``, ``n_hit`` (words inside any occurrence), ``hit_items`` (ids as
    sorted text, distinct), ``removal`` (merged spans of code points) and
    ``clean_text`` (the text without them). A null text has no words and stays null;
    an empty or word-free one has no hits. Items that are null or have no words have
    no phrases; repeated items count once; an item without an id cuts but is not
    listed. Texts of any length are searched whole, repeated rows each on their own,
    and with an empty table nothing is hit. Other columns pass through, save those
    named like an output. The benchmark may have ``most_bytes`` of text; more is an error.
    """
    spark = docs.sparkSession
    phrases = spark.sparkContext.broadcast(read_phrases(items, item, item_text, window, most_bytes))

    def run(batch):
        column = batch.column(batch.schema.names.index(text))
        data, offsets, null = text_buffer(column)
        words, hits, found, spans, clean = [], [], [], [], []
        for a, b in slices(offsets, SHARD_BYTES):
            raw = data[offsets[a] : offsets[b]].tobytes()
            at = (offsets[a : b + 1] - offsets[a]).tolist()
            texts = [raw[x:y] for x, y in zip(at, at[1:])]
            n, h, i, s = scan_shard(texts, Phrases(*phrases.value))
            words += n
            hits += h
            found += [sorted(x) for x in i]
            for t, own in zip(texts, s):
                cuts = byte_spans(t, own) if own else []
                clean.append(without(t, cuts) if cuts else None)
                spans.append([(len(t[:x].decode()), len(t[:y].decode())) for x, y in cuts])
        cleaned = pa.array([None if c is None else c.decode() for c in clean], column.type)
        flat = [x for s in spans for x in s]
        parts = [pa.array([x[k] for x in flat], pa.int64()) for k in (0, 1)]
        return [
            pa.array(words, pa.int64()),
            pa.array(hits, pa.int64()),
            list_array(pa.array([x for f in found for x in f], pa.string()), [len(f) for f in found]),
            list_array(pa.StructArray.from_arrays(parts, names=["start", "stop"]), [len(s) for s in spans]),
            pa.compute.if_else(cleaned.is_null(), column, cleaned),
        ]

    return extend(docs, "n_words long, n_hit long, hit_items array<string>, removal array<struct<start: long, stop: long>>, clean_text string", run, text)
