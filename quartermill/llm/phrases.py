"""Collocations: phrases that occur far more often than their parts would make them.

Each shard, a few megabytes of whole texts inside one task, gets an FM-index over
word ids in both directions. An interval of the index is a phrase; its extensions to
the left are the distinct symbols of that interval in the Burrows-Wheeler transform,
and those to the right the same in the index of the reversed shard. Both intervals of
a phrase are kept in step, so it grows on either side. Rows are sorted by as many words
as the longest phrase has, which is all that intervals of such phrases depend on.

Counts are summed over the shards, one length after another. A phrase can only be
frequent where the two phrases one word shorter are, so every pass extends only what
all shards together held often enough. What passes is a bitmap of hashes of bounded
size; it may let too much pass, never too little, and the counts of the last pass, by
the phrases themselves, are exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermill.llm.common import cut, slices, text_buffer
from quartermill.llm.decontam import WaveletMatrix
from quartermill.llm.slots import bitmap, passes
from quartermill.llm.wordcodes import MULT, byte_class, mix, word_codes, word_spans

BREAK = byte_class(b".,;:!?\n\x0b\x0c\r")
GAP = BREAK | byte_class(b" \t")
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
SHARD_BYTES = 8 << 20
#: Parts in which the candidates of a language are ranked before they meet.
RANK_PARTS = 64


class Extensions(WaveletMatrix):
    """A wavelet matrix that lists the distinct symbols of many ranges at once."""

    def __init__(self, values: np.ndarray, bits: int):
        super().__init__(values, bits)
        # Where each symbol's own range begins behind the last level.
        symbol = np.arange(1 << bits, dtype=np.int32)
        at = np.zeros(len(symbol), np.int32)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            a = ones[at]
            at = np.where((symbol >> (bits - 1 - level)) & 1 == 1, zeros + a, at - a)
        self.begin = at

    def distinct(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
        """(range, symbol, how often before the range, how often up to its end), by range and symbol."""
        owner, symbol = np.arange(len(first), dtype=np.int32), np.zeros(len(first), np.int32)
        for ones, zeros in zip(self.ones, self.zeros):
            a, b = ones[first], ones[last]
            low = np.stack([first - a, zeros + a], 1).ravel()
            high = np.stack([last - b, zeros + b], 1).ravel()
            both = np.stack([symbol * 2, symbol * 2 + 1], 1).ravel()
            here = np.flatnonzero(high > low)
            first, last, symbol, owner = low[here], high[here], both[here], owner[here >> 1]
        return owner, symbol, first - self.begin[symbol], last - self.begin[symbol]


def context_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the next ``depth`` symbols."""
    rank, width, n = text.astype(np.int64), 1, len(text)
    while True:
        following = np.zeros(n, np.int64)
        step = min(width, depth - width)
        if step > 0:
            following[: n - step] = rank[step:]
        key = rank * (int(rank.max(initial=0)) + 1) + following if step > 0 else rank
        order = np.argsort(key)
        width += max(step, 0)
        if width >= depth:
            return order
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])


class OneWay:
    """The transform of a sequence that ends in a separator (0), to find what stands before a phrase."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        order = context_order(text, depth)
        self.first = np.zeros(symbols + 1, np.int32)
        np.cumsum(np.bincount(text, minlength=symbols), out=self.first[1:])
        self.matrix = Extensions(text[order - 1].astype(np.int32), max(1, int(symbols - 1).bit_length()))

    def extend(self, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """(interval, symbol before it, first row and size of the longer phrase, rows of smaller symbols)."""
        owner, symbol, before, upto = self.matrix.distinct(first, first + size)
        count = upto - before
        running = np.cumsum(count) - count
        begins = np.searchsorted(owner, np.arange(len(first)))
        smaller = running - running[np.minimum(begins, max(len(running) - 1, 0))][owner] if len(owner) else running
        return owner, symbol, self.first[symbol] + before, count, smaller


class TwoWay:
    """An index in both directions; a phrase is a pair of intervals of the same size."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.text, self.symbols, self.depth = text, symbols, depth
        self.ahead = OneWay(text, symbols, depth)
        self.back: OneWay | None = None

    def grow(self, accept):
        """(words of each phrase, its count) for two words and more, up to the depth.

        ``accept(words, left)`` says which of the longer phrases to keep; ``left``
        tells that the first word is the new one.
        """
        counts = np.diff(self.ahead.first[: self.symbols + 1])
        words = np.flatnonzero(counts[1:])[:, None].astype(np.int32) + 1
        size = counts[words[:, 0]]
        first = self.ahead.first[words[:, 0]]
        mirrored = first
        for length in range(2, self.depth + 1):
            left = length % 2 == 0
            if left:
                owner, symbol, first, size, smaller = self.ahead.extend(first, size)
                mirrored = mirrored[owner] + smaller
                words = np.concatenate([symbol[:, None], words[owner]], axis=1)
            else:
                if self.back is None:
                    self.back = OneWay(np.append(self.text[-2::-1], 0), self.symbols, self.depth)
                owner, symbol, mirrored, size, smaller = self.back.extend(mirrored, size)
                first = first[owner] + smaller
                words = np.concatenate([words[owner], symbol[:, None]], axis=1)
            kept = np.flatnonzero(symbol)
            kept = kept[accept(words[kept], left)]
            first, mirrored, size, words = first[kept], mirrored[kept], size[kept], words[kept]
            yield words, size
            if not len(words):
                return


class Shard:
    """The words of some texts: ids, where pieces end, hashes and spellings."""

    def __init__(self, batch: pa.RecordBatch):
        langs = pc.fill_null(batch.column(0), "und").dictionary_encode()
        data, offsets, _ = text_buffer(batch.column(1))
        self.data = LOWER[data]
        self.starts, self.ends = word_spans(self.data, offsets, GAP)
        doc = np.searchsorted(offsets, self.starts, side="right") - 1
        piece = np.cumsum(BREAK[self.data], dtype=np.int32)[self.starts] if len(self.starts) else np.zeros(0, np.int32)
        #: Whether the word after this one is in the same piece.
        self.joined = np.zeros(len(self.starts), bool)
        self.joined[:-1] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
        self.langs = langs.dictionary
        of_lang = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs.to_pylist()], np.uint64)
        lang = langs.indices.to_numpy(zero_copy_only=False)[doc]
        keys = mix(word_codes(self.data, self.starts, self.ends) ^ (of_lang[lang] if len(of_lang) else np.zeros(0, np.uint64)))
        coded = pa.array(keys).dictionary_encode()
        self.codes = coded.dictionary.to_numpy()
        self.ids = coded.indices.to_numpy()
        self.counts = np.bincount(self.ids, minlength=len(self.codes))
        self.spot = np.zeros(len(self.codes), np.int64)
        self.spot[self.ids[::-1]] = np.arange(len(self.ids))[::-1]
        self.lang = lang[self.spot]
        self.totals = np.bincount(lang, minlength=len(self.langs))

    def hashes(self, words: np.ndarray) -> np.ndarray:
        """Hash of each phrase (a row of word ids)."""
        out = mix(self.codes[words[:, 0]])
        for k in range(1, words.shape[1]):
            out = mix(out * MULT[0] + self.codes[words[:, k]])
        return out

    def spelled(self, words: np.ndarray) -> pa.Array:
        """Each phrase as text."""
        used, words = np.unique(words, return_inverse=True)
        at = self.spot[used]
        raw = self.data.tobytes() if len(used) else b""
        vocabulary = pa.array([raw[a:b].decode("utf-8") for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist())], pa.string())
        words = words.reshape(-1, max(1, words.shape[-1] if words.ndim > 1 else 1))
        parts = [vocabulary.take(pa.array(words[:, k])) for k in range(words.shape[1])]
        return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, " ")

    def index(self, filters: list[np.ndarray], depth: int) -> tuple[TwoWay, np.ndarray] | None:
        """An index over runs of words whose words and, once known, word pairs pass; and the id of each symbol."""
        good = passes(filters[0], self.hashes(np.arange(len(self.codes))[:, None])) if len(self.codes) else np.zeros(0, bool)
        follows = self.joined & good[self.ids]
        follows[:-1] &= good[self.ids[1:]]
        if len(filters) > 1:
            at = np.flatnonzero(follows)
            pairs = np.stack([self.ids[at], self.ids[at + 1]], 1)
            follows[at] = passes(filters[1], self.hashes(pairs))
        inside = follows.copy()
        inside[1:] |= follows[:-1]
        at = np.flatnonzero(inside)
        if not len(at):
            return None
        # One symbol per word, and a separator behind each run.
        used, symbol = np.unique(self.ids[at], return_inverse=True)
        stops = np.flatnonzero(~follows[at])
        text = np.insert(symbol + 1, stops + 1, 0)
        return TwoWay(text, len(used) + 1, depth), used

    def phrases(self, filters: list[np.ndarray], depth: int):
        """(words, count) of the phrases of 2 to ``depth`` words whose parts pass the filters."""
        index = self.index(filters, depth)
        if index is None:
            return
        two_way, used = index

        def accept(words, left):
            n, ids = words.shape[1], used[words - 1]
            if n <= len(filters):
                return passes(filters[n - 1], self.hashes(ids))
            # Of the two shorter phrases, the one that was extended has passed.
            return passes(filters[n - 2], self.hashes(ids[:, :-1] if left else ids[:, 1:])) if n - 2 < len(filters) else np.ones(len(ids), bool)

        for words, count in two_way.grow(accept):
            yield used[words - 1], count


def shards(batches):
    """Parts of bounded size of Arrow batches of (language, text)."""
    for batch in batches:
        _, offsets, _ = text_buffer(batch.column(1))
        for a, b in slices(offsets, SHARD_BYTES):
            yield Shard(batch.slice(a, b - a))


def frequent(texts: DataFrame, filters: list, least: int) -> DataFrame:
    """Hashes of the phrases one word longer than the filters know that all shards together hold often enough."""
    def run(batches):
        known = [f.value for f in filters]
        for shard in shards(batches):
            if not known:
                rows = [(np.arange(len(shard.codes))[:, None], shard.counts)]
            else:
                rows = [x for x in shard.phrases(known, len(known) + 1) if x[0].shape[1] == len(known) + 1]
            for words, count in rows:
                yield pa.RecordBatch.from_arrays([pa.array(shard.hashes(words).view(np.int64)), pa.array(count, pa.int64())], names=["hash", "n"])

    return texts.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("hash")


def counted(texts: DataFrame, filters: list, depth: int) -> DataFrame:
    """Exact counts (lang, phrase, words, n) of what passes the filters, and of all words as the empty phrase."""
    def run(batches):
        known = [f.value for f in filters]
        for shard in shards(batches):
            words = np.arange(len(shard.codes))[:, None]
            kept = passes(known[0], shard.hashes(words)) if len(words) else np.zeros(0, bool)
            parts = [(words[kept], shard.counts[kept]), *shard.phrases(known, depth)]
            columns = [(shard.lang[w[:, 0]], shard.spelled(w), w.shape[1], n) for w, n in parts if len(w)]
            columns.append((np.arange(len(shard.langs)), pa.array([""] * len(shard.langs), pa.string()), 0, shard.totals))
            for lang, phrase, length, n in columns:
                yield pa.RecordBatch.from_arrays(
                    [shard.langs.take(pa.array(lang)).cast(pa.string()), phrase, pa.array(np.full(len(n), length, np.int32)), pa.array(n, pa.int64())],
                    names=["lang", "phrase", "words", "n"])

    rows = texts.mapInArrow(run, "lang string, phrase string, words int, n long")
    return rows.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = 4, least: int = 30,
                 covered: int = 80, top: int = 2000) -> DataFrame:
    """The best phrases of 2 to ``max_words`` words of each language.

    Texts (null: empty) are lower-cased in A-Z and cut into pieces at ``.,;:!?`` and
    line ends, pieces into words at blanks and tabs. A phrase lies inside a piece;
    ``a`` counts all of its occurrences in the language (null: ``und``), and those of at
    least ``least`` are candidates. A cut after its first k words gives ``l`` and ``r``,
    the counts of both parts, and floor(2000000 a / (l + r)); the cut with the lowest
    score counts, the smallest k among equals. A candidate goes if a longer one that
    holds it has at least ``covered`` percent of its count. The first ``top`` of each
    language stay, by score, ``a`` (both falling) and phrase (by its bytes).

    Returns lang, rank, phrase, a, l, r, n (all words of the language) and score.
    Repeated rows count each time, other columns of any name play no part, a table
    without words gives no rows. Memory follows the longest text (about 40 bytes per
    byte of it), else the shard.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(lang).cast("string").alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    filters: list = []
    for _ in range(max_words - 1):
        filters.append(spark.sparkContext.broadcast(bitmap(frequent(texts, filters, least), "hash")))
    counts = cut(counted(texts, filters, max_words).filter((F.col("n") >= least) | (F.col("words") == 0)))

    phrases = counts.filter("words > 1").select("lang", F.split("phrase", " ").alias("w"), "phrase", F.col("n").alias("a"))
    parts = counts.filter("words > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    k = F.col("k")
    joined = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), k).alias("head"), joined(k + 1, F.size("w") - k).alias("rest"))
    cuts = cuts.join(parts.withColumnsRenamed({"part": "head", "f": "l"}), ["lang", "head"]).join(parts.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    # Whole decimals: the product may pass 64 bits. Of a quotient only whole digits count.
    score = F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * wide("a"), wide("l") + wide("r"))
    best = cuts.select("*", score.alias("score")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    inner = F.expr("flatten(transform(sequence(2, size(w) - 1), len -> transform(sequence(1, size(w) - len + 1), at -> array_join(slice(w, at, len), ' '))))")
    longer = phrases.filter(F.size("w") > 2).select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    hidden = wide("longest") * 100 >= wide("a") * covered
    kept = best.join(longer, ["lang", "phrase"], "left").filter(F.col("longest").isNull() | ~hidden)

    kept = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Ranked in parts first, so that no task orders all candidates of a language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    kept = kept.withColumn("place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).filter(F.col("place") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    total = counts.filter("words = 0").select("lang", "n")
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
