"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams, in order. A document's
own most frequent n-grams are compared with each profile: every n-gram adds how many
places it is out of place, or the most if the profile lacks it. The nearest profile
names the language.

N-grams have one to three characters and stay inside words, with a blank at both ends
of a word; letters are lower-cased and everything else is blank. Tasks count them with
sorted integer codes, so no n-gram is ever a Python object.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermill.llm.common import extend, quoted, slices, text_buffer

PROFILE = 400
#: The rank-order distance of a document needs its own list in memory for each language.
MOST_LANGUAGES = 1000
BLANK = np.uint16(32)
CHARS = 1 << 20
#: A text's number has 16 bits among the texts that are counted together.
TEXTS = 1 << 16


#: Filled once in each task.
FOLDING: list[np.ndarray] = []


def fold(c: int) -> int:
    """The lower-cased letter as 16 bits, or a blank. Letters beyond 16 bits share codes of the private use area."""
    s = chr(c)
    if not s.isalpha():
        return int(BLANK)
    low = s.lower()
    low = ord(low) if len(low) == 1 else c
    return low if low < 0xE000 or 0xF900 <= low < 0x10000 else 0xE000 + low % 0x1900


def fold_all(points: np.ndarray) -> np.ndarray:
    """:func:`fold` for many code points."""
    if not FOLDING:
        FOLDING.append(np.array([fold(c) for c in range(0x10000)], np.uint16))
    out = FOLDING[0][np.minimum(points, 0xFFFF)]
    far = np.flatnonzero(points > 0xFFFF)
    if len(far):
        found, which = np.unique(points[far], return_inverse=True)
        out[far] = np.array([fold(int(c)) for c in found], np.uint16)[which]
    return out


def folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16-bit characters of the texts with a blank before, between and behind them; the text of each."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    # Where texts begin, in code points: all bytes but continuations count.
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    n = len(offsets) - 1
    chars = np.full(len(points) + n + 1, BLANK, np.uint16)
    owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(begins))
    chars[np.arange(len(points)) + owner + 1] = fold_all(points)
    owners = np.zeros(len(chars), np.int32)
    owners[np.arange(len(points)) + owner + 1] = owner
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != BLANK) | (chars[:-1] != BLANK)
    return chars[keep], owners[keep]


def grams(chars: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams, and the text of each."""
    letter = chars != BLANK
    wide = chars.astype(np.uint64)
    one = np.flatnonzero(letter)
    two = np.flatnonzero(letter[1:] | letter[:-1])
    two_owner = np.where(letter[two], owners[two], owners[two + 1])
    three = one[(one > 0) & (one < len(chars) - 1)]
    codes = np.concatenate([
        wide[one],
        (wide[two] << np.uint64(16)) | wide[two + 1],
        (wide[three - 1] << np.uint64(32)) | (wide[three] << np.uint64(16)) | wide[three + 1],
    ])
    return codes, np.concatenate([owners[one], two_owner, owners[three]])


def counted(codes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, n-gram) and how often each occurs, in order of both. Up to 65,536 texts."""
    keys = (owners.astype(np.uint64) << np.uint64(48)) | codes
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    keys = keys[starts]
    return (keys >> np.uint64(48)).astype(np.int64), keys & np.uint64(0xFFFFFFFFFFFF), np.diff(np.append(starts, len(new)))


def merged(owner: np.ndarray, code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the same (text, n-gram) in one entry, in order of both."""
    order = np.lexsort((code, owner))
    owner, code, times = owner[order], code[order], times[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    return owner[starts], code[starts], np.add.reduceat(times, starts) if len(starts) else times


def text_counts(data: np.ndarray, offsets: np.ndarray, labels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`counted` for whole texts, or for all texts of a label.

    A very long text is counted in parts, cut at white space (a word of over a
    million bytes is cut too).
    """
    parts, at = [], 0
    while at < len(data) or not parts:
        stop = len(data)
        if len(offsets) == 2 and stop - at > 4 * CHARS:
            blank = np.flatnonzero((data[at : at + CHARS] == 32) | (data[at : at + CHARS] == 10))
            stop = at + (int(blank[-1]) + 1 if len(blank) else CHARS)
            while (data[stop] & 0xC0) == 0x80:
                stop -= 1
            codes, owners = grams(*folded(data[at:stop], np.array([0, stop - at])))
        else:
            codes, owners = grams(*folded(data[at:], np.maximum(offsets, at) - at))
        parts.append(counted(codes, owners if labels is None else labels[owners]))
        at = stop
    return parts[0] if len(parts) == 1 else merged(*(np.concatenate(p) for p in zip(*parts)))


def places(owner: np.ndarray, times: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of each text's most frequent entries and their places (from 0); ties in order of code."""
    index = np.arange(len(owner), dtype=np.uint64)
    bits = np.uint64(max(1, int(len(owner)).bit_length()))
    # Text, then falling count, then index, in one integer: a plain sort ranks all texts at once.
    room = np.uint64(63) - bits - np.uint64(16)
    top = np.uint64((1 << int(room)) - 1)
    keys = (((owner.astype(np.uint64) << room) | (top - np.minimum(times.astype(np.uint64), top))) << bits) | index
    keys.sort()
    index = (keys & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    of = owner[index]
    first = np.searchsorted(of, of, side="left")
    place = np.arange(len(of)) - first
    ok = place < most
    return index[ok], place[ok]


def text_slices(offsets: np.ndarray) -> list[tuple[int, int]]:
    """Row ranges to count together: of about ``CHARS`` bytes, and of ``TEXTS`` rows at most."""
    return [(k, min(k + TEXTS, b)) for a, b in slices(offsets, CHARS) for k in range(a, b, TEXTS)]


def learn(docs: DataFrame, text: str, lang: str, profile: int = PROFILE, most: int = MOST_LANGUAGES) -> list[tuple[str, list[int]]]:
    """Profiles ``(language, n-gram codes in order)`` of all documents with a language.

    N-grams of all texts are counted: per language in each task, summed by Spark,
    ranked by count, then code. Only the profiles reach the driver; more than ``most``
    languages are an error. Null texts and null languages teach nothing.
    """

    def run(batches):
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            codes_of = names.indices.to_numpy()
            data, offsets, _ = text_buffer(batch.column(1))
            parts = [
                text_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], codes_of[a:b]) for a, b in text_slices(offsets)
            ]
            if not parts:
                continue
            owner, code, times = merged(*(np.concatenate(p) for p in zip(*parts)))
            yield pa.RecordBatch.from_arrays(
                [names.dictionary.take(pa.array(owner)), pa.array(code.astype(np.int64)), pa.array(times)], names=["lang", "code", "times"])

    known = docs.filter(F.col(quoted(lang)).isNotNull() & F.col(quoted(text)).isNotNull()).select(F.col(quoted(lang)).cast("string"), quoted(text))
    summed = known.mapInArrow(run, "lang string, code long, times long").groupBy("lang", "code").agg(F.sum("times").alias("times"))
    ranked = summed.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("times"), "code"))).filter(F.col("place") <= profile)
    rows = ranked.select("lang", "place", "code").limit(profile * (most + 1)).collect()
    out: dict[str, list] = {}
    for r in sorted(rows):
        out.setdefault(r.lang, []).append(r.code)
    if len(out) > most:
        raise ValueError(f"more than {most} languages")
    return sorted(out.items())


def distances(owner: np.ndarray, code: np.ndarray, times: np.ndarray, n: int, union: np.ndarray, ranks: np.ndarray, profile: int):
    """Out-of-place distance of each of ``n`` texts to each language, and the length of its list."""
    index, place = places(owner, times, profile)
    own, code = owner[index], code[index]
    at = np.minimum(np.searchsorted(union, code), len(union) - 1)
    at = np.where(union[at] == code, at, len(union))
    size = np.bincount(own, minlength=n)
    out = np.zeros((n, len(ranks)), np.int64)
    for k, rank in enumerate(ranks):
        theirs = rank[at]
        off = np.where(theirs < 0, profile, np.abs(theirs - place))
        out[:, k] = np.bincount(own, weights=off, minlength=n).astype(np.int64)
    return out, size


def identify(docs: DataFrame, profiles: list[tuple[str, list[int]]], text: str = "text", profile: int = PROFILE) -> DataFrame:
    """Add ``lang_pred`` and ``score``, from the whole text alone.

    ``score`` is 1 less the distance to the nearest profile as a share of the largest
    possible one; ties go to the language that sorts first. A null text, one without a
    letter, and any text if no language was learned is ``und`` with score 0. Texts of
    any length, repeated rows and empty tables are fine; other columns pass through,
    save those named like an output.
    """
    names = [name for name, _ in profiles]
    union = np.unique(np.concatenate([np.array(codes, np.uint64) for _, codes in profiles])) if profiles else np.zeros(0, np.uint64)
    ranks = np.full((len(profiles), len(union) + 1), -1, np.int64)
    for k, (_, codes) in enumerate(profiles):
        ranks[k, np.searchsorted(union, np.array(codes, np.uint64))] = np.arange(len(codes))

    def run(batch):
        data, offsets, _ = text_buffer(batch.column(batch.schema.names.index(text)))
        labels, scores = [], []
        for a, b in text_slices(offsets):
            if not names:
                labels += ["und"] * (b - a)
                scores += [0.0] * (b - a)
                continue
            n = b - a
            far, size = distances(*text_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), n, union, ranks, profile)
            best = far.argmin(axis=1)
            some = size > 0
            share = far[np.arange(n), best] / np.maximum(size * profile, 1)
            labels += [names[k] if s else "und" for k, s in zip(best.tolist(), some.tolist())]
            scores += np.where(some, 1.0 - share, 0.0).tolist()
        return [pa.array(labels, pa.string()), pa.array(scores, pa.float64())]

    return extend(docs, "lang_pred string, score double", run, text)
