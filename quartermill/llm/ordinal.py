"""Cumulative-link ordinal regression on hashed text features.

One weight vector, shared by all grades, scores a text; ordered thresholds cut the
score into grades: ``P(grade > k) = 1 / (1 + exp(threshold[k] - score))``. The expected
grade and the probability of at least some grade follow from it.

A model is fitted in one task on a bounded sample of labelled documents, and scores
whole texts of all documents. Features are found with array operations on UTF-8 bytes:
hashes of lower-cased words, of word beginnings, of punctuation runs, and shares of
words in capitals, of words that repeat the one before, and of punctuation.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import extend, quoted, slices, text_buffer

BITS = 18
MOST_GRADES = 1000
#: The sample that a model is fitted on: at most so many labelled documents, least hash first.
SAMPLE = 6000
ROUNDS = 150
RATE = 0.1
#: Of squared weights, divided by the number of texts.
PENALTY = 3.0
LEAST_TEXTS = 3
LEAN = 1.0
SHARE_UNIT = 10.0
SLICE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Kinds of features: whole words (0), their first bytes, and shares of odd words (-1).
WORDS_AND_BEGINNINGS = (0, 4, 5, 6)
WORDS = (0, -1)
SHARES = 3


class Model(NamedTuple):
    """Weights, thresholds between neighbouring grades, the grades, and the kinds of features."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int]
    beginnings: tuple


def powers(n: int, base: np.uint64) -> np.ndarray:
    """``base ** k`` for k below n, modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def spans(flag: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of runs of set bytes; runs end where texts end."""
    edge = np.zeros(len(flag) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], flag[:-1]]) & ~edge[:-1]
    after = np.concatenate([flag[1:], [False]]) & ~edge[1:]
    return np.flatnonzero(flag & ~before), np.flatnonzero(flag & ~after) + 1


def finish(x: np.ndarray) -> np.ndarray:
    """The bucket of a hash, spread by a 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(64 - BITS)).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray, beginnings: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the feature matrix of texts (values in order of row).

    A feature counts once per text, however often it occurs, and all are scaled by the
    fourth root of their number: halfway between a plain set, in which long texts weigh
    most, and unit length, in which a rare feature drowns. Three shares, if asked for,
    come behind the hashed columns: of words in capitals, of words that repeat the one
    before, and of runs of marks.
    """
    n = len(offsets) - 1
    upper = (data >= 65) & (data <= 90)
    low = np.where(upper, data + np.uint8(32), data)
    word = ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57)) | (low >= 128)
    mark = ~word & (low > 32)
    starts, stops = spans(word, offsets)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1, BASE)[:-1], out=sums[1:])
    back = powers(len(data) + 1, INVERSE)

    def hashed(a, b, kind):
        return finish(((sums[b] - sums[a]) * back[a] + np.uint64(kind)) * BASE)

    whole = (sums[stops] - sums[starts]) * back[starts]
    rows, columns = [], []
    for size in (k for k in beginnings if k >= 0):
        rows.append(owner)
        columns.append(hashed(starts, np.minimum(stops, starts + size) if size else stops, size))
    a, b = spans(mark, offsets)
    mark_owner = np.searchsorted(offsets, a, side="right") - 1
    rows.append(mark_owner)
    columns.append(hashed(a, b, 99))
    keys = (np.concatenate(rows) << BITS) | np.concatenate(columns)
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    row, column = keys[first] >> BITS, keys[first] & ((1 << BITS) - 1)
    value = np.bincount(row, minlength=n)[row] ** -0.25
    if -1 not in beginnings:
        return row, column, value
    words = np.bincount(owner, minlength=n)
    capitals = np.concatenate([[0], np.cumsum(upper)])
    loud = (capitals[stops] - capitals[starts] == stops - starts) & (stops - starts > 1)
    again = np.zeros(len(starts), bool)
    again[1:] = (whole[1:] == whole[:-1]) & (owner[1:] == owner[:-1])
    share = np.stack([
        np.bincount(owner[loud], minlength=n), np.bincount(owner[again], minlength=n), np.bincount(mark_owner[b - a > 1], minlength=n),
    ], axis=1) / np.maximum(words, 1)[:, None]
    some = words + np.bincount(mark_owner, minlength=n) > 0
    all_rows = np.concatenate([row, np.repeat(np.flatnonzero(some), SHARES)])
    all_columns = np.concatenate([column, np.tile(np.arange(SHARES) + (1 << BITS), int(some.sum()))])
    all_values = np.concatenate([value, np.minimum(share[some], 1.0).ravel()])
    order = np.argsort(all_rows, kind="stable")
    return all_rows[order], all_columns[order], all_values[order]


def text_features(data: np.ndarray, offsets: np.ndarray, beginnings: tuple):
    """:func:`features` of texts, in slices."""
    parts = []
    for a, b in slices(offsets, SLICE):
        row, column, value = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], beginnings)
        parts.append(((row + a).astype(np.int32), column.astype(np.int32), value.astype(np.float32)))
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32)
    return tuple(np.concatenate(p) for p in zip(*parts))


def logistic(x: np.ndarray) -> np.ndarray:
    """The logistic function."""
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_arrays(row, column, value, grade: np.ndarray, levels: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by maximum likelihood (Adam on all rows at once).

    Every grade weighs the same in all, however many rows it has. Thresholds are the first one and positive steps, so they stay in order.
    """
    n, width = len(grade), (1 << BITS) + SHARES
    # Features of one or two texts would only let the model learn these by heart.
    often = np.flatnonzero(np.bincount(column, minlength=width)[column] >= LEAST_TEXTS)
    row, column, value = row[often], column[often], value[often].astype(np.float32)
    used, column = np.unique(column, return_inverse=True)
    each = 1.0 / (levels * np.bincount(grade, minlength=levels)[grade])
    # Features that lean to one end of the grades come in larger units, so few texts teach them.
    high = np.bincount(column, weights=(each * grade)[row], minlength=len(used))
    low = np.bincount(column, weights=(each * (levels - 1 - grade))[row], minlength=len(used))
    unit = np.where(used < 1 << BITS, np.abs(np.log((high + LEAN / n) / (low + LEAN / n))), SHARE_UNIT)
    value = (value * unit[column]).astype(np.float32)
    weights, cuts = np.zeros(len(used)), np.zeros(levels - 1)
    share = 1.0 - np.arange(1, levels) / levels
    theta = -np.log(share / (1 - share))
    cuts[0] = theta[0]
    cuts[1:] = np.log(np.maximum(np.diff(theta), 1e-3))
    m = [np.zeros_like(weights), np.zeros_like(cuts)]
    v = [np.zeros_like(weights), np.zeros_like(cuts)]
    for t in range(1, rounds + 1):
        theta = np.cumsum(np.concatenate([cuts[:1], np.exp(cuts[1:])]))
        score = np.bincount(row, weights=weights[column] * value, minlength=n)
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        upper, lower = logistic(edges[grade + 1] - score), logistic(edges[grade] - score)
        upper[grade == levels - 1], lower[grade == 0] = 1.0, 0.0
        chance = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper), lower * (1 - lower)
        slope = (du - dl) / chance * each  # of the loss by the score
        by_theta = np.zeros(levels - 1)
        np.add.at(by_theta, np.minimum(grade, levels - 2), np.where(grade < levels - 1, -du / chance * each, 0.0))
        np.add.at(by_theta, np.maximum(grade - 1, 0), np.where(grade > 0, dl / chance * each, 0.0))
        by_cut = np.array([by_theta.sum(), *(np.exp(cuts[k]) * by_theta[k:].sum() for k in range(1, levels - 1))])
        by_weight = np.bincount(column, weights=slope[row] * value, minlength=len(used)) + PENALTY / n * weights
        for x, g, a, b in zip((weights, cuts), (by_weight, by_cut), m, v):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x -= RATE * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-8)
    out = np.zeros(width, np.float32)
    out[used] = weights * unit
    return out, np.cumsum(np.concatenate([cuts[:1], np.exp(cuts[1:])]))


def fit(docs: DataFrame, labels: DataFrame, grade: str, doc: str = "doc_id", text: str = "text",
        beginnings: tuple = WORDS, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model | None:
    """A model of the whole-number ``grade`` of ``labels``, fitted on a sample of at most ``sample`` labelled documents.

    The sample is the labels with the least hash of their id; each grade gets an equal
    share of it, so rare grades are learned too, and what one grade leaves free is not
    given to another. Null ids, grades and texts teach nothing; a document with several
    labels has the largest grade. Without labels there is no model. More than
    ``MOST_GRADES`` grades are an error.
    """
    known = labels.filter(F.col(quoted(grade)).isNotNull() & F.col(quoted(doc)).isNotNull()).groupBy(F.col(quoted(doc)).alias("__id")).agg(
        F.max(F.col(quoted(grade)).cast("int")).alias("__grade"))
    grades = sorted(r[0] for r in known.select("__grade").distinct().limit(MOST_GRADES + 1).collect())
    if len(grades) > MOST_GRADES:
        raise ValueError(f"more than {MOST_GRADES} grades")
    if not grades:
        return None
    if len(grades) == 1:
        return Model(np.zeros((1 << BITS) + SHARES, np.float32), np.zeros(0), grades, beginnings)
    # Bounded: top rows of each grade, by a limit that Spark applies in every task first.
    chosen = None
    for g in grades:
        part = known.filter(F.col("__grade") == g).orderBy(F.xxhash64("__id"), "__id").limit(sample // len(grades))
        chosen = part if chosen is None else chosen.union(part)
    rows = docs.select(F.col(quoted(doc)).alias("__id"), F.col(quoted(text)).alias("__text")).filter("__text IS NOT NULL").join(F.broadcast(chosen), "__id")
    place = {g: k for k, g in enumerate(grades)}

    def learn(batches):
        parts, levels, first = [], [], 0
        for batch in batches:
            data, offsets, _ = text_buffer(batch.column(0))
            row, column, value = text_features(data, offsets, beginnings)
            parts.append((row + np.int32(first), column, value))
            levels += [place[g] for g in batch.column(1).to_pylist()]
            first += batch.num_rows
        if not levels:
            return
        weights, thresholds = fit_arrays(*(np.concatenate(p) for p in zip(*parts)), np.array(levels), len(grades), rounds)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([thresholds.tolist()])], names=["weights", "thresholds"])

    got = rows.select("__text", "__grade").repartition(1).mapInArrow(learn, "weights binary, thresholds array<double>").collect()
    if not got:
        return None
    return Model(np.frombuffer(bytes(got[0].weights), np.float32), np.array(got[0].thresholds), grades, beginnings)


def grade(docs: DataFrame, model: Model | None, at_least: int, text: str = "text") -> DataFrame:
    """Add ``expected`` (grade), ``tail`` (probability of grade ``at_least`` or more) and ``likely`` (the most probable grade).

    A text that is null or has no word or mark gets the least grade with certainty;
    without a model all three are null. Whole texts of any length are scored, repeated
    rows alike; empty tables give no rows; other columns pass through, save those
    named like an output.
    """
    plain = None if model is None else tuple(model)

    def run(batch):
        n = batch.num_rows
        if plain is None:
            return [pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.int32())]
        weights, thresholds, grades, beginnings = plain
        data, offsets, _ = text_buffer(batch.column(batch.schema.names.index(text)))
        score, some = np.zeros(n), np.zeros(n, bool)
        for a, b in slices(offsets, SLICE):
            row, column, value = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], beginnings)
            score[a:b] = np.bincount(row, weights=weights[column] * value, minlength=b - a)
            some[a:b] = np.bincount(row, minlength=b - a) > 0
        above = np.stack([np.ones(n), *(np.where(some, logistic(score - t), 0.0) for t in thresholds), np.zeros(n)], axis=1)
        chance = -np.diff(above, axis=1)
        expected = chance @ np.array(grades, np.float64)
        first = next((k for k, g in enumerate(grades) if g >= at_least), len(grades))
        likely = np.array(grades, np.int32)[chance.argmax(axis=1)]
        return [pa.array(expected), pa.array(above[:, first] if first else np.ones(n)), pa.array(likely)]

    return extend(docs, "expected double, tail double, likely int", run, text)
