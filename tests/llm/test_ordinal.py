"""Ordinal regression: its gradient's sense, held-out accuracy, and edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermill.llm.ordinal import WORDS, WORDS_AND_BEGINNINGS, features, fit, fit_arrays, grade

FOLDER = "/root/testdata/sf0.1"


def test_three_grades_are_told_apart_in_order(spark):
    rng = random.Random(1)
    marks = {0: "bad", 1: "fair", 2: "good"}
    rows = [(k, " ".join(rng.choice("a b c d e f".split()) for _ in range(20)) + f" {marks[k % 3]}", k % 3) for k in range(300)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, g) for k, _, g in rows if k < 240], "doc_id long, grade int")
    model = fit(docs, labels, "grade")
    assert model.grades == [0, 1, 2] and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in grade(docs, model, at_least=2).collect()}
    for k, _, g in rows:
        assert got[k].likely == g and abs(got[k].expected - g) < 0.6
        assert (got[k].tail > 0.5) == (g == 2)


def test_thresholds_stay_in_order_on_noise():
    rng = np.random.default_rng(1)
    row = np.repeat(np.arange(60), 3)
    _, theta = fit_arrays(row, rng.integers(0, 50, 180), np.ones(180), rng.integers(0, 5, 60), 5, rounds=40)
    assert (np.diff(theta) > 0).all()


def test_features_do_not_depend_on_neighbours():
    texts = ["Ab ab, CD !!", "", "été été x", "ab"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    row, column, value = features(data, offsets, WORDS_AND_BEGINNINGS)
    assert not (column >= 1 << 18).any() and (features(data, offsets, WORDS)[1] >= 1 << 18).sum() == 3 * 3
    for k, t in enumerate(raw):
        r, c, v = features(np.frombuffer(t, np.uint8), np.array([0, len(t)]), WORDS_AND_BEGINNINGS)
        assert sorted(zip(c, v)) == sorted(zip(column[row == k], value[row == k]))


@pytest.mark.parametrize("label, kinds, least, rate", [("quality", WORDS, 0.25, (0.9, 0.99)), ("toxic", WORDS_AND_BEGINNINGS, 0.4, (0.99, 0.88))])
def test_held_out_documents(spark, label, kinds, least, rate):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    held = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    model = fit(docs, labels.join(held, "doc_id", "left_anti"), label, beginnings=kinds)
    got = grade(docs.join(held, "doc_id").select("doc_id", "text", label), model, at_least=1).withColumn("said", F.col("tail") >= least)
    by = {r[label]: (r.right, r.n) for r in got.groupBy(label).agg(F.avg((F.col("said").cast("int") == F.col(label)).cast("int")).alias("right"), F.count("*").alias("n")).collect()}
    assert by[1][0] >= rate[1] and by[0][0] >= rate[0], by


def test_nulls_repeats_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "good one", "q"), (2, "bad one", "q"), (3, None, "q"), (4, "", "q"), (5, " \n", "q"), (1, "good one", "r"), (None, "good", "q"), (6, "good " * 50000, "q")], "doc_id long, text string, tail string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (3, 1), (1, 0)], "doc_id long, g int")
    got = grade(docs, fit(docs, labels, "g"), at_least=1).collect()
    assert len(got) == 8
    assert {r.doc_id: (r.expected, r.tail, r.likely) for r in got if r.doc_id in (3, 4, 5)} == {k: (0.0, 0.0, 0) for k in (3, 4, 5)}
    assert all(0 <= r.tail <= 1 for r in got)
    assert len({r.tail for r in got if r.text == "good one"}) == 1


def test_too_many_grades_are_an_error(spark):
    docs = spark.range(1001).selectExpr("id AS doc_id", "'a' AS text")
    labels = spark.range(1001).selectExpr("id AS doc_id", "int(id) AS g")
    with pytest.raises(ValueError, match="more than 1000 grades"):
        fit(docs, labels, "g")


def test_no_labels_one_grade_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 2)], "doc_id long, g int")
    assert fit(docs, labels.limit(0), "g") is None
    assert [tuple(r)[2:] for r in grade(docs, None, 1).collect()] == [(None, None, None)]
    one = fit(docs, labels, "g")
    assert [tuple(r)[2:] for r in grade(docs, one, 1).collect()] == [(2.0, 1.0, 2)]
    assert [r.tail for r in grade(docs, one, 3).collect()] == [0.0]
    assert grade(docs.limit(0), one, 1).collect() == []
    assert fit(docs.limit(0), spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, g int"), "g") is None


def small_problem(levels, seed=3):
    """A few texts' features, their grades, and the loss of the model as its docstring has it."""
    import numpy as np

    from quartermill.llm import ordinal

    rng = np.random.default_rng(seed)
    n, features = 60, 6
    grade = rng.integers(0, levels, n)
    grade[:levels] = range(levels)
    row, column = np.nonzero(rng.random((n, features)) < 0.3 + 0.12 * grade[:, None])
    value = rng.uniform(0.2, 1.0, len(row)).astype(np.float32)
    often = np.flatnonzero(np.bincount(column, minlength=features) >= ordinal.LEAST_TEXTS)
    assert len(often) == features
    each = 1.0 / (levels * np.bincount(grade, minlength=levels)[grade])
    high = np.array([(each * grade)[row[column == c]].sum() for c in range(features)])
    low = np.array([(each * (levels - 1 - grade))[row[column == c]].sum() for c in range(features)])
    unit = np.abs(np.log((high + ordinal.LEAN / n) / (low + ordinal.LEAN / n)))

    def loss(weights, theta):
        total = ordinal.PENALTY / n / 2 * float((weights**2).sum())
        for t in range(n):
            score = sum(weights[c] * unit[c] * v for r, c, v in zip(row, column, value) if r == t)
            at_most = [0.0, *(1 / (1 + np.exp(-(x - score))) for x in theta), 1.0]
            total -= each[t] * np.log(at_most[grade[t] + 1] - at_most[grade[t]])
        return total

    return row, column, value, grade, unit, loss


@pytest.mark.parametrize("levels", [2, 4])
def test_the_fit_is_where_the_loss_is_least(levels):
    import numpy as np

    from quartermill.llm import ordinal

    row, column, value, grade, unit, loss = small_problem(levels)
    fitted, theta = ordinal.fit_arrays(row, column, value, grade, levels)
    weights = fitted[:6] / unit
    assert np.all(np.diff(theta) > 0)
    best = loss(weights, theta)

    def slopes(w, t):
        """Of the loss, by differences."""
        at = np.concatenate([w, t])
        out = []
        for k in range(len(at)):
            step = np.zeros(len(at))
            step[k] = 1e-4
            up, down = at + step, at - step
            out.append((loss(up[:6], up[6:]) - loss(down[:6], down[6:])) / 2e-4)
        return np.array(out)

    # Flat there, and steep where the fit began.
    start = -np.log(levels / np.arange(1, levels) - 1)
    assert np.abs(slopes(weights, theta)).max() < 0.02 * np.abs(slopes(np.zeros(6), start)).max()
    rng = np.random.default_rng(1)
    for size in (0.01, 0.1, 1.0):
        for _ in range(20):
            w, t = weights + size * rng.normal(size=6), np.sort(theta + size * rng.normal(size=levels - 1))
            if np.all(np.diff(t) > 1e-6):
                assert loss(w, t) >= best - 1e-4


def test_grades_against_the_plain_formula(spark):
    import numpy as np

    from quartermill.llm import ordinal

    words = "good fine plain bad awful".split()
    docs = [(k, " ".join(words[k % 5 : k % 5 + 2] * 6), k % 5 // 2) for k in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, g int")
    model = ordinal.fit(df, df.select("doc_id", "g"), "g", rounds=200)
    weights, theta, grades, beginnings = model
    for r in ordinal.grade(df, model, 1).collect():
        data = np.frombuffer(r.text.encode(), np.uint8)
        _, column, value = ordinal.features(data, np.array([0, len(data)]), beginnings)
        score = float((weights[column] * value).sum())
        above = [1.0, *(1 / (1 + np.exp(-(score - t))) for t in theta), 0.0]
        chance = [a - b for a, b in zip(above, above[1:])]
        assert r.expected == pytest.approx(sum(c * g for c, g in zip(chance, grades)), abs=1e-5)
        assert r.tail == pytest.approx(above[1], abs=1e-5) and r.likely == grades[int(np.argmax(chance))]


def test_texts_alike_are_graded_alike(spark):
    from quartermill.llm import ordinal

    df = spark.createDataFrame([(k, "same words here" if k % 2 else "other ones", k % 2) for k in range(40)], "doc_id long, text string, g int")
    graded = ordinal.grade(df, ordinal.fit(df, df, "g"), 1).select("text", "expected", "tail", "likely").distinct().collect()
    assert len(graded) == 2
