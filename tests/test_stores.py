"""Snapshots, vintages, rollups, ranked files and pattern tables."""

import io
import random
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from quartermill.operators.snapshots import apply_difference, differing_buckets, snapshot_difference
from quartermill.plans import context, rollup
from quartermill.sources import vintages, writers


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


# --- snapshots -------------------------------------------------------------

SCHEMA = "k int, l string, v int, w string"


def test_difference_and_its_application(frame, rows):
    rng = random.Random(3)
    old = [(k, None if k % 9 == 0 else "a", rng.randrange(5), rng.choice([None, "x", "y"])) for k in range(400)]
    new = [r for r in old if r[0] % 50] + [(1000 + k, None, k, None) for k in range(6)]
    new = [(k, l, v + (k % 70 == 1), None if k % 71 == 5 else w) for k, l, v, w in new]
    a, b = frame(SCHEMA, old), frame("w string, v int, l string, k int", [r[::-1] for r in new])
    got = snapshot_difference(a, b, ["k", "l"], buckets=64)
    before, after = {r[:2]: r[2:] for r in old}, {r[:2]: r[2:] for r in new}
    want = [(*k, *after[k], "added") for k in after.keys() - before.keys()] + [(*k, *before[k], "removed") for k in before.keys() - after.keys()]
    want += [(*k, *after[k], "changed") for k in after.keys() & before.keys() if after[k] != before[k]]
    assert set(rows(got, "k", "l", "v", "w", "change")) == set(want) and got.count() == len(want)
    assert set(rows(apply_difference(a, got, ["k", "l"]), "k", "l", "v", "w")) == set(new)


def test_equal_snapshots_and_empty_ones(frame):
    a = frame(SCHEMA, [(1, "a", 2, None), (2, None, None, None)])
    assert differing_buckets(a, a.repartition(3), ["k"], 16).first()["buckets"] == []
    assert snapshot_difference(a, a, ["k"]).isEmpty()
    nothing = frame(SCHEMA, [])
    assert {r["change"] for r in snapshot_difference(nothing, a, ["k"]).collect()} == {"added"}
    assert {r["change"] for r in snapshot_difference(a, nothing, ["k"]).collect()} == {"removed"}
    with pytest.raises(ValueError, match="columns differ"):
        snapshot_difference(a, a.drop("w"), ["k"])


def test_a_repeated_row_more_is_seen(frame):
    one, three = frame(SCHEMA, [(1, "a", 2, None)]), frame(SCHEMA, [(1, "a", 2, None)] * 3)
    assert differing_buckets(one, three, ["k"], 16).first()["buckets"] != []


def test_rows_of_equal_buckets_are_not_shuffled(spark, tmp_path):
    spark.range(5000).selectExpr("id AS k", "id % 7 AS v").write.parquet(str(tmp_path / "old"))
    spark.range(5000).selectExpr("id AS k", "id % 7 + if(id = 77, 1, 0) AS v").write.parquet(str(tmp_path / "new"))
    old, new = (spark.read.parquet(str(tmp_path / n)) for n in ("old", "new"))
    diff = snapshot_difference(old, new, ["k"], buckets=1000)
    assert [tuple(r) for r in diff.collect()] == [(77, 1, "changed")]
    # The rows meet a filter on the differing buckets before any exchange.
    text = plan(diff)
    body = text[text.index("== Physical Plan =="):]
    assert "array_contains" in body and "Join" not in body.split("===== Subqueries =====")[0]


# --- vintages --------------------------------------------------------------

def test_years_are_replaced_whole_or_not_at_all(spark, frame, rows, tmp_path):
    path = str(tmp_path / "v")
    fact = frame("fiscal_year int, v double", [(y, float(k)) for y in (2021, 2022, 2023) for k in range(4)])
    assert vintages.current(spark, path) == (0, {})
    assert vintages.replace_years(fact, path, [2021, 2022, 2023]) == 1
    held = vintages.read_years(spark, path)
    assert vintages.replace_years(fact.withColumn("v", F.col("v") * 10), path, [2023]) == 2
    both = lambda df: rows(df.groupBy("fiscal_year").agg(F.sum("v")))
    assert both(vintages.read_years(spark, path)) == [(2021, 6.0), (2022, 6.0), (2023, 60.0)]
    assert both(held) == [(2021, 6.0), (2022, 6.0), (2023, 6.0)]  # a reader keeps what it saw
    broken = fact.withColumn("v", F.when(F.col("v") == 3, F.raise_error(F.lit("gone")).cast("double")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="gone"):
        vintages.replace_years(broken, path, [2022, 2023])
    assert both(vintages.read_years(spark, path)) == [(2021, 6.0), (2022, 6.0), (2023, 60.0)]
    assert vintages.replace_years(fact.filter("v > 9"), path, [2021]) == 3  # a year may become empty
    assert both(vintages.read_years(spark, path)) == [(2022, 6.0), (2023, 60.0)]
    assert "fiscal_year=2022" not in plan(vintages.read_years(spark, path, [2023]))
    with pytest.raises(FileNotFoundError):
        vintages.read_years(spark, path, [1999])


def test_rollup_answers_and_rebuilds_open_years(spark, frame, rows, tmp_path):
    path = str(tmp_path / "r")
    schema = "site string, mech string, fiscal_year int, quarter int, value double"
    fact = frame(schema, [(f"s{k % 3}", f"m{k % 2}", 2020 + k % 4, 1 + k % 3, float(k)) for k in range(60)])
    with pytest.raises(FileNotFoundError):
        rollup.refresh(fact, path, ["site", "mech"], ["value"], [2023])
    rollup.build(fact, path, ["site", "mech"], ["value"], range(2020, 2024))
    want = rows(fact.groupBy("mech", "fiscal_year").agg(F.sum("value"), F.count("*")))
    assert rows(rollup.answer(spark, path, ["mech", "fiscal_year"], ["value"])) == want
    rollup.refresh(fact.withColumn("value", -F.col("value")), path, ["site", "mech"], ["value"], [2023])
    now = {(m, y): v for m, y, v, _ in rows(rollup.answer(spark, path, ["mech", "fiscal_year"], ["value"]))}
    assert now == {(m, y): -v if y == 2023 else v for m, y, v, _ in want}
    assert rollup.answer(spark, path, ["mech"], ["value"], [2020]).count() == 1
    with pytest.raises(ValueError, match="does not hold"):
        rollup.answer(spark, path, ["age"], ["value"])


# --- ranked files ----------------------------------------------------------

@pytest.mark.parametrize("parts", [1, 7])
def test_positions_in_a_total_order(spark, tmp_path, parts):
    # A third of the rows share the first key.
    df = spark.range(0, 3000, 1, 5).selectExpr("if(id % 3 = 0, 5, id % 100) AS g", "id AS tie")
    path = str(tmp_path / "ranked")
    writers.write_ranked(df, path, [F.desc("g"), "tie"], parts)
    got = writers.read_ranked(spark, path)
    assert "Window" not in plan(got)
    rows_ = sorted((r["position"], r["g"], r["tie"]) for r in got.collect())
    want = sorted(((r["g"], r["tie"]) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    assert rows_ == [(k, *r) for k, r in enumerate(want, 1)]


def test_ranked_files_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    writers.write_ranked(spark.range(0), path, ["id"], 3)
    assert writers.read_ranked(spark, path).collect() == []


# --- pattern tables --------------------------------------------------------

def test_first_pattern_of_a_large_table(frame, rows):
    rules = [(k, f"^n{k}0*$", f"label {k}") for k in range(1, 1001)] + [(0, "special", "first"), (5000, "n", "last"), (5000, "m", "also last")]
    table = frame("priority int, pattern string, label string", rules)
    names = ["n1", "n10", "n1000", "n7 special", "nothing", "m", None, "q", "n1"]
    got = context.pattern_labels(frame("name string", [(n,) for n in names]), "name", table, "label", F.lit("none"))
    want = {"n1": "label 1", "n10": "label 1", "n1000": "label 1", "n7 special": "first", "nothing": "last", "m": "also last", None: "none", "q": "none"}
    assert rows(got) == sorted(((n, want[n]) for n in names), key=lambda r: tuple((v is None, str(v)) for v in r))
    own = context.pattern_labels(frame("name string", [("q",), (None,)]), "name", table.limit(0), "label")
    assert rows(own) == [("q", "q"), (None, None)]
