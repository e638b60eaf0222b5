"""Top-k search against brute force."""

import random

import pytest

from quartermill.llm.knn import top_k

SCHEMA = "id long, v array<long>"


def brute(data, queries, k):
    rows = {(i, tuple(v)) for i, v in data if i is not None and v is not None and None not in v}
    asked = {}
    for i, v in queries:
        if i is not None and v is not None and None not in v:
            asked[i] = min(asked.get(i, tuple(v)), tuple(v))
    out = set()
    for q, v in asked.items():
        best = sorted({(-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q})[:k]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


def run(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("options", [{}, {"pivots": 5, "group": 7, "chunk": 40}, {"pivots": 1}])
def test_matches_brute_force_with_hot_cell_and_ties(spark, options):
    rng = random.Random(5)
    hot = [rng.randint(-50, 50) for _ in range(8)]
    data = [(i, hot if i % 3 == 0 else [rng.randint(-200, 200) for _ in range(8)]) for i in range(400)]
    queries = [r for r in data if r[0] % 20 == 0]
    got = run(top_k(spark.createDataFrame(data, SCHEMA).repartition(7), spark.createDataFrame(queries, SCHEMA), **options))
    assert got == brute(data, queries, 5) and len(got) == 100


def test_clusters_prune_and_stay_exact(spark):
    rng = random.Random(6)
    centres = [[rng.randint(-3000, 3000) for _ in range(6)] for _ in range(9)]
    data = [(i, [c + rng.randint(-9, 9) for c in centres[i % 9]]) for i in range(360)]
    queries = data[::30]
    got = run(top_k(spark.createDataFrame(data, SCHEMA), spark.createDataFrame(queries, SCHEMA), k=3, pivots=20, group=4, chunk=50))
    assert got == brute(data, queries, 3)


def test_nulls_repeats_short_vectors_and_extra_columns(spark):
    data = [(1, [1, 2]), (1, [1, 2]), (2, [3]), (3, None), (4, [None, 1]), (None, [9, 9]), (5, []), (6, [1, 2]), (6, [1, 2])]
    queries = [(1, [1, 2]), (1, [5, 5]), (7, [0, 1, 4]), (8, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], SCHEMA + ", rank string, score int")
    got = run(top_k(df, spark.createDataFrame(queries, SCHEMA)))
    assert got == {(1, 1, 6, 5), (1, 2, 2, 3), (1, 3, 5, 0), (7, 1, 1, 2), (7, 2, 6, 2), (7, 3, 2, 0), (7, 4, 5, 0)}


def test_large_values_are_exact_and_clamped(spark):
    big = 1 << 40
    data = [(1, [big, 1]), (2, [big, 0]), (3, [1 << 28, 3])]
    got = run(top_k(spark.createDataFrame(data, SCHEMA), spark.createDataFrame([(9, [1 << 20, 1]), (8, [big, big])], SCHEMA)))
    assert {(9, 1, 1, (1 << 60) + 1), (9, 2, 2, 1 << 60), (9, 3, 3, (1 << 48) + 3)} <= got
    assert {(8, 1, 1, (1 << 63) - 1), (8, 2, 2, (1 << 63) - 1)} <= got


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, [1])], SCHEMA)
    assert run(top_k(none, some)) == run(top_k(some, none)) == run(top_k(some, some)) == set()


def test_many_queries_are_taken_a_few_at_a_time(spark, monkeypatch):
    from quartermill.llm import knn

    rng = random.Random(8)
    data = [(i, [rng.randint(-90, 90) for _ in range(5)]) for i in range(300)]
    monkeypatch.setattr(knn, "QUERIES", 7)
    got = run(top_k(spark.createDataFrame(data, SCHEMA), spark.createDataFrame(data[::2], SCHEMA), k=4, pivots=3))
    assert got == brute(data, data[::2], 4)


def test_the_query_leaves_out_what_is_not_finite(spark, tmp_path):
    from quartermill.llm.queries import QUERIES

    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25]), (50, [nan, 1.0]), (100, [inf, 1.0]), (150, [-inf, 1.0]), (200, None), (250, [None, 1.0]), (1, [1.0, -0.001]), (2, [-3.0, 2.0]), (3, [nan, nan]), (300, [2.0**45, 1.0])]
    spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = run(QUERIES["op1_top_k"](spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score"))
    import math

    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    assert got == brute(whole, [r for r in whole if r[0] % 50 == 0], 5) and {r[0] for r in got} == {0, 300}
