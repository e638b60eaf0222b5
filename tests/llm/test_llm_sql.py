"""Queries of the training-data package against their SQL."""

import pytest
from compare import compare, connect

from quartermill.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    class Both:
        sql = SQL[name]

        def __call__(self, session, folder):
            return QUERIES[name](session, folder)

    ok, note = compare(spark, connect(FOLDER), Both(), FOLDER)
    assert ok, note


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"op12_whitening"}))
def test_every_document_has_a_row(spark, name):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert QUERIES[name](spark, FOLDER).select("doc_id").exceptAll(docs.select("doc_id")).isEmpty()
    assert QUERIES[name](spark, FOLDER).count() == docs.count()


def test_every_vector_has_its_components(spark):
    import numpy as np

    rows = QUERIES["op12_whitening"](spark, FOLDER).toPandas()
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet").toPandas()
    x = np.floor(np.stack(vectors.embedding).astype(float) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    assert len(rows) == 16 * len(vectors) and set(rows.component) == set(range(1, 17)) and (rows.n == n).all()
    deviation = dict(zip(vectors.vec_id, ((n * x - s) ** 2).sum(1)))
    assert all(deviation[v] == d for v, d in zip(rows.vec_id, rows.deviation))
    assert rows.identity_error.nunique() == 1 and rows.identity_error.iloc[0] < 1e-10
    e, q = np.linalg.eigh(np.cov(fit.T, bias=True))
    want = (x - s / n) @ q[:, ::-1][:, :16] / np.sqrt(e[::-1][:16])
    got = rows.pivot(index="vec_id", columns="component", values="whitened").loc[vectors.vec_id].to_numpy()
    assert np.abs(got * np.sign((got * want).sum(0)) - want).max() < 1e-6
    assert np.allclose(rows.groupby("component").explained.first(), e[::-1][:16] / e.sum(), rtol=1e-10)
