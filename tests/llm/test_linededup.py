"""Line de-duplication against brute force, by both ways to probe."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import GroupedData

from quartermill.llm.linededup import LineIndex, drop_repeated_lines

BLANK = " \t\n\x0b\x0c\r"


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(1)
    h1, h2 = (rng.integers(-(2**63), 2**63 - 1, 5000) for _ in range(2))
    index = LineIndex.build(h1, h2, np.arange(5000), -np.arange(5000))
    index = LineIndex.unpack(*index.pack())
    assert sorted(index.probe(h1, h2).tolist()) == list(range(5000))
    assert index.counts[index.probe(h1, h2)].tolist() == list(range(5000))
    assert (index.probe(h1, h2 + 1) == -1).all() and (index.probe(h2, h1) == -1).all()
    empty = LineIndex.unpack(*LineIndex.build(*[np.zeros(0, np.int64)] * 4).pack())
    assert empty.probe(h1[:3], h2[:3]).tolist() == [-1, -1, -1]


def brute(docs, min_chars=20, min_docs=3):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(BLANK).translate(lower)
    holders = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    gone = {k: max(x for x in h if x is not None) for k, h in holders.items() if len(h) >= min_docs}
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), d) == d]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": -1, "keys_per_shard": 3, "group": 5}])
def test_matches_brute_force(spark, options):
    rng = random.Random(4)
    pool = [f"line number {k} with words é" for k in range(30)] + ["short", "", "  ", "É" * 20, "é" * 19, " " + "x" * 20]
    text = lambda n: "\n".join(rng.choice(["", " ", "\t"]) + rng.choice([str.upper, str])(rng.choice(pool)) + rng.choice(["", "\r", " "]) for _ in range(n))
    hot = "a very common line of the whole corpus"
    docs = [(k, text(rng.randint(0, 6)) + ("\n" + hot if k % 3 else "")) for k in range(60)]
    docs += [(60, None), (61, ""), (None, hot + "\nmine alone in the null row"), (7, docs[7][1]), (62, "\n".join([hot] * 500)), (63, hot)]
    df = spark.createDataFrame([(*d, 5, "q") for d in docs], "doc_id long, text string, n_lines int, `od.d` string").repartition(5)
    got = drop_repeated_lines(df, **options)
    assert got.columns.count("n_lines") == 1 and "od.d" in got.columns
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()], key=str) == brute(docs)


def test_no_group_exceeds_its_bound_when_most_lines_are_unique(spark, monkeypatch):
    seen, cogroup = [], GroupedData.cogroup
    monkeypatch.setattr(GroupedData, "cogroup", lambda self, other: seen.append(self._df) or cogroup(self, other))
    common = [f"a line that is in every document, {k}" for k in range(6)]
    own = lambda d, n: "\n".join([*common, *(f"line {k} that only document {d} has" for k in range(n))])
    docs = [(d, own(d, 100)) for d in range(40)] + [(40, own(40, 3000))] + [(None, own("without id", 20))] * 50 + [(41, own(41, 20))] * 50
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = drop_repeated_lines(df, broadcast_bytes=-1, keys_per_shard=3, group=400)
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()], key=str) == brute(docs)
    sizes = [r["count"] for r in seen[0].groupBy("shard", "salt").count().collect()]
    assert sum(sizes) > 7000 and max(sizes) <= 400


def test_empty_table(spark):
    assert drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
