"""Near-duplicate classes against brute force, and the signatures' expectation."""

import random
from collections import Counter

import numpy as np
import pytest

from quartermill.llm import neardup
from quartermill.llm.components import connected_components
from quartermill.llm.neardup import keep_one, mix, near_duplicates, shingles, signatures


def test_signatures_agree_as_often_as_multisets_are_alike():
    rng = np.random.default_rng(1)
    for _ in range(3):
        keys = rng.integers(1, 2**63, 60)
        a = {int(k): int(rng.integers(1, 12)) for k in keys[:50]}
        b = {int(k): (max(0, a[int(k)] + int(rng.integers(-1, 3))) if int(k) in a else 3) for k in keys[5:]}
        both = set(a) | set(b)
        alike = sum(min(a.get(k, 0), b.get(k, 0)) for k in both) / sum(max(a.get(k, 0), b.get(k, 0)) for k in both)
        rates = []
        for r in range(30):
            bags = [np.sort(mix(np.concatenate([np.full(c, k, np.uint64) for k, c in x.items() if c]) + np.uint64(r))) for x in (a, b)]
            p = signatures(np.concatenate(bags), np.cumsum([0, *map(len, bags)]))
            rates.append((p[0] == p[1]).mean())
        assert abs(np.mean(rates) - alike) < 4 * np.sqrt(alike * (1 - alike) / 256 / 30) + 1e-3


def test_signatures_of_one_document_do_not_depend_on_others():
    bags = [shingles(t.encode(), 5) for t in ("a b", "a b c d e f g " * 30, "", "x y z " * 300)]
    bounds = np.cumsum([0, *map(len, bags)])
    together = signatures(np.concatenate(bags), bounds)
    for k, bag in enumerate(bags):
        alone = signatures(bag, np.array([0, len(bag)]))
        assert (alone[0] == together[k]).all()
    assert np.isinf(together[2]).all() and not np.isinf(together[[0, 1, 3]]).any()


def test_signatures_do_not_depend_on_the_number_of_shingles():
    """A union's register is the earlier one of its parts', to the bit, on both sides of 100 shingles."""
    rng = np.random.default_rng(5)
    for few, more in ((60, 50), (99, 1), (70, 130), (1, 400)):
        for repeats in (1, 3):
            keys = np.unique(rng.integers(1, 2**63, few + more).astype(np.uint64))
            bags = [np.sort(np.repeat(k, repeats)) for k in (keys[:few], keys[few:], keys)]
            a, b, both = signatures(np.concatenate(bags), np.cumsum([0, *map(len, bags)]))
            assert (np.minimum(a, b) == both).all()


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(200 + rng.randrange(40), 200 + rng.randrange(40)) for _ in range(25)] + [(9, 9), (3, 2)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute(docs):
    bags = [Counter(shingles((t or "").encode(), 5).tolist()) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(bags):
        for j in range(i):
            b = bags[j]
            m = sum((a & b).values())
            if a and b and 5 * m >= 4 * (sum(a.values()) + sum(b.values()) - m):
                parent[find(i)] = find(j)
    least = {}
    for k, (d, _) in enumerate(docs):
        if d is not None:
            least[find(k)] = min(least.get(find(k), d), d)
    return [(d, least.get(find(k)) if bags[k] else d) for k, (d, _) in enumerate(docs)]


def corpus():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 150)))) for k in range(40)]
    for k in range(40, 110):  # a large group at all degrees of likeness
        own = list(base)
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(len(own))] = rng.choice(words)
        docs.append((k, " ".join(own)))
    docs += [(200, None), (201, ""), (202, "..."), (203, "a b"), (204, "A, b!"), (None, docs[3][1]), (3, docs[3][1]), (3, docs[5][1] + " more"), (205, "..."), (206, docs[50][1].upper())]
    docs += [(210, "ab " * 40), (211, "ab " * 44), (212, "ab " * 90), (220, " ".join(words) * 30), (221, " ".join(words) * 30 + " end")]
    return docs


@pytest.mark.parametrize("block, bucket", [(neardup.SHINGLES_PER_BLOCK, neardup.BLOCK), (900, 8)])
def test_classes_match_brute_force(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(neardup, "BLOCK", bucket)
    docs = corpus()
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, h int, class_id string").repartition(6)
    got = sorted(((r.doc, r.class_id) for r in near_duplicates(df, block=block).collect()), key=str)
    assert got == sorted(brute(docs), key=str)


def test_one_document_of_each_class_stays(spark):
    docs = [d for d in corpus() if not (d[1] or "").endswith(" more")]  # else two classes have the same id
    kept = keep_one(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, label int").repartition(3)).collect()
    assert set(r.doc_id for r in kept) >= {200, 201, 202, 203, 205, 212} and 204 not in {r.doc_id for r in kept}
    classes = dict(zip(docs, (c for _, c in brute(docs))))
    with_words = [(r.doc_id, r.text) for r in kept if r.text and r.text != "..."]
    assert sorted(classes[k] for k in with_words) == sorted({c for (d, t), c in classes.items() if t and t != "..."})
    twice = spark.createDataFrame([(1, "same text of five words"), (1, "same text of five words"), (2, None), (2, None)], "doc_id long, text string")
    assert sorted(tuple(r) for r in keep_one(twice).collect()) == [(1, "same text of five words"), (2, None)]


def test_empty_table(spark):
    assert keep_one(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_texts_of_a_large_group_go_out_about_once(spark, monkeypatch):
    rng = random.Random(12)
    words = [f"w{k}" for k in range(500)]
    base = [rng.choice(words) for _ in range(200)]
    docs = []
    for k in range(400):
        own = list(base)
        if k % 4:
            own[rng.randrange(200)] = rng.choice(words)
        docs.append((k, " ".join(own) + f" end{k}"))
    sent = []
    plain = neardup.grouped

    def counted(df, keys, solve, schema):
        if keys == ["label", "i", "j"]:
            sent.append(df.count())
        return plain(df, keys, solve, schema)

    monkeypatch.setattr(neardup, "grouped", counted)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    # Ten texts to a block: 40 blocks, to each of which every text used to go.
    got = near_duplicates(df, block=2000).collect()
    assert {r.class_id for r in got} == {0} and len(got) == 400
    assert sum(sent) < 3 * 400
