"""The FM-index and decontamination against brute force."""

import random

import numpy as np
import pytest

from quartermill.llm import decontam
from quartermill.llm.decontam import WORD, FMIndex, WaveletMatrix, decontaminate, suffix_array

RNG = random.Random(2)


def test_wavelet_matrix_counts():
    values = np.array([RNG.randrange(11) for _ in range(300)])
    m = WaveletMatrix(values, 4)
    at = np.arange(301)
    for s in range(11):
        assert m.rank(np.full(301, s), at).tolist() == [int((values[:k] == s).sum()) for k in range(301)]
    symbol, before = m.access(np.arange(300))
    assert symbol.tolist() == values.tolist() and before.tolist() == [int((values[:k] == values[k]).sum()) for k in range(300)]


def test_index_finds_every_place():
    text = np.array([RNG.choice([0, 1, 1, 2, 3]) for _ in range(500)])
    order = suffix_array(np.append(text, 0))
    assert sorted(order.tolist()) == list(range(501))
    index = FMIndex(text, 5)
    for phrase in ([1], [1, 1], [2, 1, 3], [1, 1, 1, 1], [4], [3, 2, 1, 1]):
        first, last = index.search(np.array([phrase]))
        found = sorted(index.locate(np.arange(first[0], last[0])).tolist())
        assert found == [k for k in range(500) if text[k : k + len(phrase)].tolist() == phrase]


def brute(text, items, window=10):
    words = WORD.findall((text or "").encode().lower())
    hit, names = set(), set()
    for name, item in items:
        w = WORD.findall((item or "").encode().lower())
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if n else ():
            for at in range(len(words) - n + 1):
                if words[at : at + n] == w[k : k + n]:
                    hit.update(range(at, at + n))
                    names |= {str(name)} if name is not None else set()
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("shard", [1 << 20, 300])
def test_matches_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(decontam, "SHARD_BYTES", shard)
    some = lambda n: " ".join(RNG.choice("ab cd ef été x1 Zz".split()) for _ in range(n))
    items = [(1, some(14)), (2, some(12)), (3, "ab cd ef"), (4, None), (5, "..."), (None, "ef ef ab"), (1, some(11)), (12, "ab-cd, EF!")]
    texts = [None, "", "!?", "AB; cd\nEF", some(3), *[some(60) for _ in range(20)], "x " * 50 + items[0][1].upper() + " y" * 9, some(4000)]
    docs = spark.createDataFrame([(k, t, "z", 1) for k, t in enumerate(texts)] + [(3, texts[3], "z", 2)], "doc_id long, text string, N_HIT string, clean_text int")
    got = decontaminate(docs.repartition(3), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert (r.n_words, r.n_hit, r.hit_items) == brute(texts[r.doc_id], items), r.doc_id
        if texts[r.doc_id] is None:
            assert r.clean_text is None
        elif not r.n_hit:
            assert r.clean_text == texts[r.doc_id] and not r.removal
        else:
            assert len(WORD.findall(r.clean_text.encode())) <= r.n_words - r.n_hit + len(r.removal)
            cut = "".join(texts[r.doc_id][a:b] for a, b in r.removal)
            assert len(r.clean_text) == len(texts[r.doc_id]) - len(cut)


def test_phrases_are_compact_and_know_their_items():
    import tracemalloc

    rng = random.Random(8)
    items = [(str(k % 50), " ".join(rng.choice(["a", "b", "c"]) for _ in range(rng.randrange(16)))) for k in range(80)]
    vocabulary, shortest, groups, names = decontam.Phrases.plain(items, 10)
    want: dict = {}
    for at, (_, text) in enumerate(items):
        w = text.split()
        for k in range(len(w) - min(10, len(w)) + 1) if w else ():
            want.setdefault(tuple(w[k : k + min(10, len(w))]), set()).add(at)
    spelled = {v: k.decode() for k, v in vocabulary.items()}
    got = {tuple(spelled[i] for i in row): owners[begins[k] : begins[k + 1]].tolist() for rows, begins, owners in groups for k, row in enumerate(rows.tolist())}
    assert got == {k: sorted(v) for k, v in want.items()} and shortest == min(map(len, want))
    # Two megabytes of text take a bounded multiple of it.
    words = [f"w{k}" for k in range(30_000)]
    large = [(str(k), " ".join(rng.choices(words, k=400))) for k in range(800)]
    size = sum(len(t) for _, t in large)
    tracemalloc.start()
    plain = decontam.Phrases.plain(large, 10)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 15 * size and peak < 60 * size and sum(len(g[0]) for g in plain[2]) == 800 * 391


def test_a_benchmark_beyond_the_bound_is_an_error(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "é b")], "item_id long, text string")
    assert decontaminate(docs, items, most_bytes=4).count() == 1
    with pytest.raises(ValueError, match="4 bytes of text, more than 3"):
        decontaminate(docs, items, most_bytes=3)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate(docs, items).collect()] == [0]
    assert decontaminate(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []
