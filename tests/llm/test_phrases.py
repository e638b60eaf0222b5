"""Collocations against a plain count."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from quartermill.llm import phrases as module
from quartermill.llm.phrases import TwoWay, collocations, context_order


def plain(docs, max_words=4, least=30, covered=80, top=2000):
    """What the docstring says, word by word."""
    import re

    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                for k in range(len(words) - size + 1):
                    f[lang][tuple(words[k : k + size])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            longer = [b for q, b in cand.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= covered * a for b in longer):
                continue
            score, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("symbols,length,depth", [(2, 1, 2), (3, 60, 4), (6, 500, 3), (50, 3000, 5)])
def test_index_lists_every_phrase_with_its_count(symbols, length, depth):
    text = np.append(np.random.default_rng(length).integers(0, symbols, length), 0)
    got = {}
    for words, count in TwoWay(text, symbols, depth).grow(lambda words, left: np.ones(len(words), bool)):
        for w, c in zip(words.tolist(), count.tolist()):
            assert tuple(w) not in got
            got[tuple(w)] = c
    want = Counter()
    for size in range(2, depth + 1):
        for k in range(len(text) - size + 1):
            if text[k : k + size].all():
                want[tuple(text[k : k + size].tolist())] += 1
    assert got == want


def test_order_by_some_symbols():
    text = np.append(np.random.default_rng(3).integers(0, 3, 200), 0)
    for depth in (1, 2, 3, 4, 5):
        keys = [tuple((text[k : k + depth].tolist() + [0] * depth)[:depth]) for k in range(len(text))]
        assert [keys[k] for k in context_order(text, depth)] == sorted(keys)


def corpus(seed, rows):
    rng = np.random.default_rng(seed)
    vocabulary = ["Ab", "ab", "cé", "d", "E", "日本", "long-word-of-many-bytes", "x\x00y", "f", "g"]
    odds = np.array([9, 9, 5, 5, 4, 3, 3, 2, 1, 1]) / 42
    out = []
    for k in range(rows):
        words = rng.choice(vocabulary, rng.integers(0, 60), p=odds)
        gaps = rng.choice([" ", "  ", "\t", ", ", ".", "\n", " \r\n"], len(words) + 1, p=[0.7, 0.06, 0.06, 0.06, 0.04, 0.04, 0.04])
        text = gaps[0] + "".join(w + g for w, g in zip(words, gaps[1:]))
        out.append(([None, "en", "de", "und"][k % 4], text))
    return out + [("en", None), ("en", ""), (None, " \t."), ("xx", "alone")] + out[:5]


@pytest.mark.parametrize("shard", [300, 1 << 20])
def test_same_as_plain_counts(frame, monkeypatch, shard):
    monkeypatch.setattr(module, "SHARD_BYTES", shard)
    docs = corpus(1, 120)
    df = frame("lang string, text string", docs).repartition(3)
    assert found(collocations(df, least=8)) == plain(docs, least=8)
    assert found(collocations(df, max_words=3, least=12, covered=50, top=7)) == plain(docs, 3, 12, 50, 7)


def test_two_words_and_no_threshold(frame):
    docs = corpus(2, 12)
    assert found(collocations(frame("lang string, text string", docs), max_words=2, least=1)) == plain(docs, 2, 1)


def test_counts_past_64_bits(frame, spark, monkeypatch):
    # 2,000,000 times these counts is above 2^63; the counting itself is replaced.
    from pyspark.sql import functions as F

    huge = 5_000_000_000_000_000
    rows = [("en", "", 0, huge), ("en", "a", 1, huge - 1), ("en", "b", 1, huge - 3), ("en", "a b", 2, huge - 7)]
    monkeypatch.setattr(module, "counted", lambda *a: spark.createDataFrame(rows, "lang string, phrase string, words int, n long"))
    got = found(collocations(frame("lang string, text string", [("en", "a b")]).filter(F.lit(True))))
    assert got == [("en", 1, "a b", huge - 7, huge - 1, huge - 3, huge, 2_000_000 * (huge - 7) // (2 * huge - 4))]


def test_empty_tables_and_other_columns(frame):
    assert found(collocations(frame("lang string, text string", []))) == []
    assert found(collocations(frame("lang string, text string", [("en", None), (None, "")]))) == []
    df = frame("phrase int, lang string, text string, n int, hash int", [(1, "en", "a b", 2, 3)] * 30)
    assert found(collocations(df)) == [("en", 1, "a b", 30, 30, 30, 60, 1_000_000)]


def test_ties_take_the_byte_order(frame):
    df = frame("lang string, text string", [("en", "z y. c a. é x. B d")] * 30)
    assert [r[2] for r in found(collocations(df))] == ["b d", "c a", "z y", "é x"]
