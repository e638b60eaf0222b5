"""Passages repeated across documents against a plain search."""

import re
from collections import defaultdict

import numpy as np
import pytest

from quartermill.llm.substrings import COVERS, cover_of, drop_repeated_spans


def plain(rows, window):
    """(id, words, removed, kept text) of each row."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    owner = defaultdict(set)
    for (key, _), w in zip(rows, words):
        if key is not None:
            for k in range(len(w) - window + 1):
                owner[tuple(w[k : k + window])].add(key)
    least = {run: min(keys) for run, keys in owner.items()}
    out = []
    for (key, text), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1) if key is not None else ():
            if least[tuple(w[k : k + window])] < key:
                gone.update(range(k, k + window))
        kept = None if text is None else " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((key, len(w), len(gone), kept))
    return sorted(out, key=str)


def found(df, doc_id="doc_id"):
    return sorted((tuple(r) for r in df.select(doc_id, "n_words", "n_removed", "kept_text").collect()), key=str)


def test_covers_have_every_difference():
    for period, cover in COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    for window in range(1, 200):
        assert 1 <= cover_of(window)[0] <= window


def planted(seed, window, rows):
    """Texts of a small vocabulary with passages of other ones at any offset."""
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(rows):
        w = [f"w{x}" for x in rng.integers(0, 10**6, rng.integers(0, 4 * window))]
        for _ in range(rng.integers(0, 3)):
            if texts and (other := texts[rng.integers(len(texts))]):
                a = rng.integers(0, len(other))
                passage = other[a : a + rng.integers(1, 3 * window)]
                at = rng.integers(0, len(w) + 1)
                w[at:at] = passage
        texts.append(w)
    blanks = [" ", "  ", "\n", "\t", "\r\n", "\x0b"]
    return ["".join(x + blanks[rng.integers(len(blanks))] for x in w) for w in texts]


@pytest.mark.parametrize("window", [1, 2, 5, 12, 50])
def test_same_as_plain_search(frame, window):
    texts = planted(window, window, 60)
    ids = np.random.default_rng(7).permutation(60).tolist()
    rows = list(zip(ids, texts)) + [(100, texts[3]), (-5, texts[4]), (101, None), (102, ""), (None, texts[5]), (3, texts[9]), (3, texts[9])]
    df = frame("doc_id long, text string", rows).repartition(3)
    assert found(drop_repeated_spans(df, window=window)) == plain(rows, window)


@pytest.mark.parametrize("shift", range(0, 31, 3))
def test_any_offset_of_a_single_window(frame, shift):
    passage = " ".join(f"p{k}" for k in range(50))
    rows = [(1, " ".join(f"a{k}" for k in range(17)) + " " + passage), (2, " ".join(f"b{k}" for k in range(shift)) + " " + passage + " end"), (3, passage[:-1])]
    got = found(drop_repeated_spans(frame("doc_id long, text string", rows)))
    assert got == plain(rows, 50) and got[1][2] == 50 and got[2][2] == 0


def test_repeats_within_a_document_and_overlaps(frame):
    a = " ".join(["x"] * 300)
    rows = [(1, a), (2, a + " y " + a), (3, " ".join(["x"] * 49)), (0, a[:97])]
    assert found(drop_repeated_spans(frame("doc_id long, text string", rows))) == plain(rows, 50)


def test_text_ids_spans_and_other_columns(frame):
    p = " ".join(f"p{k}" for k in range(50))
    rows = [("b", f"one {p} two", 1, 7), ("a", p, 2, 8), ("é", "", 3, 9)]
    df = frame("`doc.id` string, text string, n_words int, id int", rows)
    out = drop_repeated_spans(df, doc_id="doc.id")
    assert out.columns == ["doc.id", "text", "id", "n_words", "n_removed", "removal", "kept_text"]
    by = {r["doc.id"]: r for r in out.collect()}
    assert by["b"]["kept_text"] == "one two" and [tuple(s) for s in by["b"]["removal"]] == [(1, 51)] and by["b"]["id"] == 7
    assert by["a"]["kept_text"] == p and by["a"]["removal"] == [] and by["é"]["n_words"] == 0


def test_a_large_group_of_copies_and_a_common_passage(frame):
    common = " ".join(f"c{k}" for k in range(60))
    rows = [(k, common) for k in range(300)] + [(1000 + k, f"d{k} e{k} {common} f{k}") for k in range(300)]
    assert found(drop_repeated_spans(frame("doc_id long, text string", rows).repartition(5))) == plain(rows, 50)


def test_empty_table_and_a_long_text(frame):
    assert found(drop_repeated_spans(frame("doc_id long, text string", []))) == []
    long = " ".join(str(k % 70_000) for k in range(200_000))
    rows = [(5, long), (2, "17 " * 60), (1, " ".join(str(k) for k in range(100, 180)))]
    assert found(drop_repeated_spans(frame("doc_id long, text string", rows))) == plain(rows, 50)
