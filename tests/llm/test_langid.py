"""Rank-order language profiles against a plain version, and on held-out documents."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermill.llm import langid
from quartermill.llm.langid import fold, identify, learn
from quartermill.llm.queries import QUERIES


def plain_grams(text):
    out = Counter()
    for word in "".join(chr(c) if (c := fold(ord(x))) != 32 else " " for x in text or "").split():
        padded = f" {word} "
        for n in (1, 2, 3):
            out.update(padded[k : k + n] for k in range(len(padded) - n + 1) if padded[k : k + n] != " ")
    return out


def code(gram):
    out = 0
    for c in gram:
        out = out * 65536 + ord(c)
    return out


def ranked(counts, most):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:most]]


def plain(docs, asked, most):
    sums = {}
    for text, lang in docs:
        if text is not None and lang is not None:
            sums.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {lang: {g: k for k, g in enumerate(ranked(c, most))} for lang, c in sums.items()}
    out = []
    for text in asked:
        mine = ranked(plain_grams(text), most)
        far = {lang: sum(abs(p[g] - k) if g in p else most for k, g in enumerate(mine)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get) if mine and far else "und"
        out.append((best, 1 - far[best] / (len(mine) * most) if best != "und" else 0.0))
    return profiles, out


TEXTS = [("Der Hund und die Katze, der Hund!", "de"), ("le chien et le chat ÉTÉ", "fr"), ("the dog and the cat", "en"), ("den Hund " * 30, "de"),
         (None, "de"), ("no language at all", None), ("", "en"), ("un été à la plage", "fr"), ("X", "en"), ("the 𐌰𐌱 letters", "en")]
ASKED = [*[t for t, _ in TEXTS], "123 !!", "ß", "中文", "𐌰𐌱", "the\u0000dog", "Ⅷ ２", "und der " * 2000]


@pytest.mark.parametrize("most", [5, 400])
def test_matches_plain_version(spark, monkeypatch, most):
    monkeypatch.setattr(langid, "CHARS", 40)  # long texts are counted in parts
    docs = spark.createDataFrame(TEXTS, "text string, lang string").repartition(3)
    profiles = learn(docs, "text", "lang", profile=most)
    expected, answers = plain(TEXTS, ASKED, most)
    assert {n: [*map(int, c)] for n, c in profiles} == {n: [code(g) for g in p] for n, p in expected.items()}
    asked = spark.createDataFrame([(k, t, "zz") for k, t in enumerate(ASKED)], "n int, text string, SCORE string").repartition(4)
    got = {r.n: (r.lang_pred, r.score) for r in identify(asked, profiles, profile=most).collect()}
    for k, (lang, score) in enumerate(answers):
        assert got[k][0] == lang and abs(got[k][1] - score) < 1e-9, (k, ASKED[k])


def test_nothing_learned_and_empty_tables(spark):
    docs = spark.createDataFrame([("a", None)], "text string, lang string")
    assert learn(docs, "text", "lang") == [] == learn(docs.limit(0), "text", "lang")
    assert [(r.lang_pred, r.score) for r in identify(docs, []).collect()] == [("und", 0.0)]
    assert identify(docs.limit(0), [("en", [97])]).collect() == []


def test_too_many_languages_are_an_error(spark):
    docs = spark.createDataFrame([("ab", "x"), ("cd", "y"), ("ef", "z")], "text string, lang string")
    with pytest.raises(ValueError):
        learn(docs, "text", "lang", most=2, profile=1)


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op2_language_id"](spark, folder).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 300 and right > 0.98
    assert got.filter("score < 0 OR score > 1").isEmpty()


def test_counts_of_a_text_in_parts_are_those_of_the_whole(monkeypatch):
    data = np.frombuffer(("été " * 50 + "x" * 300 + " ende").encode(), np.uint8)
    whole = langid.text_counts(data, np.array([0, len(data)]))
    monkeypatch.setattr(langid, "CHARS", 60)
    parts = langid.text_counts(data, np.array([0, len(data)]))
    # The long word is cut, so grams across the cuts differ; those of the short words don't.
    short = {code(g) for g in plain_grams("été")} - {code("e")}
    pick = lambda x: {int(c): int(t) for _, c, t in zip(*x) if int(c) in short}
    assert pick(whole) == pick(parts)


def test_more_texts_than_a_text_s_number_has_room_for(spark):
    import pyarrow as pa

    texts = ["the cat and the dog", "le chat et le chien", "", "zz"] * 17_500 + ["le chien"]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    assert len(texts) > 1 << 16 and max(b - a for a, b in langid.text_slices(offsets)) <= 1 << 16
    assert [a for a, _ in langid.text_slices(offsets)][1:] == [b for _, b in langid.text_slices(offsets)][:-1]
    known = spark.createDataFrame([("the dog and the cat sat there", "en"), ("le chat et le chien dans la maison", "fr")], "text string, lang string")
    profiles = learn(known, "text", "lang")
    few = {r.text: (r.lang_pred, r.score) for r in identify(spark.createDataFrame([(t,) for t in set(texts)], "text string"), profiles).collect()}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000000")
    try:
        many = spark.createDataFrame(pa.table({"text": texts})).coalesce(1)
        found = identify(many, profiles).groupBy("text", "lang_pred", "score").count().collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {r.text: (r.lang_pred, r.score) for r in found} == few and len(found) == len(few)
    assert sum(r["count"] for r in found) == len(texts)
