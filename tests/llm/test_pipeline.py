"""The pipeline, stage by stage, against brute force."""

import random

import pytest
import sentencepiece
from test_decontam import brute as hits
from test_linededup import brute as lines
from test_neardup import brute as classes

import corpus_pipeline
from quartermill.llm.queries import PIECES

LINES = ["one common line of many words here", "another line that is shared by some"]


def documents(rng):
    english = "the and of to in that it is was for with as on be at by this have from or had not are but".split()
    french = "le la les des une dans que qui pas pour sur avec son ses par mais nous vous est sont été".split()
    out = []
    for k in range(60):
        words = english if k % 2 else french
        text = "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(8, 20))) for _ in range(rng.randint(1, 5)))
        if k % 4 == 0:
            text += "\n" + LINES[k % 8 // 4]
        out.append((k, text, "en" if k % 2 else "fr"))
    out += [(100 + k, out[k][1], out[k][2]) for k in range(0, 20, 3)]
    out += [(200, None, "en"), (201, "123 456", None), (202, "中文字符测试", None), (203, out[7][1] + " x", None)]
    return out


def write(spark, folder, rng):
    docs = [(d, t, lang, "src", len(t) if t is not None else None) for d, t, lang in documents(rng)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{folder}/documents.parquet")
    items = [(1, docs[9][1][:90]), (2, "words of no document at all that would be long enough")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def test_stages(spark, tmp_path):
    docs, items = write(spark, str(tmp_path), random.Random(5))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "MinHash near-dedup", "benchmark decontamination", "SentencePiece encoding and decoding"]
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = frame.columns
    state = {r.doc_id: r.text for r in frame.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frame, str(tmp_path))
        if k < 4:
            assert out.columns == columns
            out.write.parquet(f"{tmp_path}/{k}")
            frame = out = spark.read.parquet(f"{tmp_path}/{k}")
        got = {r.doc_id: r.text for r in out.collect()}
        assert out.count() == len(got)
        if k == 0:
            expected = {d: t for d, t in state.items() if d not in (200, 201, 202)}
        elif k == 1:
            expected = {d: t for d, t, _, _ in lines(list(state.items()))}
            assert expected != state
        elif k == 2:
            rows = sorted(state.items())
            expected = {d: t for (d, t), (_, c) in zip(rows, classes(rows)) if c == d}
            assert len(expected) < len(state)
        elif k == 3:
            assert set(got) == set(state) and got != state
            for d, t in state.items():
                assert (got[d] == t) == (hits(t, items)[1] == 0) and (got[d] or "") in ((t or ""), got[d])
            expected = got
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
            expected = state
            assert all(r.ids == library.encode(r.text) and r.n_tokens == len(r.ids) for r in out.collect())
        assert got == expected, name
        state = got


def test_run_is_all_stages(spark, tmp_path):
    write(spark, str(tmp_path), random.Random(5))
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, frame, str(tmp_path))
        frame.write.parquet(f"{tmp_path}/s{k}")
        frame = spark.read.parquet(f"{tmp_path}/s{k}")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.exceptAll(frame).isEmpty() and frame.exceptAll(got).isEmpty() and got.count() > 20


def test_no_language_is_an_error_and_an_empty_table_is_none(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, "some words", None, "s", 10), (2, None, "en", "s", None)], schema)
    with pytest.raises(ValueError, match="no language"):
        corpus_pipeline.language_id(spark, docs, str(tmp_path))
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
