"""SentencePiece encoding against the library, and exact round trips."""

import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from quartermill.llm import pieces
from quartermill.llm.pieces import Pieces, decode, encode
from quartermill.llm.queries import PIECES

RAW = open(PIECES, "rb").read()
RNG = random.Random(3)
TEXTS = ["", " ", "  a   b", "x" * 300, "ab" * 200 + " c", "😀中文字符测试" * 30, "a\n\n\tb\x00c", "a▁b ▁▁c", "   " * 30 + "end  ", "é" * 80, "don't stop.",
         *["".join(RNG.choice("abc de  fé中\n") for _ in range(RNG.randint(0, 200))) for _ in range(200)]]


def as_unigram():
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(RAW)
    model.trainer_spec.model_type = 1
    for k, p in enumerate(model.pieces):
        if p.type == 1:
            p.score = -5 - np.log1p(k) * (1 + (k * 7919 % 97) / 97)
    return model.SerializeToString()


def split(encoded):
    return [x.tolist() for x in np.split(encoded[0], np.cumsum(encoded[1])[:-1])]


def test_bpe_ids_are_the_library_s(monkeypatch):
    expected = sentencepiece.SentencePieceProcessor(model_proto=RAW).encode(TEXTS)
    mine = Pieces(*Pieces.read(RAW))
    assert split(mine.encode(TEXTS)) == expected
    monkeypatch.setattr(pieces, "LONGEST", 3)  # the way for long units
    monkeypatch.setattr(pieces, "CACHE", 0)
    mine.forget()
    assert split(mine.encode(TEXTS)) == expected


def test_unigram_paths_score_as_the_library_s(monkeypatch):
    raw = as_unigram()
    library = sentencepiece.SentencePieceProcessor(model_proto=raw)
    mine = Pieces(*Pieces.read(raw))
    for longest in (64, 3):
        monkeypatch.setattr(pieces, "LONGEST", longest)
        mine.forget()
        same = 0
        for a, b in zip(split(mine.encode(TEXTS)), library.encode(TEXTS)):
            # Equal paths, but for ties that rounding settles.
            same += a == b
            known = lambda ids: sum(mine.scores[k] if mine.types[k] == 1 else 0 for k in ids)
            assert a == b or abs(known(a) - known(b)) < 1e-3
        assert same > 0.95 * len(TEXTS)


def test_frames_round_trip(spark):
    rows = [(k, t, "q", 9) for k, t in enumerate([None, *TEXTS, TEXTS[3]])]
    df = spark.createDataFrame(rows, "n int, text string, n_tokens string, decoded int").repartition(4)
    coded = encode(df, PIECES)
    library = sentencepiece.SentencePieceProcessor(model_proto=RAW)
    for r in decode(coded, PIECES).collect():
        text = rows[r.n][1]
        if text is None:
            assert r.ids is None and r.decoded is None and r.n_tokens == 0
        else:
            assert r.ids == library.encode(text) and r.n_tokens == len(r.ids)
            assert r.decoded == text.replace("▁", " ") == library.decode(r.ids)
    both = encode(df, PIECES, out="again").select("n", "again").join(decode(coded, PIECES).select("n", "decoded"), "n")
    assert both.filter("NOT (again <=> decoded)").isEmpty()


def test_decode_leaves_out_what_is_no_piece(spark):
    df = spark.createDataFrame([(1, [None, 15043, 10**6, -4, 1, 2]), (2, []), (3, None), (4, [0])], "n int, ids array<int>")
    got = {r.n: r.decoded for r in decode(df, PIECES).collect()}
    library = sentencepiece.SentencePieceProcessor(model_proto=RAW)
    assert got == {1: library.decode([15043]), 2: "", 3: None, 4: library.decode([0])}


def test_empty_tables_and_refused_models(spark):
    assert encode(spark.createDataFrame([], "text string"), PIECES, out="x").collect() == []
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(RAW)
    model.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        Pieces.read(model.SerializeToString())


def test_the_cache_is_bounded_by_characters(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_CHARS", 20_000)
    with open(PIECES, "rb") as f:
        own = Pieces(*Pieces.read(f.read()))
    rng = random.Random(6)
    most = 0
    for _ in range(60):
        # Texts without blanks are one unit each.
        texts = ["".join(chr(rng.randrange(0x4E00, 0x4F00)) for _ in range(400)) for _ in range(5)]
        ids, counts = own.encode(texts)
        most = max(most, sum(map(len, own.cache)))
        assert own.held == sum(map(len, own.cache))
        fresh = Pieces(own.kind, [(p, float(s), t) for p, s, t in zip(own.texts, own.scores, own.types)], own.prefix) if _ % 30 == 29 else None
        if fresh:
            assert fresh.encode(texts)[0].tolist() == ids.tolist() and fresh.encode(texts)[1].tolist() == counts.tolist()
    assert most <= 20_000 + 5 * 402
