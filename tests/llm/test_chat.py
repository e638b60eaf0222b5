"""Chat formatting: exact round trips and the loss mask."""

import random

import pytest
from pyspark.sql import functions as F

from quartermill.llm.chat import CONTROLS, digests, format_chats, plain, turns_of

SCHEMA = "conv_id long, turn long, role string, text string"


def random_text(rng):
    return "".join(rng.choice(["\\", "\n", "é😀", "<", "[", "|", "n", *CONTROLS, CONTROLS[0][:4]]) for _ in range(rng.randint(0, 9)))


@pytest.mark.parametrize("batch", ["10000", "3"])
def test_round_trip_of_any_text(spark, batch):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "odd\nro\\nle\\", None, CONTROLS[1]]), rng.choice([None, random_text(rng)])) for c in range(30) for t in range(rng.randint(1, 7))]
    rows += [(None, 0, "user", "a"), (None, None, "assistant", "b"), (5, 2, "user", "again"), (5, 2, "user", "again")]
    rows += [(99, k, "assistant" if k % 2 else "user", f"turn {k} <|end|>") for k in range(300)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", n_turns int, formatted string").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        parts = sorted(format_chats(df).collect(), key=lambda r: r.part)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    expected: dict = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        expected.setdefault(c, []).append((role or "", text or ""))
    got: dict = {}
    for r in parts:
        turns = turns_of(r.formatted)
        assert len(turns) == r.n_turns
        masked = [plain(r.formatted[s.start : s.stop]) for s in r.loss]
        assert masked == [t for role, t in turns if role == "assistant"]
        got.setdefault(r.conv_id, []).extend(turns)
    assert got == expected


def test_no_control_string_survives_in_content(spark):
    rows = [(1, k, "user", c + c[1:] + "<" + c) for k, c in enumerate(CONTROLS)]
    text = format_chats(spark.createDataFrame(rows, SCHEMA)).first().formatted
    for c in CONTROLS:
        assert text.count(c) == (len(rows) if c in ("<|turn|>", "<|end|>") else 0)


def test_digests_do_not_depend_on_parts(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"é{c}.{t}") for c in range(20) for t in range(9)]
    whole = format_chats(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    a = {tuple(r) for r in digests(whole).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        b = {tuple(r) for r in digests(format_chats(spark.createDataFrame(rows, SCHEMA).repartition(9))).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert a == b and len(a) == 20


def test_empty_table(spark):
    none = format_chats(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] == digests(none).collect()
    assert none.agg(F.sum("n_turns")).first()[0] is None


def test_a_large_batch_is_taken_in_parts(spark, monkeypatch):
    from quartermill.llm import common

    rows = [(k % 7, k, "assistant" if k % 2 else "user", f"{k} " * (40 if k != 11 else 4000)) for k in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    whole = {r.conv_id: tuple(r) for r in digests(format_chats(df)).collect()}
    monkeypatch.setattr(common, "PART", 2000)
    parts = format_chats(df).collect()
    assert max(len(p.formatted) for p in parts if "11 11" not in p.formatted) < 5000 and len(parts) > 15
    assert {r.conv_id: tuple(r) for r in digests(format_chats(df)).collect()} == whole
