"""Chat formatting by columnar byte assembly, and reading the formatted text back.

Every turn becomes ``<|turn|>role\\ntext<|end|>\\n``. A control string inside a role or a
text is broken by a backslash behind its first character, and a backslash is doubled,
so no control string survives in content and reading back restores every byte.

Turns are dealt in ranges of conversation and turn, and sorted. A batch of turns is assembled in numpy:
escaped lengths, segment lengths and cumulative offsets give scatter indices, and
headers, contents and endings are copied into one buffer that becomes the Arrow
column. A conversation that goes on in the next batch goes on in the next part, so
memory is bounded by a batch however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermill.llm.common import list_array, parts_of, quoted, ranges, text_buffer

TURN, END = "<|turn|>", "<|end|>"
#: Fixed strings that models take for control: this template's own and other common ones.
CONTROLS = (TURN, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
ESCAPE = ord("\\")
#: What a formatted part looks like: role, then text. Roles are of one line once their newlines are escaped.
PARTS = re.compile(re.escape(TURN) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)
#: An escaped newline, in roles only.
NEWLINE = "\\n"


def escaped_sizes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per byte of content: is a backslash written before it, and one behind it?"""
    before = data == ESCAPE
    behind = np.zeros(len(data), bool)
    for control in CONTROLS:
        c = np.frombuffer(control.encode(), np.uint8)
        at = np.flatnonzero(data[: len(data) - len(c) + 1] == c[0]) if len(data) >= len(c) else np.zeros(0, np.int64)
        for k in range(1, len(c)):
            at = at[data[at + k] == c[k]]
        behind[at] = True
    return before, behind


def escaped(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Escaped bytes and offsets of a text column.

    A control string never crosses two texts, since each is looked at with a zero byte behind it.
    """
    n = len(offsets) - 1
    apart = np.zeros(len(data) + n, np.uint8)
    where = np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))
    apart[where] = data
    before, behind = (x[where] for x in escaped_sizes(apart))
    at = np.concatenate([[0], np.cumsum(1 + before.astype(np.int64) + behind)])
    out = np.full(at[-1], ESCAPE, np.uint8)
    out[at[:-1] + before] = data
    return out, at[offsets]


def assemble(roles: tuple, texts: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns, their offsets, and where each turn's text begins.

    ``roles`` and ``texts`` are escaped (bytes, offsets). All segments are copied into
    one preallocated buffer.
    """
    head, newline, tail = (np.frombuffer(x.encode(), np.uint8) for x in (TURN, "\n", END + "\n"))
    n = len(roles[1]) - 1
    sizes = np.stack([np.full(n, len(head)), np.diff(roles[1]), np.full(n, 1), np.diff(texts[1]), np.full(n, len(tail))], axis=1)
    ends = np.cumsum(sizes.ravel()).reshape(n, 5) if n else np.zeros((0, 5), np.int64)
    starts = ends - sizes
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for k, constant in ((0, head), (2, newline), (4, tail)):
        out[(starts[:, k, None] + np.arange(len(constant))).ravel()] = np.tile(constant, n)
    out[ranges(starts[:, 1], sizes[:, 1])] = roles[0]
    out[ranges(starts[:, 3], sizes[:, 3])] = texts[0]
    return out, np.concatenate([[0], ends[:, 4]]), starts[:, 3]


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 learned: str = "assistant") -> DataFrame:
    """Formatted conversations with a loss mask.

    Rows: ``conv_id``, ``part`` (a number that rises; most have one part), ``n_turns``,
    ``formatted``, and ``loss``: spans of code points in ``formatted`` that hold the
    escaped texts of the role ``learned``. The parts of a conversation, in order, are
    its formatted text; a turn is never split.

    Turns are in order of ``turn``, nulls first; equal ones in order of role and text.
    A null role or text is empty. Rows without a conversation id are one conversation
    whose id is null. Repeated rows are repeated turns. An empty table gives no rows;
    other columns are left out. Turns of any length are kept whole.
    """
    rows = turns.select(
        F.col(quoted(conv)).cast("long").alias("conv_id"), F.col(quoted(turn)).cast("long").alias("turn"),
        F.coalesce(F.col(quoted(role)).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).alias("text"))
    # Ranges of turns, so that a conversation with very many is spread over tasks.
    dealt = rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        part = TaskContext.get().partitionId() << 32
        # Bounded by bytes: what is made of a part takes many times its size.
        for batch in (p for whole in batches for p in parts_of(whole, "text")):
            ids = batch.column(0)
            null = np.asarray(ids.is_null())
            value = ids.fill_null(0).to_numpy()
            new = np.ones(len(value), bool)
            new[1:] = (value[1:] != value[:-1]) | (null[1:] != null[:-1])
            first = np.flatnonzero(new)
            roles, offsets, _ = text_buffer(batch.column(2))
            line = roles == 10
            lined = escaped(roles, offsets)
            if line.any():  # a newline would end the role
                lined = one_line(*lined)
            out, ends, begins = assemble(lined, escaped(*text_buffer(batch.column(3))[:2]))
            stops = ends[1:] - len(END) - 1
            bounds = np.append(first, len(value))
            # Spans in code points: all bytes but continuations count.
            points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
            ours = np.asarray(pa.compute.equal(batch.column(2), learned))
            zero = np.repeat(points[ends[first]], np.diff(bounds))
            spans = pa.StructArray.from_arrays(
                [pa.array(points[x][ours] - zero[ours]) for x in (begins, stops)], names=["start", "stop"])
            part += 1
            formatted = pa.Array.from_buffers(
                pa.large_string(), len(first), [None, pa.py_buffer(ends[bounds].astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(first)), pa.array(np.full(len(first), part)), pa.array(np.diff(bounds).astype(np.int64)), formatted,
                list_array(spans, np.add.reduceat(ours.astype(np.int64), first)),
            ], names=["conv_id", "part", "n_turns", "formatted", "loss"])

    return dealt.mapInArrow(run, "conv_id long, part long, n_turns long, formatted string, loss array<struct<start: long, stop: long>>")


def one_line(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Escaped roles with newlines as an escaped ``n``."""
    line = data == 10
    at = np.concatenate([[0], np.cumsum(1 + line)])
    out = np.full(at[-1], ESCAPE, np.uint8)
    out[at[:-1] + line] = np.where(line, ord("n"), data)
    return out, at[offsets]


def plain(content: str, role: bool = False) -> str:
    """Content without its escapes. A backslash before an ``n`` that was none is doubled in content, so both tell apart."""
    if "\\" not in content:
        return content
    return re.sub(r"\\(.)", lambda m: "\n" if role and m[1] == "n" else m[1], content, flags=re.DOTALL)


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted part."""
    return [(plain(r, role=True), plain(t)) for r, t in PARTS.findall(formatted)]


def digests(chats: DataFrame) -> DataFrame:
    """Read formatted conversations back: one row each, with digests of what they hold.

    ``turns_sha256`` is over role, newline, text, newline of every turn; ``loss_chars``
    and ``loss_sha256`` are over all text under the mask without escapes;
    ``formatted_chars`` counts code points. Parts are read one by one, in order.
    """
    ordered = chats.repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def run(batches):
        state = None

        def row(s):
            return {"conv_id": s[0], "n_turns": s[1], "turns_sha256": s[2].hexdigest(), "loss_chars": s[3], "loss_sha256": s[4].hexdigest(), "formatted_chars": s[5]}

        for batch in (p for whole in batches for p in parts_of(whole, "formatted")):
            out = []
            for conv, formatted, loss in zip(*(batch.column(batch.schema.names.index(c)).to_pylist() for c in ("conv_id", "formatted", "loss"))):
                if state is None or state[0] != conv:
                    if state is not None:
                        out.append(row(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in turns_of(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                for span in loss:
                    text = plain(formatted[span["start"] : span["stop"]])
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(formatted)
            yield pa.RecordBatch.from_pylist(out, DIGESTS)
        if state is not None:
            yield pa.RecordBatch.from_pylist([row(state)], DIGESTS)

    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])
