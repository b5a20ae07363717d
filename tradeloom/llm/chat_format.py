"""Chat formatting by prefix-target expansion: one training example per assistant turn.

An example holds all turns up to and with one assistant turn; only that reply is under its loss mask. If
turns follow the last reply, one more example holds the whole conversation with an empty mask, so that
nothing is lost. A turn is written as

    ### role: text </turn>

with a line end after it. Inside texts and roles a backslash is doubled and a control string (``### ``,
``</turn>``) gets a backslash in front; in roles the colon as well. So ``### `` and `` </turn>`` without
a backslash occur only as marks, and removing the backslashes gives back every text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
#: Characters of examples that a task holds before it hands them on.
FLUSH_CHARS = 4 << 20

_CONTROL = re.compile(r"\\|### |</turn>")
_ROLE_CONTROL = re.compile(r"\\|### |</turn>|:")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_HEAD = re.compile(r"### ((?:\\.|[^\\:])*): ", re.DOTALL)
_TURN_END = " </turn>\n"


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str, int]]:
    """(role, text, where the escaped text starts) of each turn of a formatted example."""
    turns, at = [], 0
    while at < len(formatted):
        head = _HEAD.match(formatted, at)
        end = formatted.index(_TURN_END, head.end())
        turns.append((unescape(head[1]), unescape(formatted[head.end() : end]), head.end()))
        at = end + len(_TURN_END)
    return turns


def expanded(turns: list[tuple[str, str]]) -> Iterator[tuple[str, int, int]]:
    """(formatted text, loss start, loss end) in code points, one after the other."""
    parts, size = [], 0
    replied = True
    for role, text in turns:
        head, body = f"### {escape(role, _ROLE_CONTROL)}: ", escape(text)
        parts.append(head + body + _TURN_END)
        start = size + len(head)
        size += len(parts[-1])
        replied = role == ASSISTANT
        if replied:
            # Joining replaces the parts, so that the prefix is kept once.
            parts = ["".join(parts)]
            yield parts[0], start, start + len(body)
    if not replied:
        yield "".join(parts), size, size


def _expand(batches):
    held, chars = [], 0
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            turns = [(t["role"], t["text"]) for t in row.column("turns")[0].as_py()]
            for number, (text, start, end) in enumerate(expanded(turns)):
                held.append((row.column("conv_id"), number, text, start, end))
                chars += len(text)
                if chars >= FLUSH_CHARS:
                    yield _examples(held)
                    held, chars = [], 0
    if held:
        yield _examples(held)


def _examples(held):
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([h[0] for h in held]),
            pa.array([h[1] for h in held], pa.int32()),
            pa.array([h[2] for h in held], pa.string()),
            pa.array([h[3] for h in held], pa.int64()),
            pa.array([h[4] for h in held], pa.int64()),
        ],
        names=["conv_id", "example", "formatted", "loss_start", "loss_end"],
    )


def format_chats(conversations: DataFrame, conv_column: str = "conv_id") -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_end) from rows of turns (turn, role, text).

    Turns go by ``turn``, equal ones by role and text; a null turn comes first, a null role or text is
    empty, and repeated rows are turns of their own. Null conversation ids are one conversation. The examples
    of a conversation stay together in one task and in order. An empty table gives no rows.
    """
    conv_type = conversations.schema[conv_column].dataType.simpleString()
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    whole = conversations.groupBy(F.col(conv_column).alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    # Arrow batches are counted in rows; a conversation can be long, so each is taken out on its own.
    return whole.mapInArrow(
        _expand, f"conv_id {conv_type}, example int, formatted string, loss_start bigint, loss_end bigint"
    ).withColumnRenamed("conv_id", conv_column)


def _read_back(batches):
    """Per conversation, from its examples alone: turns, texts under the mask, characters."""
    now, state = None, None
    for batch in batches:
        rows = []
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            if row["example"] == 0:
                if state:
                    rows.append((now, state))
                now = batch.slice(at, 1).column("conv_id")
                state = {"loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "last": ""}
            reply = unescape(row["formatted"][row["loss_start"] : row["loss_end"]])
            state["loss"].update(reply.encode("utf-8", "replace"))
            state["loss_chars"] += len(reply)
            state["chars"] += len(row["formatted"])
            state["last"] = row["formatted"]
        if rows:
            yield _digests(rows)
    if state:
        yield _digests([(now, state)])


def _digests(rows):
    turns = [parse(state["last"]) for _, state in rows]
    texts = ["".join(f"{role}\n{text}\n" for role, text, _ in t) for t in turns]
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([r[0] for r in rows]),
            pa.array([len(t) for t in turns], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in texts], pa.string()),
            pa.array([s["loss_chars"] for _, s in rows], pa.int64()),
            pa.array([s["loss"].hexdigest() for _, s in rows], pa.string()),
            pa.array([s["chars"] for _, s in rows], pa.int64()),
        ],
        names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    )


def digests(examples: DataFrame, conv_column: str = "conv_id") -> DataFrame:
    """Read the turns and the trainable texts back from the output of ``format_chats``."""
    conv_type = examples.schema[conv_column].dataType.simpleString()
    return (
        examples.withColumnRenamed(conv_column, "conv_id")
        .mapInArrow(
            _read_back,
            f"conv_id {conv_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
            "formatted_chars bigint",
        )
        .withColumnRenamed("conv_id", conv_column)
    )
