"""Chat formatting by event-sourced reconstruction.

A log holds events of conversations: whole messages, streamed deltas, edits and regenerations, each with a conversation and a
sequence number. They are partitioned by conversation and sorted by sequence; one pass then folds them into final messages and
renders each conversation as it ends, so that a task holds one conversation at a time and no log is gathered.

    message      turn, role, text     puts the turn's text
    delta        turn, role, text     adds to the turn's text
    edit         turn, text           replaces the turn's text; later turns stay
    regenerate   turn                 empties the turn and drops those after it; deltas or a message then fill it

Rendered: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Within texts and roles ``<``, any backslashes, ``|`` gets one more
backslash before the bar, so that no text holds a mark and taking one away restores it; a role's line breaks and per cent
signs are per-cent encoded. The loss mask, spans of code points in the rendering, covers the assistant's texts alone.

Null texts and roles are empty. Events of a null conversation form one. Null sequence numbers come first; rows that tie on
a sequence number are ordered by turn, kind, role and text, so that any run gives the same. Unknown kinds raise an error. A null turn is the one
after the last. A delta, edit or regeneration of a turn that isn't there makes it, with the event's role, or an empty one. Repeated message events put a turn's text again; rows
of a table that share a turn are turns of their own. Only the columns named are read, so that others may have any name. An empty log gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

START, END = "<|im_start|>", "<|im_end|>"
KINDS = ("message", "delta", "edit", "regenerate")
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


class Conversation:
    """The state that events fold into."""

    def __init__(self) -> None:
        self.turns: dict[int, list] = {}
        self.last = -1

    def apply(self, kind: str | None, turn: int | None, role: str | None, text: str | None) -> None:
        kind = kind or "message"
        if kind not in KINDS:
            raise ValueError(f"unknown kind of event: {kind}")
        turn = self.last + 1 if turn is None else turn
        self.last = turn if kind == "regenerate" else max(self.last, turn)
        if kind == "regenerate":
            for t in [t for t in self.turns if t > turn]:
                del self.turns[t]
            self.turns.setdefault(turn, [role or "", []])[1] = []
        elif kind == "delta":
            self.turns.setdefault(turn, [role or "", []])[1].append(text or "")
        elif kind == "edit" and turn in self.turns:
            self.turns[turn][1] = [text or ""]
        else:
            self.turns[turn] = [role or self.turns.get(turn, ("",))[0], [text or ""]]

    def messages(self) -> list[tuple[str, str]]:
        return [(role, "".join(parts)) for _, (role, parts) in sorted(self.turns.items())]


def render(messages: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the loss mask's spans."""
    out, at, spans = [], 0, []
    for role, text in messages:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += (head, body, f"{END}\n")
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The messages of a formatted conversation."""
    found, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("no conversation of this format")
        found.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("no conversation of this format")
    return found


def format_conversations(events: DataFrame, *, conversation: str = "conv_id", sequence: str = "seq", kind: str = "kind", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per conversation: the conversation's column, formatted, loss_spans (begin and end in code points)."""
    common.ship(events.sparkSession)
    names = {"c": conversation, "s": sequence, "k": kind, "t": turn, "r": role, "x": text}
    rows = events.select(*[F.col(v).alias(k) for k, v in names.items()])
    id_type = rows.schema["c"].dataType.simpleString()
    arrow_id = pa.string() if id_type == "string" else pa.int64()
    rows = rows if id_type == "string" else rows.withColumn("c", F.col("c").cast("long"))
    rows = rows.withColumns({"s": F.col("s").cast("long"), "t": F.col("t").cast("long")})

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done, chars = None, None, [], 0

        def batch() -> pa.RecordBatch:
            spans = pa.array([[{"begin": a, "end": b} for a, b in d[2]] for d in done], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], arrow_id), pa.array([d[1] for d in done]), spans], [conversation, "formatted", "loss_spans"])

        for b in batches:
            for c, k, t, r, x in zip(*(b[n].to_pylist() for n in "cktrx")):
                if state is None or c != now:
                    if state is not None:
                        done.append((now, *render(state.messages())))
                        chars += len(done[-1][1])
                    now, state = c, Conversation()
                state.apply(k, t, r, x)
                if chars > 4_000_000:
                    yield batch()
                    done, chars = [], 0
        if state is not None:
            done.append((now, *render(state.messages())))
        if done:
            yield batch()

    id_ddl = "string" if id_type == "string" else "long"
    return rows.repartition(F.col("c")).sortWithinPartitions("c", "s", "t", "k", "r", "x").mapInArrow(fold, f"`{conversation}` {id_ddl}, formatted string, loss_spans array<struct<begin: bigint, end: bigint>>")


def from_turns(turns: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of whole turns as a log: one message event a row. Rows that share a turn become turns of their own, in order of role and text."""
    return turns.select(F.col(conversation), F.col(turn).cast("long").alias("seq"), F.lit("message").alias("kind"), F.lit(None).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))


def digests(formatted: DataFrame, *, conversation: str = "conv_id") -> DataFrame:
    """Read back from the rendering: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    common.ship(formatted.sparkSession)
    id_type = "string" if formatted.schema[conversation].dataType.simpleString() == "string" else "long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches, 256):
            rows = []
            for c, f, spans in zip(b[conversation].to_pylist(), b["formatted"].to_pylist(), b["loss_spans"].to_pylist()):
                messages = parse(f)
                turns = "".join([f"{r}\n{x}\n" for r, x in messages])
                loss = "".join([unescape(f[s["begin"] : s["end"]]) for s in spans])
                rows.append((c, len(messages), hashlib.sha256(turns.encode("utf-8", "surrogatepass")).hexdigest(), len(loss), hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(f)))
            if rows:
                types = (pa.string() if id_type == "string" else pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [conversation, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(read, f"`{conversation}` {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
