"""Chat formatting: a finite-state machine over roles and a declarative template.

A ``Template`` names the control strings, the opening and closing text of a turn,
which roles carry loss, and which role may follow which. Formatting reads the turns of
each conversation in order, checks every step of the machine, and emits one row per
turn with its text segments and a loss flag for each. Control strings inside roles and
texts are broken by a backslash after their first character, and backslashes are
doubled, so a formatted conversation has control strings only where the template put
them, and reading it gives the texts back.

Turns stream through sorted partitions: a conversation's digest is a chain and stays
in one task, but only one turn is held at a time, however long the conversation.

Defined cases: null text or role is empty; turns are ordered by (turn, role, text),
null first, so repeated rows are repeated turns; rows without conversation id form one
conversation; a role that the machine does not allow is formatted all the same and
its turn is marked as not valid.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    controls: tuple[str, ...] = (
        "<|im_start|>",
        "<|im_end|>",
        "<|endoftext|>",
        "<s>",
        "</s>",
        "[INST]",
        "[/INST]",
        "<<SYS>>",
        "<</SYS>>",
    )
    loss_roles: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),  # the start
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )

    def escape(self, text: str) -> str:
        """``text`` with doubled backslashes and broken control strings."""
        pattern = "|".join(re.escape(c) for c in sorted(self.controls, key=len, reverse=True))
        # a look-ahead finds control strings that overlap, too
        return re.sub(rf"\\|(?={pattern}).", lambda m: m[0] + "\\", text, flags=re.DOTALL)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        name = self.escape(role).replace("\n", "\\\n")
        return [
            (f"{self.opening}{name}\n", False),
            (self.escape(text), role in self.loss_roles),
            (self.closing, False),
        ]

    def parse(self, turn: str) -> tuple[str, str]:
        """Role and text of one formatted turn."""
        if not (turn.startswith(self.opening) and turn.endswith(self.closing)):
            raise ValueError("not a formatted turn")
        head = re.compile(r"((?:\\.|[^\\\n])*)\n", re.DOTALL).match(turn, len(self.opening))
        return unescape(head[1]), unescape(turn[head.end() : -len(self.closing)])


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


_FORMATTED = "conv_id bigint, position bigint, segments array<struct<text:string,loss:boolean>>, valid boolean"
_SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def _format(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, state, position = object(), "", 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            segments, positions, valid = [], [], []
            for conv_id, role, text in zip(ids, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                role, text = role or "", text or ""
                if conv_id != present:
                    present, state, position = conv_id, "", 0
                valid.append(role in template.follows.get(state, ()))
                segments.append([{"text": t, "loss": loss} for t, loss in template.segments(role, text)])
                positions.append(position)
                state, position = role, position + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(positions, pa.int64()),
                    pa.array(segments, _SEGMENTS),
                    pa.array(valid, pa.bool_()),
                ],
                names=["conv_id", "position", "segments", "valid"],
            )

    return run


def format_conversations(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv_id, position, segments, valid): one row per turn of ``turns(conv_id, turn, role, text)``."""
    ordered = (
        turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return ordered.mapInArrow(_format(template or Template()), _FORMATTED)


_DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint, valid boolean"
)


def _digest(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, started, done = None, False, []
        turns = loss = None
        count = loss_chars = chars = 0
        valid = True

        def close() -> None:
            if started:
                done.append((present, count, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, valid))

        def flush() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            columns = list(zip(*done)) or [[]] * 7
            names = [c.split()[0] for c in _DIGEST.split(",")]
            done_batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            done.clear()
            return done_batch

        for batch in batches:
            for conv_id, segments, ok in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            ):
                if not started or conv_id != present:
                    close()
                    present, started, turns, loss = conv_id, True, hashlib.sha256(), hashlib.sha256()
                    count = loss_chars = chars = 0
                    valid = True
                whole = "".join(s["text"] for s in segments)
                role, text = template.parse(whole)
                turns.update(f"{role}\n{text}\n".encode())
                for s in segments:
                    if s["loss"]:
                        learned = unescape(s["text"])
                        loss.update(learned.encode())
                        loss_chars += len(learned)
                count += 1
                chars += len(whole)
                valid = valid and ok
            yield flush()
        close()
        yield flush()

    return run


def conversation_digests(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation, what reading its formatted turns gives back."""
    ordered = (
        formatted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "position")
        .select("conv_id", "segments", "valid")
    )
    return ordered.mapInArrow(_digest(template or Template()), _DIGEST)
