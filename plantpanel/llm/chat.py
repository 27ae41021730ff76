"""Chat formatting with a grammar round trip.

A template marks the turns of a conversation.  Each turn is rendered, parsed
again by a deterministic parser, and compared with its source; a text that does
not come back has its conflicting content escaped until it does.  The grammar is
a plain sequence of turns and the parser is in its start state after each, so
turns that come back one by one also come back from the whole conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Control strings and the white space about them: what opens and what closes a turn of each role.
TURNS = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("<s>", "</s>"),
}
#: Around the name, and after the text, of any other role.
OTHER = ("<<ROLE>>", "<</ROLE>>", "<</TURN>>")


class Unparsable(ValueError):
    """A formatted text departs from the grammar."""


@dataclass(frozen=True)
class Template:
    """``turns`` gives the opening and the closing string of a role, ``other`` those of the remaining roles.

    Each string holds one mark (the string less white space about it).  Inside
    a text a mark is written with escape signs after its first character;
    reading takes one sign away.  Marks may neither overlap nor lie in one
    another, else a text could complete one; such a template is refused.
    """

    turns: dict = field(default_factory=lambda: dict(TURNS))
    other: tuple = OTHER
    escape: str = "\\"

    def __post_init__(self):
        marks = [s.strip() for pair in self.turns.values() for s in pair] + [s.strip() for s in self.other]
        for a in marks:
            inside = [b for b in marks if a != b and b in a]
            joined = [b for b in marks if any(a.endswith(b[:n]) for n in range(1, len(b) if a == b else min(len(a), len(b)) + 1))]
            if len(a) < 2 or self.escape in a or inside or joined:
                raise ValueError(f"the mark {a!r} is too short, holds the escape sign, or overlaps {inside + joined}")
        alternatives = "|".join(f"{re.escape(m[0])}{re.escape(self.escape)}*{re.escape(m[1:])}" for m in dict.fromkeys(marks))
        object.__setattr__(self, "mark", re.compile(alternatives))
        object.__setattr__(self, "marks", frozenset(marks))

    def escaped(self, text: str) -> str:
        """``text`` with one more escape sign in each mark, escaped or not."""
        return self.mark.sub(lambda m: m[0][0] + self.escape + m[0][1:], text)

    def plain(self, text: str) -> str:
        """The inverse of ``escaped``."""
        return self.mark.sub(lambda m: m[0] if m[0] in self.marks else m[0][0] + m[0][2:], text)

    def control(self, text: str, at: int) -> re.Match | None:
        """The next mark without escape signs."""
        while (m := self.mark.search(text, at)) and m[0] not in self.marks:
            at = m.end()
        return m

    def _closed(self, text: str, at: int, close: str) -> tuple[int, int]:
        """Where the content from ``at`` on ends and where its closing string does."""
        m = self.control(text, at)
        end = m.start() - close.index(close.strip()) if m else -1
        if end < at or not text.startswith(close, end):
            raise Unparsable(f"{close.strip()!r} is missing after position {at}")
        return end, end + len(close)

    def parse(self, text: str) -> Iterator[tuple[str, str, int, int]]:
        """The turns of a formatted text: role, text, and the span of the (escaped) text in code points."""
        at = 0
        while at < len(text):
            role = next((r for r, (o, _) in self.turns.items() if text.startswith(o, at)), None)
            if role is not None:
                start, close = at + len(self.turns[role][0]), self.turns[role][1]
            elif text.startswith(self.other[0], at):
                name, start = self._closed(text, at + len(self.other[0]), self.other[1])
                role, close = self.plain(text[at + len(self.other[0]) : name]), self.other[2]
                if role in self.turns:
                    raise Unparsable(f"role {role!r} has marks of its own")
            else:
                raise Unparsable(f"no turn opens at position {at}")
            end, at = self._closed(text, start, close)
            yield role, self.plain(text[start:end]), start, end

    def render(self, role: str, text: str) -> tuple[str, int, int]:
        """A turn that parses to just this role and text, and the span of its text.

        First the text is taken as it is, then, where the parse differs, with
        its conflicting content escaped.
        """
        known = self.turns.get(role)
        for step in (str, self.escaped):
            opened = known[0] if known else self.other[0] + step(role) + self.other[1]
            body = step(text)
            piece = opened + body + (known[1] if known else self.other[2])
            try:
                if [t[:2] for t in self.parse(piece)] == [(role, text)]:
                    return piece, len(opened), len(opened) + len(body)
            except Unparsable:
                continue
        raise ValueError(f"a turn of role {role!r} does not come back from its template")


def format_chats(
    conversations: DataFrame,
    template: Template | None = None,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """The formatted turns: conv_id, turn, role, formatted, loss_start, loss_end.

    The formatted conversation is its pieces, one after the other by turn (null
    first), role and piece.  The loss mask covers code points ``loss_start`` to
    ``loss_end`` of a piece, the (escaped) text of the roles in ``loss_roles``;
    elsewhere both are null.  A null text or role is empty; a null conv_id is a
    conversation of its own; repeated rows are repeated turns; other columns
    are ignored; an empty table gives no rows.  Turns are rendered where they
    lie, without a shuffle, so neither a long conversation nor a long text
    gathers anywhere.
    """
    template = template or Template()
    slim = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    kinds = [f"{c} {slim.schema[c].dataType.simpleString()}" for c in ("conv_id", "turn")]

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = batch.column(2).to_pylist()
            made = [template.render(role, text) for role, text in zip(roles, batch.column(3).to_pylist())]
            spans = [m[1:] if role in loss_roles else (None, None) for role, m in zip(roles, made)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([m[0] for m in made], pa.string()), pa.array([s[0] for s in spans], pa.int64()), pa.array([s[1] for s in spans], pa.int64())],
                ["conv_id", "turn", "role", "formatted", "loss_start", "loss_end"],
            )

    return slim.mapInArrow(render, f"{', '.join(kinds)}, role string, formatted string, loss_start long, loss_end long")


def chat_texts(pieces: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of whole conversations, from the pieces of ``format_chats``.

    Each conversation becomes one value, so it has to fit in one; ``chat_digests``
    has no such need.
    """
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "formatted", "loss_start", "loss_end")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))

    def step(done, piece):
        own = F.struct((done["at"] + piece["loss_start"]).alias("start"), (done["at"] + piece["loss_end"]).alias("end"))
        spans = F.when(piece["loss_start"].isNull(), done["spans"]).otherwise(F.concat(done["spans"], F.array(own)))
        return F.struct((done["at"] + F.length(piece["formatted"])).alias("at"), spans.alias("spans"))

    whole = pieces.groupBy("conv_id").agg(ordered.alias("p"))
    return whole.select("conv_id", F.array_join(F.transform("p", lambda x: x["formatted"]), "").alias("formatted"), F.aggregate("p", start, step)["spans"].alias("loss_spans"))


class _Reader:
    """Digests of one conversation, read back from its formatted pieces."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, template: Template, pieces: list[str], masked: list[bool]) -> None:
        text = "".join(pieces)
        for (role, body, _, _), counts in zip(template.parse(text), masked, strict=True):
            self.said.update(f"{role}\n{body}\n".encode())
            if counts:
                self.loss.update(body.encode())
                self.loss_chars += len(body)
        self.turns += len(pieces)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def chat_digests(pieces: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, parsed from the pieces of ``format_chats``.

    ``turns_sha256`` covers role, newline, text, newline of every turn,
    ``loss_sha256`` all text under the loss mask.  A hash runs over a
    conversation in order, so its pieces stream through one task, in bounded
    memory however many they are.
    """
    template = template or Template()
    kind = pieces.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    ordered = pieces.select("conv_id", "turn", "role", "formatted", "loss_start").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv_type = None, None
        for batch in batches:
            conv_type = batch.schema.field(0).type
            convs, texts, masked = batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(4).is_valid().to_pylist()
            done, first = [], 0
            while first < len(convs):
                last = first
                while last < len(convs) and convs[last] == convs[first]:
                    last += 1
                if now is None or now.conv != convs[first]:
                    done += [now.row()] if now else []
                    now = _Reader(convs[first])
                now.read(template, texts[first:last], masked[first:last])
                first = last
            if done:
                yield _table(done, conv_type)
        if now is not None:
            yield _table([now.row()], conv_type)

    def _table(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
        kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return ordered.mapInArrow(read, schema)
