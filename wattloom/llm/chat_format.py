"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns to a text. Its marks are not known here: the span of a
turn is what the rendering gains with it, and the part of the span that is the turn's text is found by
rendering two sentinels in its place. A template whose rendering of a prefix is no prefix of the next
rendering rewrites history and is reported. Every prefix is rendered whole, unless the template is declared
to be local to a turn.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

START, END = "<|im_start|>", "<|im_end|>"
# Turns that a template local to a turn renders again before a new one. Up to twice as many are in its prefix.
CONTEXT = 16

_TURN = "conv_id bigint, turn_no bigint, role string, piece string, text_start bigint, text_end bigint, loss boolean, rewrites boolean"
_DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, rewrites_history boolean"
)

_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """A backslash goes into every ``<|``, and one more into every ``<\\...|``; so none of the marks is left."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def local_to_turn(template: Template) -> Template:
    """Declares that what the template writes for a turn depends on that turn alone."""
    template.local_to_turn = True
    return template


@local_to_turn
def chat_template(turns: list[Turn]) -> str:
    """Marks the turns, and escapes the marks inside roles and texts reversibly."""
    return "".join(f"{START}{_escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns)


def read_back(piece: str) -> list[Turn]:
    """The turns of a text that ``chat_template`` made."""
    turns = []
    for part in piece.split(END + "\n")[:-1]:
        role, _, text = part.removeprefix(START).partition("\n")
        turns.append((_unescape_role(role), unescape(text)))
    return turns


def _text_part(template: Template, before: list[Turn], base: str, role: str, span: str) -> tuple[int, int]:
    """Where in the span the turn's text lies: between what two renderings with other texts have in common."""
    a, b = (template([*before, (role, sign)])[len(base) :] for sign in "AB")
    head = len(os.path.commonprefix([a, b]))
    tail = len(os.path.commonprefix([a[:head:-1], b[:head:-1]]))
    return head, len(span) - tail


class _Conversation:
    """Renders one conversation turn by turn. A template local to a turn needs a window of turns only."""

    def __init__(self, template: Template, loss_role: str):
        self.template, self.loss_role = template, loss_role
        self.local = getattr(template, "local_to_turn", False)
        self.turns: list[Turn] = []
        self.base = template([])
        self.opening = self.base
        self.n = 0

    def add(self, role: str, text: str) -> tuple:
        if self.local and len(self.turns) >= 2 * CONTEXT:
            self.turns = self.turns[CONTEXT:]
            self.base = self.template(self.turns)
        now = self.template([*self.turns, (role, text)])
        kept = now.startswith(self.base)
        if kept:
            piece = now[len(self.base) :]
            start, end = _text_part(self.template, self.turns, self.base, role, piece)
        else:
            # What is left of the old rendering; no part of such a text can be trusted as the turn's.
            piece, start, end = now[len(os.path.commonprefix([now, self.base])) :], 0, 0
        if self.n == 0:
            piece, start, end = self.opening + piece, start + len(self.opening), end + len(self.opening)
        self.turns.append((role, text))
        self.base = now
        self.n += 1
        return self.n - 1, role, piece, start, end, kept and role == self.loss_role, not kept


def _format(template: Template, loss_role: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "turn_no", "role", "piece", "text_start", "text_end", "loss", "rewrites"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
        at, conversation = (), None
        for batch in batches:
            rows = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if at != (conv_id,):
                    at, conversation = (conv_id,), _Conversation(template, loss_role)
                rows.append((conv_id, *conversation.add(role, text)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def format_turns(conversations: DataFrame, template: Template = chat_template, loss_role: str = "assistant") -> DataFrame:
    """One row per turn, in order inside each partition: conv_id, turn_no, role, piece, text_start,
    text_end, loss, rewrites.

    ``piece`` is what the turn adds to the formatted conversation: all pieces of a conversation in order
    are its text, if no turn rewrites. text_start and text_end bound the turn's own text in the piece; ``loss`` says
    whether it counts for the loss. ``rewrites`` marks turns at which the template changes what it
    had written before; then the piece is what follows the part that stayed, and nothing of it counts.

    Rows are ordered by turn, then role and text; a null turn comes first; null role and text are empty;
    rows with a null conv_id are one conversation. A conversation is read as a stream. With a template
    declared ``local_to_turn`` it may be longer than memory, as a prefix holds the last ``2 * CONTEXT`` turns
    at most; with any other, all its turns are held and rendered for each new one. A very long text is rendered
    whole. Repeated rows are turns of their own; an empty table gives no rows.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_format(template, loss_role), _TURN)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, state = (), None

    def closed() -> tuple:
        conv_id, n, turns, loss_chars, loss, chars, rewrites = state
        return conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, rewrites

    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_history"]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        rows = []
        columns = ("conv_id", "piece", "text_start", "text_end", "loss", "rewrites")
        for conv_id, piece, start, end, loss, rewrites in zip(*(batch.column(c).to_pylist() for c in columns)):
            if at != (conv_id,):
                if state:
                    rows.append(closed())
                at, state = (conv_id,), [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
            for role, text in read_back(piece):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            if loss:
                text = unescape(piece[start:end])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(piece)
            state[6] = state[6] or rewrites
        if rows:
            yield out(rows)
    if state:
        yield out([closed()])


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Per conversation of ``format_turns`` with the default template, read back from its pieces:
    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites_history."""
    return turns.mapInArrow(_digest, _DIGEST)
