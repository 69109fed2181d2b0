"""Operator 13: chat formatting by a compiled template.

``template.Template`` compiles the template; this module renders conversations with it
in Spark and reads the formatted text back. Control strings inside a text are
escaped reversibly: a backslash goes in after the first character of whatever
looks like a control string (with any backslashes already there), so none stands in
an escaped text and dropping one backslash from each gives the text again.

Order: rows by turn; rows of one turn by role, then by formatted text; null turns first.

Scale. If the template's loop reads nothing but its message (``per_turn``), turns are
rendered where they lie, before any shuffle, so a conversation with a third of all
rows is rendered by all tasks. One shuffle by conversation, sorted, then brings
the pieces together as a stream: the reader holds the turns of one piece, whatever a
conversation's length. Digests of a whole conversation are sequential by definition;
that pass only finds frames and hashes. Templates that look around (``loop.last``, ...) are
rendered in the sorted stream, one turn ahead.

Defined cases: null text and null role count as empty; null conv_ids are one
conversation; repeated rows are repeated turns; input rows of conversation -7 are a
conversation apart from the probe of that number; an empty table gives the
probe only; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketscope.llm.template import Chunk, Template, joined

#: fixed values of this format
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
ASSISTANT = "assistant"
PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"
TEMPLATE = """
{%- for message in messages -%}
<s>{{ message.role | escape }}
{%- if message.role == 'assistant' -%}
{{ '[/INST] ' }}{% generation %}{{ message.text | escape }}{% endgeneration %}
{%- else -%}
{{ '[INST] ' }}{{ message.text | escape }}
{%- endif -%}
</s>{{ '\\n' }}
{%- endfor -%}
"""
FRAME = re.compile(r"<s>(.*?)(?:\[INST\]|\[/INST\]) (.*?)</s>\n", re.S)

_FIRST = "".join(sorted({re.escape(c[0]) for c in CONTROL}))
_REST = "|".join(re.escape(c[1:]) for c in CONTROL)
_ESCAPE = re.compile(rf"([{_FIRST}]\\*)(?={_REST})")
_UNESCAPE = re.compile(rf"([{_FIRST}]\\*)\\(?={_REST})")

CONV, PROBE, TURN, ROLE, PIECE, MARKS = "__ms_conv", "__ms_probe", "__ms_turn", "__ms_role", "__ms_piece", "__ms_marks"
BATCH_ROWS = 1000


def escape(text: str | None) -> str:
    return _ESCAPE.sub(r"\1\\", text) if text else ""


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def compiled(source: str = TEMPLATE) -> Template:
    return Template(source, {"escape": escape})


class Reader:
    """Reads formatted text back, piece by piece: turns, text under the marks, digests."""

    def __init__(self):
        self.buffer, self.turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.turns_sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, marks: Iterable[tuple[int, int]]) -> None:
        """The next piece; a mark lies within one piece, a turn may span several."""
        self.chars += len(text)
        for start, end in marks:
            lost = unescape(text[start:end])
            self.loss_chars += len(lost)
            self.loss_sha.update(lost.encode())
        self.buffer = self.buffer + text if self.buffer else text
        at = 0
        while m := FRAME.match(self.buffer, at):
            self.turns += 1
            self.turns_sha.update(f"{unescape(m.group(1))}\n{unescape(m.group(2))}\n".encode())
            at = m.end()
        self.buffer = self.buffer[at:]

    def close(self) -> tuple:
        if self.buffer:
            raise ValueError(f"formatted text ends within a turn: {self.buffer[:40]!r}")
        return self.turns, self.turns_sha.hexdigest(), self.loss_chars, self.loss_sha.hexdigest(), self.chars


def turns(conversations: DataFrame, probe: bool = False) -> DataFrame:
    """CONV, PROBE, TURN, ROLE, PIECE (the raw text); ``probe`` adds conversation PROBE_ID."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias(CONV), F.lit(False).alias(PROBE), F.col("turn").cast("long").alias(TURN),
        F.coalesce(F.col("role"), F.lit("")).alias(ROLE), F.coalesce(F.col("text"), F.lit("")).alias(PIECE))
    if probe:
        both = [(PROBE_ID, True, 0, "user", PROBE_TEXT), (PROBE_ID, True, 1, ASSISTANT, PROBE_TEXT)]
        rows = rows.unionByName(conversations.sparkSession.createDataFrame(both, rows.schema))
    return rows


_KEYS = f"{CONV} long, {PROBE} boolean, {TURN} long, {ROLE} string, {PIECE} string, {MARKS} array<int>"
_NAMES = [CONV, PROBE, TURN, ROLE, PIECE, MARKS]


def _marks(spans: list[tuple[int, int]]) -> list[int]:
    return [x for s in spans for x in s]


def _gathered(rows: DataFrame) -> DataFrame:
    """One conversation after the other, in order, each within one task."""
    return rows.repartition(CONV, PROBE).sortWithinPartitions(CONV, PROBE, TURN, ROLE, PIECE)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, dict]]:
    """((conv, probe), row) one by one."""
    for batch in batches:
        for row in batch.to_pylist():
            yield (row[CONV], row[PROBE]), row


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Each conversation's key and its rows as an iterator (itertools.groupby on the sorted stream)."""
    from itertools import groupby

    for key, rows in groupby(_stream(batches), key=lambda x: x[0]):
        yield key, (r for _, r in rows)


def formatted(rows: DataFrame, source: str = TEMPLATE) -> DataFrame:
    """The pieces of the formatted conversations: CONV, PROBE, TURN, ROLE, PIECE (formatted), MARKS (start, end, ...)."""

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = compiled(source)
        for batch in batches:
            made = [joined(t.turn({"role": r, "text": x}))
                    for r, x in zip(batch.column(ROLE).to_pylist(), batch.column(PIECE).to_pylist())]
            cols = [batch.column(c) for c in _NAMES[:4]]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array([m[0] for m in made], pa.string()), pa.array([_marks(m[1]) for m in made], pa.list_(pa.int32()))],
                names=_NAMES)

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, out = compiled(source), []
        for (conv, probe), messages in _grouped(batches):
            chunks: Iterator[Chunk] = t.chunks({"role": r[ROLE], "text": r[PIECE], "turn": r[TURN]} for r in messages)
            for at, chunk in enumerate(chunks):        # TURN numbers the pieces of the whole conversation
                text, spans = joined([chunk])
                out.append((conv, probe, at, "", text, _marks(spans)))
                if len(out) >= BATCH_ROWS:
                    yield _rows(out, _NAMES, _TYPES)
                    out = []
        if out:
            yield _rows(out, _NAMES, _TYPES)

    return rows.mapInArrow(apart, _KEYS) if compiled(source).per_turn else _gathered(rows).mapInArrow(in_order, _KEYS)


_TYPES = [pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_READ_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]


def _rows(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_back(pieces: DataFrame, source: str = TEMPLATE) -> DataFrame:
    """Per conversation what its formatted text holds: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, out = compiled(source), []
        head, tail = (joined(t.head()), joined(t.tail())) if t.per_turn else (("", []), ("", []))
        names = [c.split()[0] for c in _READ.split(", ")]
        for (conv, _), rows in _grouped(batches):
            reader = Reader()
            reader.feed(*head)
            for r in rows:
                m = r[MARKS]
                reader.feed(r[PIECE], zip(m[::2], m[1::2]))
            reader.feed(*tail)
            out.append((conv, *reader.close()))
            if len(out) >= BATCH_ROWS:
                yield _rows(out, names, _READ_TYPES)
                out = []
        if out:
            yield _rows(out, names, _READ_TYPES)

    return _gathered(pieces).mapInArrow(read, _READ)


def chat_format(conversations: DataFrame, source: str = TEMPLATE) -> DataFrame:
    """Formats all conversations and the probe, and reads the output back."""
    return read_back(formatted(turns(conversations, probe=True), source), source)
