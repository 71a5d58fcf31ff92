r"""Chat formatting by a grammar round trip.

A turn is rendered as ``### role: text``, a line feed and ``</turn>``.  The grammar is
deterministic: a control string (a turn's opening or its end) counts wherever it stands,
unless backslashes are in front of it; then it is content, and one of the backslashes is
the escape.  Every rendered turn is parsed again and compared with its source.  Where the
two differ the content conflicts with the grammar: its control strings get one more
backslash, and the turn is parsed again.  Turns close themselves, so what holds for each
holds for a conversation in a row.

Conversations are read as sorted streams; a task holds a piece of one at a time, however
many turns it has.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Code points after which the next turn begins another piece of its conversation.
PIECE_CHARS = 1_000_000
# Role whose texts are learnt.
LEARNT = "assistant"

_ROLE = r"[A-Za-z0-9_.~%-]*"
_END = "\n</turn>\n"
_OPENING = re.compile(rf"### ({_ROLE}): ")
_CONTROL = re.compile(rf"(\\*)(?:### {_ROLE}: |</turn>)")


def escaped(text: str) -> str:
    """``text`` with one more backslash in front of every control string."""
    return _CONTROL.sub(lambda found: "\\" + found[0], text)


def unescaped(body: str) -> str:
    """``body`` with one backslash less in front of every escaped control string."""
    return _CONTROL.sub(lambda found: found[0][1:] if found[1] else found[0], body)


def opening(role: str) -> str:
    return f"### {quote(role, safe='')}: "


def parse_turns(text: str) -> list[tuple[str, int, int]] | None:
    """(role, start, end) of every turn's body in a rendered text; None if it is not one."""
    turns, at = [], 0
    while at < len(text):
        head = _OPENING.match(text, at)
        if head is None:
            return None
        control = next((c for c in _CONTROL.finditer(text, head.end()) if not c[1]), None)
        # what closes a turn is an end behind a line feed; an opening would nest
        if control is None:
            return None
        body = control.start() - 1
        if body < head.end() or text[body : body + len(_END)] != _END:
            return None
        turns.append((unquote(head[1]), head.end(), body))
        at = body + len(_END)
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn's rendering and where its body lies; it parses back to role and text."""
    body = text
    while True:
        head = opening(role)
        whole = f"{head}{body}{_END}"
        turns = parse_turns(whole)
        if turns is not None and len(turns) == 1:
            back, start, end = turns[0]
            if back == role and unescaped(whole[start:end]) == text:
                return whole, start, end
        conflict, body = body, escaped(text)
        if conflict == body:
            raise ValueError("A turn's text does not survive its rendering")


_LOSS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def format_conversations(rows: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """conv_id, piece, start, text, n_turns, loss: conversations as texts with a loss mask.

    A conversation is one row, or several in turn where it exceeds ``piece_chars``: cut
    between turns, numbered by ``piece``, ``start`` being the code points in front.  ``loss``
    lists the spans (code points of the row's text) that assistants wrote.

    Turns go by ``turn``, null first, then by role and text; rows that repeat a turn are
    turns of their own.  Null texts and roles are empty.  Rows without conv_id form one
    conversation.  An empty table gives no rows, and other columns are not looked at.  The
    pieces of a conversation follow one another in a partition.
    """
    kind = rows.select("conv_id").schema["conv_id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id, begun, piece, start = None, False, 0, 0
        texts: list[str] = []
        loss: list[dict] = []
        size, out = 0, []

        def close() -> None:
            out.append((open_id, piece, start, "".join(texts), len(texts), list(loss)))

        for batch in batches:
            ids = batch.column(0)
            for i, (role, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                conv = ids[i].as_py()
                if begun and (conv != open_id or size >= piece_chars):
                    close()
                    piece, start = (piece + 1, start + size) if conv == open_id else (0, 0)
                    texts.clear()
                    loss.clear()
                    size = 0
                open_id, begun = conv, True
                whole, a, b = render_turn(role, text)
                if role == LEARNT:
                    loss.append({"start": size + a, "end": size + b})
                texts.append(whole)
                size += len(whole)
            if len(out) >= 1000 or sum(len(o[3]) for o in out) > piece_chars:
                yield batch_of(out)
                out.clear()
        if begun:
            close()
        if out:
            yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        ids, numbers, starts, texts, turns, loss = zip(*out, strict=True)
        arrays = [
            pa.array(ids), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()),
            pa.array(texts, pa.string()), pa.array(turns, pa.int32()), pa.array(loss, _LOSS),
        ]
        if pa.types.is_null(arrays[0].type):
            arrays[0] = arrays[0].cast(pa.int64() if kind == "bigint" else pa.string())
        return pa.RecordBatch.from_arrays(arrays, ["conv_id", "piece", "start", "text", "n_turns", "loss"])

    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    turns = rows.select("conv_id", *filled, "turn")
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = (
        f"conv_id {kind}, piece int, start bigint, text string, n_turns int,"
        " loss array<struct<start: int, end: int>>"
    )
    return ordered.drop("turn").mapInArrow(pieces, schema)


def chat_digest(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back
    from the texts and masks of ``format_conversations`` as it returns them."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    class Reader:
        """Digests of one conversation, piece by piece."""

        def __init__(self, conv):
            self.conv, self.turns, self.learnt, self.chars = conv, 0, 0, 0
            self.all, self.loss = hashlib.sha256(), hashlib.sha256()

        def add(self, text: str, spans: list[dict]) -> None:
            for role, start, end in parse_turns(text):
                self.all.update(f"{role}\n{unescaped(text[start:end])}\n".encode())
                self.turns += 1
            for span in spans:
                learnt = unescaped(text[span["start"] : span["end"]])
                self.loss.update(learnt.encode())
                self.learnt += len(learnt)
            self.chars += len(text)

        def row(self) -> tuple:
            return self.conv, self.turns, self.all.hexdigest(), self.learnt, self.loss.hexdigest(), self.chars

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            done = []
            for i in range(batch.num_rows):
                conv, piece, text, loss = (batch.column(k)[i].as_py() for k in range(4))
                if piece == 0:
                    if reader:
                        done.append(reader.row())
                    reader = Reader(conv)
                reader.add(text, loss)
            if done:
                yield batch_of(done, batch.schema.field(0).type)
            id_type = batch.schema.field(0).type
        if reader:
            yield batch_of([reader.row()], id_type)

    def batch_of(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return formatted.select("conv_id", "piece", "text", "loss").mapInArrow(read, schema)
