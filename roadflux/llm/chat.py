"""Chat formatting with typed content parts.

A turn's content is a text or a list of parts (type, text, ref, width, height, seconds, pages). A visitor flattens the parts in order:
texts are escaped, an image, audio or document part leaves the placeholder ``<|type:k|>`` (k counts the attachments of the
conversation) and an attachment record with its reference and the number of tokens it expands to. Parts of another type leave
``<|other:k|>``, expanding to none. Neighbouring text parts are one text.

The template marks turns; ``text`` is what the visitor made of the content:

    user        <s>[INST] text [/INST]
    assistant    text</s>                     (with a space before it)
    other       [TURN]role<newline>text[/TURN] (the role percent-encoded; a null role is empty)

Control strings inside texts and roles can't be taken for the template's: a backslash is put behind their first character, and where
backslashes stand there already, one more; reading takes one away. Nothing else changes, so every text comes back as it was.

The loss mask holds, in code points of the formatted text, the text of each assistant turn without the template's marks.

A conversation is its rows by turn; equal turns are ordered by role and content, repeated rows count each, null ids are one conversation.
A null text is empty. Rows of a conversation follow each other in one task, sorted on disk if need be, and pass through it with an open piece as the
only state: a conversation leaves as pieces of about ``PIECE`` characters, cut between turns (nearly always one), so that even
one that holds a third of all rows needs no memory of its size. Digests over a conversation are taken turn by turn too. Columns other than
those named are not used, so extra ones may have any name. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

PIECE = 1 << 20
ROWS = 1000
# The template's marks, and what an attachment expands to.
KINDS = ["image", "audio", "document", "other"]
CONTROL = r"([<\[])(\\*)(/?s>|/?(?:INST|TURN)\]|\|(?:image|audio|document|other):[0-9]+\|>)"
PATCH, AUDIO_TOKENS_A_SECOND, TOKENS_A_PAGE = 28, 25, 512

_MARKED = re.compile(CONTROL)
_ESCAPED = re.compile(CONTROL.replace(r"(\\*)", r"\\(\\*)", 1))
_PLACEHOLDER = re.compile(r"<\|(image|audio|document|other):([0-9]+)\|>")
_TURN = re.compile(r"<s>\[INST\] (?P<user>.*?) \[/INST\]|\[TURN\](?P<role>[^\n]*)\n(?P<text>.*?)\[/TURN\]| (?P<assistant>.*?)</s>", re.S)

PART = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("text", T.StringType()), T.StructField("ref", T.StringType()),
    T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()),
    T.StructField("seconds", T.DoubleType()), T.StructField("pages", T.IntegerType()),
])
_ATTACHMENT = pa.struct([("k", pa.int32()), ("turn", pa.int64()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
_PIECES = ("conv_id long, piece int, first_turn long, formatted string, loss array<struct<begin:bigint,end:bigint>>, "
           "attachments array<struct<k:int,turn:bigint,type:string,ref:string,tokens:bigint>>, expanded_tokens long")


def escaped(text: str) -> str:
    return _MARKED.sub(r"\1\2\\\3", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


class Visitor:
    """Flattens the parts of one conversation's turns."""

    def __init__(self) -> None:
        self.attachments = 0
        self.texts: list[str] = []
        self.shown: list[str] = []
        self.found: list[dict] = []

    def flatten(self, parts: list[dict], turn: int) -> tuple[str, list[dict]]:
        """The text of a turn and its attachments."""
        self.texts, self.shown, self.found, self.turn = [], [], [], turn
        for part in parts:
            getattr(self, f"visit_{part['type']}" if part["type"] in ("text", *KINDS) else "visit_other")(part)
        self._end_text()
        return "".join(self.shown), self.found

    def _end_text(self) -> None:
        self.shown.append(escaped("".join(self.texts)))
        self.texts = []

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self._end_text()
        self.shown.append(f"<|{kind}:{self.attachments}|>")
        self.found.append({"k": self.attachments, "turn": self.turn, "type": part["type"], "ref": part["ref"], "tokens": tokens})
        self.attachments += 1

    def visit_text(self, part: dict) -> None:
        self.texts.append(part["text"] or "")

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, math.ceil((part["width"] or 0) / PATCH) * math.ceil((part["height"] or 0) / PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part["seconds"] or 0) * AUDIO_TOKENS_A_SECOND))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part["pages"] or 0) * TOKENS_A_PAGE)

    def visit_other(self, part: dict) -> None:
        self._attach("other", part, 0)


def framed(role: str | None, text: str) -> tuple[str, int | None]:
    """A turn with the template's marks, and where its text begins if it counts for the loss."""
    if role == "user":
        return f"<s>[INST] {text} [/INST]", None
    if role == "assistant":
        return f" {text}</s>", 1
    return f"[TURN]{quote(role or '', safe='')}\n{text}[/TURN]", None


@dataclass
class _Open:
    """The piece being made."""

    conv: int | None
    number: int = 0
    turn: int = 0
    first: int = 0
    size: int = 0
    texts: list[str] = field(default_factory=list)
    loss: list[dict] = field(default_factory=list)
    attached: list[dict] = field(default_factory=list)
    visitor: Visitor = field(default_factory=Visitor)

    def add(self, role: str | None, content) -> None:
        parts = [{"type": "text", "text": content}] if content is None or isinstance(content, str) else [p for p in content if p is not None]
        text, attached = self.visitor.flatten(parts, self.turn)
        shown, begin = framed(role, text)
        if begin is not None:
            self.loss.append({"begin": self.size + begin, "end": self.size + begin + len(text)})
        self.texts.append(shown)
        self.attached += attached
        self.size += len(shown)
        self.turn += 1

    def taken(self) -> tuple:
        row = (self.conv, self.number, self.first, "".join(self.texts), self.loss, self.attached, sum(a["tokens"] for a in self.attached))
        self.number, self.first, self.size = self.number + 1, self.turn, 0
        self.texts, self.loss, self.attached = [], [], []
        return row


def formatted(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", content_col: str = "text", piece: int = PIECE) -> DataFrame:
    """The conversations as pieces (nearly always one): conv_id, piece, first_turn, formatted, loss, attachments, expanded_tokens."""
    rows = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(content_col).alias("content"))

    def framed_rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(_SPAN), pa.list_(_ATTACHMENT), pa.int64()]
        names = ["conv_id", "piece", "first_turn", "formatted", "loss", "attachments", "expanded_tokens"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Open | None = None
        done, size = [], 0
        for batch in batches:
            for conv, role, content in zip(batch.column(0), batch.column(2), batch.column(3)):
                own = conv.as_py()
                if now is None or now.conv != own:
                    if now is not None and now.texts:
                        size += now.size
                        done.append(now.taken())
                    now = _Open(own)
                now.add(role.as_py(), content.as_py())
                if now.size >= piece:
                    size += now.size
                    done.append(now.taken())
                if size >= PIECE or len(done) >= ROWS:
                    yield framed_rows(done)
                    done, size = [], 0
        if now is not None and now.texts:
            done.append(now.taken())
        if done:
            yield framed_rows(done)

    return rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "content").mapInArrow(run, _PIECES)


def turns_of(text: str, attachments: list[dict] = ()) -> Iterator[tuple[str, list[dict]]]:
    """(role, parts) of each turn of a formatted piece; adjacent texts come back as one part."""
    known = {a["k"]: a for a in attachments}
    at = 0
    while at < len(text):
        turn = _TURN.match(text, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        at = turn.end()
        kind = turn.lastgroup
        role = unquote(turn["role"]) if kind == "text" else kind
        parts, begin = [], 0
        body = turn[kind]
        for held in _PLACEHOLDER.finditer(body):
            if held.start() > begin:
                parts.append({"type": "text", "text": unescaped(body[begin:held.start()])})
            a = known[int(held[2])]
            parts.append({"type": a["type"], "ref": a["ref"], "tokens": a["tokens"]})
            begin = held.end()
        if begin < len(body):
            parts.append({"type": "text", "text": unescaped(body[begin:])})
        yield role, parts


def digests(pieces: DataFrame) -> DataFrame:
    """What is read back from formatted pieces, a row per conversation: conv_id, n_turns, turns_sha256 (role, newline, text, newline
    of every turn), loss_chars and loss_sha256 (text under the loss mask, unescaped), formatted_chars, n_attachments, expanded_tokens.

    Texts of a turn with attachments are joined over their places.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_attachments", "expanded_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def ended() -> tuple:
            return (now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), *now[5:])

        for batch in batches:
            for piece in batch.to_pylist():
                if now is None or now[0] != piece["conv_id"]:
                    if now is not None:
                        done.append(ended())
                    now = [piece["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                for role, parts in turns_of(piece["formatted"], piece["attachments"]):
                    now[1] += 1
                    now[2].update(f"{role}\n{''.join(p['text'] for p in parts if p['type'] == 'text')}\n".encode())
                for span in piece["loss"]:
                    text = unescaped(_PLACEHOLDER.sub("", piece["formatted"][span["begin"]:span["end"]]))
                    now[3] += len(text)
                    now[4].update(text.encode())
                now[5] += len(piece["formatted"])
                now[6] += len(piece["attachments"])
                now[7] += piece["expanded_tokens"]
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) if k in (2, 4) else pa.array(c, pa.int64()) for k, c in enumerate(zip(*done))], names)
                done = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) if k in (2, 4) else pa.array(c, pa.int64()) for k, c in enumerate(zip(*[ended()]))], names)

    schema = ", ".join(f"{c} {'string' if c.endswith('sha256') else 'long'}" for c in names)
    used = pieces.select("conv_id", "piece", "formatted", "loss", "attachments", "expanded_tokens")
    return used.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(run, schema)
