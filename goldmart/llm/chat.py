"""Chat formatting with typed content parts, a reversible template and a loss mask.

A turn's content is a text, or a list of typed parts (text, image, audio, document). A visitor
flattens the parts into one text with ordered placeholders, records each attachment's reference
and position, and counts the tokens that the placeholders will expand to.

Template, one segment per turn:  ``<s>[INST]`` role ``[/INST]`` text ``</s>``.
Control strings inside a role or a text are escaped: a backslash doubles, and a control string gets
a backslash after its first character; so a segment splits at its own marks only, and dropping
the escapes gives the text back. The loss mask covers the texts of the trained roles, without marks.

``format_turns`` is row-wise. ``read_back`` parses the formatted segments again; rows are shuffled
and sorted by conversation and streamed, so a task holds one batch, never a whole conversation (a
digest over a conversation is sequential by nature: its turns are read by one task, in order).

Cases: a null text is empty, a null role is the empty role, null content parts and unknown part types
give no text but unknown types count in ``skipped``; turns with equal numbers are ordered by role, then text;
null turn numbers come first; repeated rows are repeated turns; a null conversation id is a
conversation of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldmart.llm.common import ship

OPEN, ROLE_END, CLOSE = "<s>[INST]", "[/INST]", "</s>"
# The control strings of the template.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<image>", "<audio>", "<document>"]
TRAINED = ("assistant",)
PART_TYPE = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
TURN_TYPE = (
    "conv_id long, turn long, role string, formatted string, loss_start int, loss_end int, "
    "attachments array<struct<kind:string,ref:string,position:int,tokens:long>>, expanded_tokens long, skipped int"
)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for mark in CONTROL:
        text = text.replace(mark, mark[0] + "\\" + mark[1:])
    return text


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    out, at = [], 0
    while (cut := text.find("\\", at)) >= 0 and cut + 1 < len(text):
        out.append(text[at:cut] + text[cut + 1])
        at = cut + 2
    return "".join(out) + text[at:]


class Flatten:
    """Visitor over content parts: builds the text, the attachment list and the token count."""

    #: Tokens that one placeholder expands to: image tiles of 336 pixels, audio frames, pages.
    TILE, TOKENS_A_TILE, TOKENS_A_SECOND, TOKENS_A_PAGE = 336, 144, 25, 256

    def __init__(self):
        self.out, self.length, self.attachments, self.tokens, self.skipped = [], 0, [], 0, 0

    def visit(self, part) -> None:
        if part is not None:
            getattr(self, f"visit_{part.get('type') or 'text'}", self.unknown)(part)

    def visit_text(self, part) -> None:
        self._emit(escape(part.get("text") or ""))

    def visit_image(self, part) -> None:
        tiles = math.ceil((part.get("width") or self.TILE) / self.TILE) * math.ceil((part.get("height") or self.TILE) / self.TILE)
        self._attach("image", part, max(1, tiles) * self.TOKENS_A_TILE)

    def visit_audio(self, part) -> None:
        self._attach("audio", part, math.ceil((part.get("seconds") or 0.0) * self.TOKENS_A_SECOND))

    def visit_document(self, part) -> None:
        self._attach("document", part, max(1, part.get("pages") or 1) * self.TOKENS_A_PAGE)

    def unknown(self, part) -> None:
        self.skipped += 1

    def _attach(self, kind: str, part, tokens: int) -> None:
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "position": self.length, "tokens": tokens})
        self.tokens += tokens
        self._emit(f"<{kind}>")

    def _emit(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)


def format_turn(role: str | None, content, trained=TRAINED) -> dict:
    """One segment: formatted text, loss span in it (start, end code points), attachments (their
    positions count from the segment's start), expanded token count, skipped parts."""
    seen = Flatten()
    for part in [{"type": "text", "text": content}] if content is None or isinstance(content, str) else content:
        seen.visit(part)
    head = OPEN + escape(role or "") + ROLE_END
    for found in seen.attachments:
        found["position"] += len(head)
    end = len(head) + seen.length if role in trained else len(head)
    return {
        "formatted": head + "".join(seen.out) + CLOSE, "loss_start": len(head), "loss_end": end,
        "attachments": seen.attachments, "expanded_tokens": seen.tokens, "skipped": seen.skipped,
    }


def text_parts(text: Column) -> Column:
    """A plain text column as a list of one text part."""
    nothing = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()]))


def format_turns(turns: DataFrame, content: Column | None = None, trained=TRAINED) -> DataFrame:
    """Format each row of (conv_id, turn, role, text); ``content`` (a list of typed parts, see
    ``PART_TYPE``) replaces the text column when given. One row per turn, columns of ``TURN_TYPE``."""
    source = turns.select(
        turns["`conv_id`"].cast("long").alias("conv_id"), turns["`turn`"].cast("long").alias("turn"), turns["`role`"].alias("role"),
        (turns["`text`"] if content is None else content.cast(PART_TYPE)).alias("content"),
    )

    def run(batches):
        for batch in batches:
            made = [format_turn(r.as_py(), c.as_py(), trained) for r, c in zip(batch.column(2), batch.column(3))]
            kinds = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("position", pa.int32()), ("tokens", pa.int64())]))
            types = {"formatted": pa.string(), "loss_start": pa.int32(), "loss_end": pa.int32(), "attachments": kinds, "expanded_tokens": pa.int64(), "skipped": pa.int32()}
            arrays = [pa.array([m[k] for m in made], t) for k, t in types.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *arrays], names=["conv_id", "turn", "role", *types])

    return source.mapInArrow(run, TURN_TYPE)


def parse_segment(segment: str) -> tuple[str, str]:
    """(role, text) of a formatted segment; attachments stay as placeholders in the text."""
    if not segment.startswith(OPEN) or not segment.endswith(CLOSE):
        raise ValueError("not a formatted turn")
    role, _, text = segment[len(OPEN):len(segment) - len(CLOSE)].partition(ROLE_END)
    return unescape(role), unescape(text)


class _Digest:
    """Running figures of one conversation."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.formatted_chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int, end: int) -> None:
        role, text = parse_segment(segment)
        masked = unescape(segment[start:end])
        self.turns += 1
        self.all.update(f"{role}\n{text}\n".encode())
        self.loss.update(masked.encode())
        self.loss_chars += len(masked)
        self.formatted_chars += len(segment)

    def row(self):
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read from the formatted segments and their loss spans."""
    ordered = formatted.select("conv_id", "turn", "role", "formatted", "loss_start", "loss_end")
    ordered = ordered.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), "formatted"
    )
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        open_now, done = None, []
        for batch in batches:
            for conv, segment, start, end in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 5))):
                if open_now is None or open_now.conv != conv:
                    if open_now is not None:
                        done.append(open_now.row())
                    open_now = _Digest(conv)
                open_now.add(segment, start, end)
            if len(done) >= 5000:
                yield batch_of(done)
                done = []
        if open_now is not None:
            done.append(open_now.row())
        if done:
            yield batch_of(done)

    return ordered.mapInArrow(run, schema)


ship(__name__)
