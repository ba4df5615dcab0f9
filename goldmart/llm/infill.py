"""Fill-in-middle transformation by in-place rotation of blocks.

A text is cut at line ends into prefix, middle and suffix. The three sentinels are inserted into a bytearray
of its UTF-8 bytes, which then holds ``<P>`` prefix ``<M>`` middle ``<S>`` suffix, and one rotation brings the blocks into
the wanted order: ``psm`` exchanges middle and suffix, ``spm`` brings the suffix to the front. A rotation
reverses both segments and then the whole stretch, in place. ``restore`` finds the sentinels, turns the same stretch
back, takes the sentinels out and so has the exact text again.

Cuts and form come from a hash of ``seed`` and the row's id, so a lost task that runs again gives the same rows.
Everything is row-wise (no shuffle); a batch is worked on in slices of a few MB, so memory follows the longest text.

Cases: a null text is empty; an empty text, and a text that holds a sentinel of its own, stays ``plain`` (output = text, no
cuts); a null id hashes as the empty text; equal ids get equal draws; an empty table gives an empty
result; other columns pass through, and a column named like an output is replaced by it.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from goldmart.llm.common import appended, ship, slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_STEP = 1 << 16


@dataclass(frozen=True)
class Draw:
    """What is drawn for a row: ``share`` of the texts in per cent is transformed, ``spm`` per cent of these suffix first."""

    seed: str = "7"
    share: int = 100
    spm: int = 50

    def numbers(self, key) -> list[int]:
        digest = hashlib.sha256(f"{self.seed}:{'' if key is None else key}".encode()).hexdigest()
        return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


def line_ends(data: bytes):
    """Byte places after each line; the last line need not end with a line feed."""
    import numpy as np

    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    return ends if not data or data.endswith(b"\n") else np.append(ends, len(data))


def characters(data) -> int:
    """Code points of UTF-8 bytes: all bytes but the continuation bytes."""
    import numpy as np

    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def reverse(view, start: int, stop: int) -> None:
    """Reverse a stretch of an array of bytes in place, ``_STEP`` bytes from either end at a time."""
    while stop - start > 1:
        step = min(_STEP, (stop - start) // 2)
        head = view[start:start + step].copy()
        view[start:start + step] = view[stop - step:stop][::-1]
        view[stop - step:stop] = head[::-1]
        start, stop = start + step, stop - step


def rotate(block: bytearray, start: int, middle: int, stop: int) -> None:
    """Exchange the neighbouring segments [start, middle) and [middle, stop) by three reversals."""
    import numpy as np

    view = np.frombuffer(block, np.uint8)
    reverse(view, start, middle)
    reverse(view, middle, stop)
    reverse(view, start, stop)


def rearrange(data: bytes, first: int, second: int, form: str) -> bytearray:
    """The text with sentinels, its middle being the bytes from ``first`` to ``second``."""
    block = bytearray(data)
    block[second:second] = SUFFIX
    block[first:first] = MIDDLE
    block[0:0] = PREFIX
    at_middle, at_suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(block, at_middle if form == "psm" else 0, at_suffix, len(block))
    return block


def restored(output: bytes, form: str) -> bytes:
    """The exact text of an output and its form."""
    if form == "plain":
        return output
    block = bytearray(output)
    start = block.index(SUFFIX) if form == "psm" else 0
    rotate(block, start, block.index(MIDDLE if form == "psm" else PREFIX), len(block))
    for mark in (PREFIX, MIDDLE, SUFFIX):
        at = block.index(mark)
        del block[at:at + len(mark)]
    return bytes(block)


def _row(data: bytes, key, draw: Draw):
    """(lines, form, code points of prefix and middle, output) of one text."""
    ends = line_ends(data)
    h1, h2, h3, h4 = draw.numbers(key)
    if not data or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= draw.share:
        return len(ends), "plain", None, None, data
    form = "spm" if h4 % 100 < draw.spm else "psm"
    cuts = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    first, second = (int(ends[c - 1]) if c else 0 for c in cuts)
    return len(ends), form, characters(data[:first]), characters(data[first:second]), bytes(rearrange(data, first, second, form))


_OUT = [
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()), T.StructField("output", T.BinaryType()),
]


def transform(df: DataFrame, id_col: str = "doc_id", text: str = "text", draw: Draw = Draw(), restore_too: bool = False) -> DataFrame:
    """Add ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` (UTF-8 bytes); with ``restore_too``
    also ``restored``, the bytes rebuilt from output and form."""
    added = _OUT + ([T.StructField("restored", T.BinaryType())] if restore_too else [])
    kept, schema = appended(df, added)
    at, key_at = df.columns.index(text), df.columns.index(id_col)

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, at)):
            texts = batch.column(at).cast(pa.binary())
            rows = [_row(t.as_py() or b"", k.as_py(), draw) for t, k in zip(texts, batch.column(key_at))]
            if restore_too:
                rows = [(*r, restored(r[4], r[1])) for r in rows]
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            made = [pa.array([r[i] for r in rows], types[i]) for i in range(len(added))]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in kept] + made, names=schema.names)

    return df.mapInArrow(run, schema)


def restore(df: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """Add ``restored`` (bytes): the text of each output; null where output or form is null."""
    kept, schema = appended(df, [T.StructField("restored", T.BinaryType())])
    at, form_at = df.columns.index(output), df.columns.index(form)

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, at)):
            pairs = zip(batch.column(at).to_pylist(), batch.column(form_at).to_pylist())
            back = pa.array([None if o is None or f is None else restored(o, f) for o, f in pairs], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in kept] + [back], names=schema.names)

    return df.mapInArrow(run, schema)


ship(__name__)
