"""Byte-level BPE encoding and decoding of whole texts with a local rank file (tiktoken).

``encode`` adds the token ids of each text, ``decode`` turns ids back into the raw bytes. Both are
row-wise (no shuffle) and work batch by batch, so memory is bounded by one Arrow batch.

A long text is cut before encoding: tiktoken sees pieces of about ``PIECE_CHARS`` characters,
each cut placed between an ASCII letter and a following space. No match of the pre-splitting
pattern runs over such a place (a match takes white space only at its start, or is white space only and
looks no further than the next character after it), so the ids of the pieces in a row are
exactly the ids of the whole text. A text without such a place is encoded in one piece.

Cases: a null text counts as empty (no ids, empty bytes); repeated rows are encoded one by one; an
empty table gives an empty result; other columns pass through untouched. A column named like an
output (``n_tokens``, ``ids``, ``decoded``) is replaced by the output.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from goldmart.llm.common import appended, ship, slices

PIECE_CHARS = 20_000
_CUT = re.compile(r"[A-Za-z](?= [A-Za-z])")


def encoding(rank_file: str, pattern: str):
    """The encoder of a rank file, built once per task."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS):
    """Consecutive pieces of ``text``, cut only at safe boundaries."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.end()]
        start = cut.end()
    yield text[start:]


def encode(df: DataFrame, rank_file: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """Add ``n_tokens`` (long) and ``ids`` (binary, little-endian unsigned 32-bit) for each text;
    with ``decoded`` also ``decoded`` (binary), the bytes read back from the ids."""
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    if decoded:
        added.append(T.StructField("decoded", T.BinaryType()))
    kept, schema = appended(df, added)
    at = df.columns.index(text)

    def run(batches):
        import numpy as np

        enc = encoding(rank_file, pattern)
        for batch in (part for whole in batches for part in slices(whole, at)):
            n, ids, back = [], [], []
            for value in batch.column(at):
                tokens = []
                for piece in pieces(value.as_py() or ""):
                    tokens += enc.encode_ordinary(piece)
                n.append(len(tokens))
                ids.append(np.array(tokens, dtype="<u4").tobytes())
                if decoded:
                    back.append(enc.decode_bytes(tokens))
            out = [batch.column(i) for i in kept] + [pa.array(n, pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                out.append(pa.array(back, pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, rank_file: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded`` (binary): the raw bytes of the ids, whether or not they are valid UTF-8.
    Null ids decode to no bytes."""
    kept, schema = appended(df, [T.StructField("decoded", T.BinaryType())])
    at = df.columns.index(ids)

    def run(batches):
        import numpy as np

        enc = encoding(rank_file, pattern)
        for batch in batches:
            back = [enc.decode_bytes(np.frombuffer(v.as_py() or b"", dtype="<u4").tolist()) for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in kept] + [pa.array(back, pa.binary())], names=schema.names)

    return df.mapInArrow(run, schema)


ship(__name__)
