"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: majority vote, bit by bit, over the XXH64 hashes of the word shingles of the whole
text. Two fingerprints link when at most ``radius`` bits differ.

Search: every bit position gets a nonzero vector of radius + 1 bits; table t (one for each nonzero vector) keeps
the positions whose vector has odd parity with t. For any ``radius`` differing positions some t
is orthogonal to all their vectors, so every pair within the radius agrees on all kept bits of
some table: no link can be missed, whatever the data.

Check: fingerprints that share a bucket differ only in the bits that its table drops. Each is sent
to itself and, for a radius of 2, to every fingerprint one dropped bit away. Two fingerprints are within 2 bits
exactly when they meet at such a midpoint, and all that meet are linked to the smallest.
A midpoint meets at most 65 distinct fingerprints, so no pairs are listed, no bucket is gathered and nothing is
capped. Exact copies are one fingerprint throughout.

Cases: null, empty and blank texts have fingerprint zero and link like any other; a text with
fewer words than a shingle is one shingle; ``component_id`` is the smallest non-null id reachable
(null only if all are null); repeated rows each get a row; an empty table gives an empty
result.
"""

from __future__ import annotations

from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldmart.llm.common import ship
from goldmart.llm.components import connected_components
from goldmart.session import materialize

BITS = 64
SEED = 42
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: A-Z only; splits at space and 9-13
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, total, _BLOCK):
        stop = min(total, start + _BLOCK)
        runs = zip(*(words[start + k:stop + k] for k in range(shingle))) if len(words) >= shingle else [words]
        hashes = np.array([xxh64_intdigest(b" ".join(run), SEED) for run in runs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(id, text_key, fp): one row per input row. ``text_key`` is the text's xxhash64, which with
    the id tells rows apart; ``fp`` is the fingerprint as a signed long."""
    source = df.select(df[f"`{id_col}`"].cast("long").alias("id"), F.xxhash64(df[f"`{text}`"]).alias("text_key"), df[f"`{text}`"].alias("text"))

    def run(batches):
        import numpy as np

        for batch in batches:
            fps = np.array([fingerprint(v.as_py(), shingle) for v in batch.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=["id", "text_key", "fp"])

    return source.mapInArrow(run, "id long, text_key long, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """One mask of kept bits for each nonzero vector of radius + 1 bits."""
    size = (1 << (radius + 1)) - 1
    spread = [1 + (b * 5 + b // size) % size for b in range(bits)]  # every vector is used about equally
    return [sum(1 << b for b in range(bits) if (spread[b] & t).bit_count() % 2) for t in range(1, size + 1)]


def _midpoints(fp: Column, dropped: list[int], steps: int) -> Column:
    """The fingerprint with every choice of up to ``steps`` dropped bits flipped."""
    flips = {0}
    for chosen in product(dropped, repeat=steps):
        flips.add(sum(1 << b for b in set(chosen)))
    return F.transform(F.array(*[F.lit(_signed(x)) for x in sorted(flips)]), lambda x: fp.bitwiseXOR(x))


def near_links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """(u, v): links that connect all fingerprints within ``radius`` bits of each other, given the
    distinct fingerprints (fp). The radius must be even: a midpoint lies half way."""
    if radius % 2:
        raise ValueError("the midpoint check needs an even radius")
    masks = covering_masks(radius)
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("t", "key"))
    shared = keyed.groupBy("t", "key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("t", "key")
    candidates = keyed.join(shared, ["t", "key"])
    mids = F.lit(None).cast("array<bigint>")
    for t, mask in enumerate(masks):
        dropped = [b for b in range(BITS) if not mask >> b & 1]
        mids = F.when(F.col("t") == t, _midpoints(F.col("fp"), dropped, radius // 2)).otherwise(mids)
    meeting = candidates.select("fp", F.explode(mids).alias("mid")).distinct()
    least = meeting.groupBy("mid").agg(F.min("fp").alias("v"), F.max("fp").alias("hi")).where("v <> hi").select("mid", "v")
    return meeting.join(least, "mid").where("fp <> v").select(F.col("fp").alias("u"), "v").distinct()


def _prints_and_groups(df: DataFrame, id_col: str, text: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    prints = materialize(with_fingerprint(df, id_col, text, shingle), "simhash-prints")
    return prints, materialize(fingerprint_components(prints, radius), "simhash-groups")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """(id, text_key, fp, component_id): one row per input row; ``component_id`` is the smallest
    id reachable over links of at most ``radius`` differing bits."""
    prints, groups = _prints_and_groups(df, id_col, text, shingle, radius)
    return prints.join(groups, "fp").select("id", "text_key", "fp", "component_id")


def fingerprint_components(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(fp, root, component_id) for the distinct fingerprints of ``prints`` (id, fp)."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-distinct")
    groups = connected_components(near_links(distinct.select("fp"), radius))
    rooted = distinct.join(groups, distinct["fp"] == groups["node"], "left").select("fp", "first_id", F.coalesce("component", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the row with the smallest id (nulls
    last, then the smallest text hash). Columns are unchanged."""
    prints, groups = _prints_and_groups(docs, id_col, text, shingle, radius)
    order = F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("id"), F.col("text_key").alias("text_key"))
    firsts = prints.groupBy("fp").agg(F.min(order).alias("first"))
    kept = firsts.join(groups, "fp").groupBy("root").agg(F.min("first").alias("k"))
    kept = kept.select(F.col("k.id").alias("__kept_id"), F.col("k.text_key").alias("__kept_key"))
    keyed = docs.withColumn("__id", F.col(f"`{id_col}`").cast("long")).withColumn("__key", F.xxhash64(F.col(f"`{text}`")))
    joined = keyed.join(kept, keyed["__id"].eqNullSafe(kept["__kept_id"]) & (keyed["__key"] == kept["__kept_key"]))
    return joined.dropDuplicates(["__id", "__key"]).select(*[joined[f"`{c}`"] for c in docs.columns])


ship(__name__)
