"""Divergence of sources by iceberg prefix refinement of their terms.

A term is a maximal run of ASCII letters and non-ASCII characters, A to Z in lower case. Each language keeps the terms that occur
in at least ``least_docs`` of its documents. They are found level by level over byte prefixes: a level counts, for each
prefix of its length, the distinct documents that hold a term with it, and discards the prefixes below the threshold;
the next level, ``GROWTH`` times as long, extends only what is left. A term that ends within a prefix carries an end byte, so it is complete
there; the levels go on until every prefix left is a complete term. No level holds more than the extensions of prefixes that
are frequent themselves, so the long tail of rare terms never reaches a shuffle in full.

A level is one scan. A task splits whole texts, counts the prefixes of each document's distinct terms in a bounded table and hands out partial
counts, which Spark sums by (language, prefix). The surviving prefixes travel to the next scan as a table of
``2^filter_bits`` bits: its size is fixed, and a prefix that passes by a shared bit only costs a row, since the exact counts
decide. Nothing else of the corpus comes to the driver.

Then one scan counts the kept terms of each (language, source). With N the sum of a group's counts and V the kept terms of the language,
a term has the share p = 1 + floor(10^9 (count + 5) / (N + 5 V)), in whole numbers throughout. ``pair_ranks`` compares the sources of
a language by the sum of |p - q| over all kept terms; ``term_ranks`` ranks the terms that a source uses more than its language as a whole.

Cases: null text, language and source are ''; a group without terms has shares as its counts of 0 give them; a language
without kept terms (V = 0) has pairs of value 0 and no terms; each row is a document, also a repeated one; equal
values are ranked by item in byte order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldmart.llm.chargrams import TokenIds
from goldmart.llm.common import ship, slices
from goldmart.session import materialize

LEAST_DOCS, FIRST_LEVEL, GROWTH, FILTER_BITS = 30, 6, 6, 24
SMOOTH, SCALE = 5, 1_000_000_000
TOP_TERMS = 50
_TERMS, _ENTRIES, _BATCH, _SLICE, _BLOCK = 300_000, 200_000, 50_000, 4 << 20, 1 << 20
# A byte that is no part of a term becomes a space, A to Z their lower case.
_SPLIT = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_END = b"\x00"


def terms_of(texts: pa.Array):
    """(terms, row): the terms of all texts (binary, no nulls) in order, as one array, and the text that each is of."""
    import numpy as np

    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    low = np.frombuffer(_SPLIT, np.uint8)[np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]]
    ends = ends - ends[0]
    inside = low != 32
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    # a text that begins with a term begins it anew, whatever the text before ends with; likewise a text's last byte ends one
    first = ends[:-1][np.diff(ends) > 0]
    begins[first] = inside[first]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | begins[1:]
    starts, kept = np.flatnonzero(begins), low[inside]
    cuts = np.concatenate([[0], np.cumsum(np.flatnonzero(closes) + 1 - starts)]).astype(np.int32)
    terms = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(kept)])
    return terms, np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, ends)))


def _ends_and_bytes(values: pa.Array):
    """(offsets, bytes) of a binary array without nulls, as numpy arrays; the offsets point into the bytes."""
    import numpy as np

    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int32)[values.offset:values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int32)
    return ends, np.frombuffer(data or b"", np.uint8)


def _listed(values: pa.Array) -> list[bytes]:
    ends, data = _ends_and_bytes(values)
    whole, ends = data.tobytes(), ends.tolist()
    return [whole[i:j] for i, j in zip(ends, ends[1:])]


_CRC_STEPS, _CRC_BYTES = [], 64


def crc32s(values: pa.Array, before):
    """zlib.crc32 of each value, going on from ``before`` (one number, or one for each value). A step takes one byte of every value that
    has one left; values of more than ``_CRC_BYTES`` bytes are taken one by one."""
    import numpy as np

    if not _CRC_STEPS:
        steps = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            steps = np.where(steps & 1, steps >> 1 ^ np.uint32(0xEDB88320), steps >> 1).astype(np.uint32)
        _CRC_STEPS.append(steps)
    steps, (ends, data) = _CRC_STEPS[0], _ends_and_bytes(values)
    starts, lengths = ends[:-1].astype(np.int64), np.diff(ends)
    before = np.broadcast_to(np.asarray(before, np.uint32), lengths.shape)
    crc = ~before
    left = np.flatnonzero((lengths > 0) & (lengths <= _CRC_BYTES))
    for at in range(_CRC_BYTES):
        if not len(left):
            break
        now = crc[left]
        crc[left] = steps[(now ^ data[starts[left] + at]) & 0xFF] ^ (now >> np.uint32(8))
        left = left[lengths[left] > at + 1]
    crc = ~crc
    for i in np.flatnonzero(lengths > _CRC_BYTES).tolist():
        crc[i] = zlib.crc32(data[ends[i]:ends[i + 1]].tobytes(), int(before[i]))
    return crc


def _place_column(lang: Column, key: Column, bits: int) -> Column:
    return F.crc32(F.concat(lang.cast("binary"), F.unhex(F.lit("00")), key)).bitwiseAND(F.lit((1 << bits) - 1))


class Survivors:
    """Bit table of the prefixes (or terms) that are left; without a table all are."""

    def __init__(self, rows: DataFrame | None, bits: int):
        """``rows``: (lang, key). At most 2^bits / 64 words come to the driver, however many rows there are. Each key also counts for
        the language '', which tells whether any language has it."""
        import numpy as np

        self.bits, self.table = bits, None
        if rows is not None:
            place = rows.select(F.explode(F.array(*[_place_column(c, F.col("key"), bits) for c in (F.col("lang"), F.lit(""))])).alias("p"))
            word = place.select((F.col("p") / 64).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int")).alias("b"))
            found = word.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
            words = np.zeros(1 << (bits - 6), "<i8")
            words[found.column("w").to_numpy()] = found.column("b").to_numpy()
            self.table = words.tobytes()

    def has(self, lang: bytes, keys: pa.Array):
        """For each key (binary): whether it is left in the language."""
        import numpy as np

        if self.table is None:
            return np.ones(len(keys), bool)
        place = crc32s(keys, zlib.crc32(lang + _END)) & np.uint32((1 << self.bits) - 1)
        return (np.frombuffer(self.table, np.uint8)[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


class _Tally:
    """Counts of a task by (owner, key): the keys of a slice's distinct terms are found at once (``keys_of``: terms to keys, null for none)
    and numbered, the slice is counted by sorting numbers, and equal counts are merged. What is pending is handed out beyond ``_TERMS`` keys or
    ``_ENTRIES`` counts, so memory stays bounded."""

    def __init__(self, keys_of):
        self.keys_of, self.terms, self.owners = keys_of, TokenIds(), {}
        self.codes, self.ns = [], []

    def add(self, owners, texts, per_document: bool):
        import numpy as np

        found, row = terms_of(pa.array(texts, pa.binary()))
        # only the distinct keys of a slice become Python objects
        coded = found.dictionary_encode()
        keyed = self.keys_of(coded.dictionary).dictionary_encode()
        numbers = np.fromiter(map(self.terms.__getitem__, _listed(keyed.dictionary)), np.int64, len(keyed.dictionary))
        self.terms.fresh.clear()
        # the last number stands for the terms without a key
        of_term = np.append(numbers, -1)[keyed.indices.fill_null(-1).to_numpy()]
        own = np.fromiter((self.owners.setdefault(o, len(self.owners)) for o in owners), np.int64, len(texts))
        key = of_term[coded.indices.to_numpy()]
        row, key = row[key >= 0], key[key >= 0]
        width = max(len(self.terms), 1)
        packed = own[row] * width + key
        if per_document:
            bits = len(texts).bit_length()
            packed = np.sort(packed << bits | row)
            packed = packed[np.diff(packed, prepend=-1) != 0] >> bits
        else:
            packed = np.sort(packed)
        starts = np.flatnonzero(np.diff(packed, prepend=-1))
        codes = packed[starts]
        self.codes.append(codes // width << 32 | codes % width)
        self.ns.append(np.diff(starts, append=len(packed)))

    def merge(self):
        import numpy as np

        codes, at = np.unique(np.concatenate([np.zeros(0, np.int64), *self.codes]), return_inverse=True)
        self.ns = [np.bincount(at, weights=np.concatenate([np.zeros(0), *self.ns]), minlength=len(codes)).astype(np.int64)]
        self.codes = [codes]

    def full(self) -> bool:
        if sum(map(len, self.codes)) > 2 * _ENTRIES:
            self.merge()
        return len(self.terms) > _TERMS or len(self.codes) == 1 and len(self.codes[0]) > _ENTRIES

    def handed_out(self, passes, names):
        """Batches of (owner..., key, count) for the counts so far whose language and key ``passes`` lets through (language, keys: one verdict or
        one for each key)."""
        import numpy as np

        self.merge()
        codes, ns, owners, texts = self.codes[0], self.ns[0], list(self.owners), pa.array(list(self.terms), pa.binary())
        # the first column of an owner is its language: each key is looked up once for each language
        langs = {}
        lang_of = np.array([langs.setdefault(o[0], len(langs)) for o in owners], np.int64)
        pairs, at = np.unique(lang_of[codes >> 32] << 32 | codes & 0xFFFFFFFF, return_inverse=True) if len(codes) else (codes, codes)
        let, bounds = np.zeros(len(pairs), bool), np.searchsorted(pairs >> 32, np.arange(len(langs) + 1))
        for lang, begin, end in zip(langs, bounds, bounds[1:]):
            let[begin:end] = passes(lang, texts.take(pa.array(pairs[begin:end] & 0xFFFFFFFF)))
        codes, ns = (codes[let[at]], ns[let[at]]) if len(codes) else (codes, ns)
        columns = [pa.array([o[i] for o in owners], pa.binary()) for i in range(len(names) - 2)]
        for start in range(0, max(len(codes), 1), _BATCH):
            part = codes[start:start + _BATCH]
            own, key = pa.array(part >> 32), pa.array(part & 0xFFFFFFFF)
            yield pa.RecordBatch.from_arrays([*[c.take(own) for c in columns], texts.take(key), pa.array(ns[start:start + _BATCH], pa.int64())], names=names)
        self.__init__(self.keys_of)


def _tallied(rows: DataFrame, owners: list[str], keys_of, per_document: bool, passes) -> DataFrame:
    """(owners..., key, n), summed: how often each key occurs (``per_document``: in how many rows)."""
    names, at = [*owners, "key", "n"], len(owners)

    def run(batches):
        tally = _Tally(keys_of)
        for batch in (part for whole in batches for part in slices(whole, at, _SLICE)):
            columns = [[v.as_py() or b"" for v in batch.column(i).cast(pa.binary())] for i in range(at + 1)]
            tally.add(list(zip(*columns[:at])), columns[at], per_document)
            if tally.full():
                yield from tally.handed_out(passes, names)
        yield from tally.handed_out(passes, names)

    found = rows.select(*owners, "text").mapInArrow(run, ", ".join(f"{o} binary" for o in owners) + ", key binary, n long")
    texts = [F.col(o).cast("string").alias(o) for o in owners]
    return found.groupBy(*texts, "key").agg(F.sum("n").alias("n"))


def kept_terms(rows: DataFrame, least_docs: int = LEAST_DOCS, first: int = FIRST_LEVEL, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, key): the complete terms (UTF-8 bytes) in at least ``least_docs`` documents of their language.
    ``rows`` has lang, source and text without nulls."""
    length, before, left, complete = first, 0, Survivors(None, bits), []
    while True:
        level = materialize(_level(rows, length, before, left).where(F.col("n") >= least_docs), f"prefixes-{length}")
        ended = F.substring("key", -1, 1) == F.unhex(F.lit("00"))
        complete.append(level.where(ended).selectExpr("lang", "substring(key, 1, length(key) - 1) AS key"))
        open_ones = level.where(~ended).select("lang", "key")
        if open_ones.isEmpty():
            break
        before, length, left = length, GROWTH * length, Survivors(open_ones, bits)
    found = complete[0]
    for more in complete[1:]:
        found = found.unionByName(more)
    return found


def _level(rows: DataFrame, length: int, before: int, left: Survivors) -> DataFrame:
    """(lang, key, n): documents for each prefix of ``length`` bytes that extends a surviving prefix of ``before`` bytes. The key of a
    term that ends within it has the end byte last; a term that ended within the prefix before has no key any more."""

    def keys_of(terms):
        import pyarrow.compute as pc

        ended = pc.binary_join_element_wise(terms, pa.scalar(_END, pa.binary()), pa.scalar(b"", pa.binary()))
        keys = pc.binary_slice(ended, 0, length)
        return _only(keys, pc.greater_equal(pc.binary_length(terms), before), left.has(b"", pc.binary_slice(terms, 0, before))) if before else keys

    def passes(lang, keys):
        import pyarrow.compute as pc

        return left.has(lang, pc.binary_slice(keys, 0, before))

    return _tallied(rows, ["lang"], keys_of, True, passes)


def _only(keys: pa.Array, *tests) -> pa.Array:
    """The keys that pass all tests, null in the place of the others."""
    import numpy as np
    import pyarrow.compute as pc

    passed = np.logical_and.reduce([np.asarray(t, bool) for t in tests])
    return pc.if_else(pa.array(passed, pa.bool_()), keys, pa.scalar(None, pa.binary()))


def term_counts(rows: DataFrame, kept: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, source, term, n): occurrences of the kept terms in each group, n > 0."""
    wanted = Survivors(kept, bits)
    found = _tallied(rows, ["lang", "source"], lambda terms: _only(terms, wanted.has(b"", terms)), False, wanted.has)
    return found.join(kept, ["lang", "key"]).select("lang", "source", F.col("key").cast("string").alias("term"), "n")


def share(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE (count + SMOOTH) / (total + SMOOTH kinds)), in decimals of 38 digits, as a long."""
    wide = lambda c: c.cast("decimal(19,0)")
    # the integral division of decimals gives a long; a denominator of 0 (no kept terms) never has terms to divide for
    above = F.lit(SCALE).cast("decimal(10,0)") * (wide(count) + F.lit(SMOOTH))
    below = F.nullif(wide(total) + F.lit(SMOOTH) * wide(kinds), F.lit(0).cast("decimal(30,0)"))
    return F.coalesce(F.call_function("div", above, below), F.lit(0).cast("long")) + F.lit(1)


def _tables(docs: DataFrame, lang: str, source: str, text: str, least_docs: int, first: int, bits: int):
    """(rows of groups, counts): (lang, source, total, kinds, base) and (lang, source, term, n, total, kinds)."""
    rows = docs.select(*[F.coalesce(docs[f"`{c}`"].cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    kept = kept_terms(rows, least_docs, first, bits)
    counts = materialize(term_counts(rows, kept, bits), "term-counts")
    kinds = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kinds, "lang", "left")
    groups = groups.fillna(0, ["total", "kinds"]).withColumn("base", share(F.lit(0), F.col("total"), F.col("kinds")))
    return materialize(groups, "source-groups"), counts


def term_ranks(groups: DataFrame, counts: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a source uses more than its language, by the excess."""
    own = counts.join(groups.select("lang", "source", "total", "kinds"), ["lang", "source"])
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"))
    size = groups.groupBy("lang").agg(F.sum("total").alias("total_lang"))
    both = own.join(whole, ["lang", "term"]).join(size, "lang")
    p, q = share(F.col("n"), F.col("total"), F.col("kinds")), share(F.col("n_lang"), F.col("total_lang"), F.col("kinds"))
    above = both.select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return above.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def _distances(vectors: DataFrame) -> DataFrame:
    """(lang, i, j, value): sums of |difference| of places i < j over the vectors (lang, shares) of each language, all of a language
    equally long. A task adds up whole blocks of vectors, so it hands out one row for a pair."""

    def run(batches):
        import numpy as np

        sums = {}
        for batch in batches:
            langs, shares = batch.column(0).dictionary_encode(), batch.column(1)
            codes = langs.indices.to_numpy()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                own = shares.filter(pa.array(codes == code))
                width = len(own[0])
                matrix = own.flatten().to_numpy().reshape(len(own), width)
                total = sums.setdefault(lang, np.zeros((width, width), np.int64))
                for at in range(0, len(matrix), step := max(1, _BLOCK // width)):
                    part = matrix[at:at + step]
                    for i in range(width - 1):
                        total[i, i + 1:] += np.abs(part[:, i + 1:] - part[:, i:i + 1]).sum(axis=0)
        for lang, total in sums.items():
            i, j = np.triu_indices(len(total), 1)
            for at in range(0, len(i), _BATCH):
                cut = slice(at, at + _BATCH)
                columns = [pa.array([lang] * len(i[cut]), pa.string()), pa.array(i[cut], pa.int32()), pa.array(j[cut], pa.int32()), pa.array(total[i[cut], j[cut]])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "i", "j", "value"])

    return vectors.mapInArrow(run, "lang string, i int, j int, value long").groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def pair_ranks(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every other source of the language by the sum of |p - q| over all kept terms. Each kept term
    is one vector of shares, a place for each source of its language (the share of an absent term where it does not occur)."""
    shares = counts.join(groups.select("lang", "source", "total", "kinds"), ["lang", "source"])
    shares = shares.select("lang", "term", "source", share(F.col("n"), F.col("total"), F.col("kinds")).alias("p"))
    per_term = shares.groupBy("lang", "term").agg(F.map_from_entries(F.collect_list(F.struct("source", "p"))).alias("p"))
    sources = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "base"))).alias("sources"))
    vectors = per_term.join(sources, "lang").select("lang", F.expr("transform(sources, s -> coalesce(try_element_at(p, s.source), s.base))").alias("shares"))
    places = sources.select("lang", F.posexplode("sources").alias("at", "s")).select("lang", "at", F.col("s.source").alias("source"))
    both = places.alias("a").join(places.alias("b"), "lang").where("a.at <> b.at").select(
        "lang", F.col("a.source").alias("source"), F.col("b.source").alias("item"), F.least("a.at", "b.at").alias("i"), F.greatest("a.at", "b.at").alias("j"))
    # a language without kept terms has no vectors: its distances are 0
    found = both.join(_distances(vectors), ["lang", "i", "j"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(w))


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP_TERMS,
    first: int = FIRST_LEVEL, bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` of ``pair_ranks`` and part ``term`` of ``term_ranks``."""
    groups, counts = _tables(docs, lang, source, text, least_docs, first, bits)
    parts = [df.withColumn("part", F.lit(name)) for name, df in (("pair", pair_ranks(groups, counts)), ("term", term_ranks(groups, counts, top)))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))


ship(__name__)
