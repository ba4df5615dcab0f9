"""Document fingerprints as invertible Bloom lookup sketches of content-cut paragraphs.

The units of a text are its words (a run of more than ``RUN`` characters: its characters). A paragraph of level L is a stretch of
units that ends after each unit whose hash with the next ``AHEAD`` - 1 is a multiple of 2^L, and after ``STRETCH`` 2^L units at the latest;
so paragraphs do not depend on places, and an insertion changes those around it only. A text of ``LEAST`` to 2 ``LEAST``
units has its paragraphs of levels 0 and 1, one of twice as many those of levels 1 and 2, and so on: every text has some tens of
paragraphs, and texts whose sizes differ by a factor of two still share a level. A text of fewer units has the
pairs of neighbouring characters (the first with a begin mark) and its paragraphs of level 0, the single words. Each distinct
paragraph is a 64-bit digest.

A digest has 40 bits of a hash and a check of them in the other 24. A sketch has three rows of cells; a digest goes to one cell of each row, where
counts add up and digests are xored. Subtracting two sketches cell by cell cancels what they share; peeling then takes a
cell that holds a single digest (count 1 or -1, check right), notes the digest, removes it from its
other cells, and so on until nothing is left: what was noted are the differing digests, and their
number gives the likeness (shared / all distinct paragraphs).

The fingerprint is the sketch of ``BASE_WIDTH`` cells a row. Two fingerprints are subtracted and peeled first, which suffices for near
copies. When peeling stops early, larger sketches follow: the digests are split by their high bits into parts of about ``PART`` (one that only one text has differs as a whole), with a
sketch of ``FIRST_WIDTH`` cells a row each, and a part that does not peel is sketched again with twice the cells and other hashes, ``ATTEMPTS`` times.
A part that even the last sketch (64 times the first cells) cannot peel, which takes two digests that agree in 24 bits under six hashes, is compared digest by digest.

All are array expressions on the row that holds the two texts: no shuffle beyond the one that brings a document's successor. That one
deals rows by quantiles of (id, hash of the text), so equal ids are spread too, and a copy of each bucket's first row stands in as the
successor of the last row of the bucket before.

Cases: a null text is empty; two empty texts have likeness 1; null ids come last, equal ids are ordered by the hash of the text, then the text;
a single document is its own successor; repeated rows follow one another; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN, LEAST, STRETCH, AHEAD = 32, 24, 4, 4
PART, BASE_WIDTH, FIRST_WIDTH, ATTEMPTS = 2, 4, 4, 7
ROWS_A_BUCKET, MAX_BUCKETS, SAMPLE_A_BUCKET = 5000, 20_000, 20
_ROWS = 3
_DIGESTS, _FOUND = "array<bigint>", "array<struct<n:int,key:bigint>>"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _shift(direction: str, value: Column, bits) -> Column:
    return F.call_function(f"shift{direction}", value, F.lit(bits) if isinstance(bits, int) else bits)


def checked(digest: Column) -> Column:
    """The high 40 bits of a hash, with a check of them in the low 24: an xor of several digests does not pass for one."""
    high = lambda d: _shift("left", _shift("rightunsigned", d, 24), 24)
    return high(digest).bitwiseOR(F.xxhash64(high(digest)).bitwiseAND(0xFFFFFF))


def units(text: Column) -> Column:
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    cut = lambda ws: F.flatten(F.transform(ws, lambda w: F.when(F.char_length(w) <= RUN, F.array(w)).otherwise(F.split(w, ""))))
    # most texts have no run to cut: their words are the units as they are
    return let(words, lambda ws: F.when(F.exists(ws, lambda w: F.char_length(w) > RUN), cut(ws)).otherwise(ws))


def _groups(u: Column, ends: Column, size: Column) -> Column:
    """Digests of the stretches of units between consecutive ends, each of at most STRETCH * size units."""
    starts = F.flatten(F.transform(ends, lambda end, k: F.sequence(F.when(k > 0, F.get(ends, k - 1)).otherwise(0), end - 1, size * STRETCH)))
    return let(starts, lambda s: F.transform(s, lambda start, k: F.xxhash64(
        F.slice(u, start + 1, F.coalesce(F.get(s, k + 1), F.size(u)) - start))))


def _two_levels(u: Column, size: Column) -> Column:
    """Digests of the stretches that end at hashes divisible by ``size`` (a power of two), and by twice that."""
    hashed = F.transform(u, lambda w, i: F.xxhash64(w, *[F.get(u, i + k) for k in range(1, AHEAD)]))
    last = F.size(u)
    ends = lambda h, n: F.filter(F.sequence(F.lit(1), last), lambda i: (i == last) | (F.get(h, i - 1).bitwiseAND(n - 1) == 0))
    return let(hashed, lambda h: let(ends(h, size), lambda fine: F.concat(
        _groups(u, fine, size), _groups(u, F.filter(fine, lambda i: (i == last) | (F.get(h, i - 1).bitwiseAND(size * 2 - 1) == 0)), size * 2))))


def _characters(text: Column) -> Column:
    pairs = lambda c: F.transform(c, lambda x, i: F.xxhash64(F.when(i > 0, F.get(c, i - 1)).otherwise(F.lit("\x02")), x))
    return F.when(F.char_length(text) > 0, let(F.split(text, ""), pairs)).otherwise(F.array().cast(_DIGESTS))


def paragraphs(text: Column) -> Column:
    """Sorted distinct paragraph digests (array<long>)."""
    none = F.array().cast(_DIGESTS)
    # the highest power of two in the number of units over LEAST
    size = lambda u: _shift("left", F.lit(1), F.length(F.bin((F.size(u) / LEAST).cast("long"))) - 1)
    found = let(units(text), lambda u: F.when(F.size(u) >= LEAST, let(size(u), lambda n: _two_levels(u, n))).otherwise(F.concat(
        _characters(text), F.when(F.size(u) > 0, F.transform(u, lambda w: F.xxhash64(F.array(w)))).otherwise(none))))
    return F.array_sort(F.array_distinct(F.transform(found, checked)))


def _here(digest: Column, row, width: Column, place: Column) -> Column:
    """Whether a digest goes to a cell of a row: 8 bits of the digest choose the place."""
    return _shift("right", digest, row).bitwiseAND(width - 1) == place


def _cell(n: Column, key: Column) -> Column:
    return F.struct(n.alias("n"), key.alias("key"))


def sketch(digests: Column, width: Column) -> Column:
    """Cells (n, key) of all rows, one row after the other; ``width`` is a power of two."""

    def row(r):
        added = lambda p: lambda x, d: F.when(_here(d, 8 * r, width, p), _cell(x["n"] + 1, x["key"].bitwiseXOR(d))).otherwise(x)
        return F.transform(F.sequence(F.lit(0), width - 1), lambda p: F.aggregate(digests, _cell(F.lit(0), F.lit(0).cast("long")), added(p)))

    return F.concat(*[row(r) for r in range(_ROWS)])


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _cell(x["n"] - y["n"], x["key"].bitwiseXOR(y["key"])))


def _pure(cells: Column) -> Column:
    """The digests that stand alone in some cell, with their sign."""
    return F.array_distinct(F.filter(cells, lambda c: (F.abs(c["n"]) == 1) & (checked(c["key"]) == c["key"])))


def _without(cells: Column, found: Column, width: Column) -> Column:
    """The cells without the digests found."""

    def left(c, i):
        here = F.filter(found, lambda f: _here(f["key"], (i / width).cast("int") * 8, width, i % width))
        return let(here, lambda own: F.when(F.size(own) == 0, c).otherwise(F.aggregate(own, c, _take)))

    return F.transform(cells, left)


def _take(c: Column, e: Column) -> Column:
    return _cell(c["n"] - e["n"], c["key"].bitwiseXOR(e["key"]))


def peel(cells: Column, width: Column, rounds: int = 6) -> Column:
    """The differing digests of a subtracted sketch as (n, key), n telling the side; null if
    peeling stops before the sketch is empty or takes more rounds. Every digest is in the first row, so that row's totals tell whether a round found the rest."""
    start = F.struct(cells.alias("cells"), F.array().cast(_FOUND).alias("found"), F.lit(True).alias("going"), F.lit(False).alias("done"))
    total = lambda c: F.aggregate(F.slice(c, F.lit(1), width), _cell(F.lit(0), F.lit(0).cast("long")), lambda x, e: _cell(x["n"] + e["n"], x["key"].bitwiseXOR(e["key"])))

    def round_of(state, pure):
        rest = F.aggregate(pure, total(state["cells"]), _take)
        return let(rest, lambda r: let((r["n"] == 0) & (r["key"] == 0), lambda done: F.struct(
            F.when(done | (F.size(pure) == 0), state["cells"]).otherwise(_without(state["cells"], pure, width)).alias("cells"),
            F.concat(state["found"], pure).alias("found"), (~done & (F.size(pure) > 0)).alias("going"), done.alias("done"),
        )))

    step = lambda state, _: F.when(~state["going"], state).otherwise(let(_pure(state["cells"]), lambda pure: round_of(state, pure)))
    return let(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step), lambda end: F.when(end["done"], end["found"]))


def part_difference(a: Column, b: Column) -> Column:
    """Number of differing digests of two small arrays: peeled from sketches, each attempt with twice the
    cells and digests hashed anew; the exact comparison only if every attempt fails."""
    anew = lambda digests, t: F.when(t == 0, digests).otherwise(F.transform(digests, lambda d: checked(F.xxhash64(d, t))))

    def attempt(width, t):
        return let(width, lambda w: F.size(peel(subtract(sketch(anew(a, t), w), sketch(anew(b, t), w)), w)))

    found = F.aggregate(
        F.sequence(F.lit(0), F.lit(ATTEMPTS - 1)), F.lit(-1),
        lambda found, t: F.when(found >= 0, found).otherwise(attempt(_shift("left", F.lit(FIRST_WIDTH), t), t)),
    )
    return let(found, lambda f: F.when(f >= 0, f).otherwise(F.size(F.array_except(a, b)) + F.size(F.array_except(b, a))))


def difference(a: Column, b: Column) -> Column:
    """Number of differing digests of two sorted arrays, part by part: a part is a slice of each, since the high bits choose it."""
    bits = F.length(F.bin(((F.size(a) + F.size(b)) / PART).cast("long")))
    part = lambda digests, n: F.transform(digests, lambda d: _shift("rightunsigned", d, F.lit(64) - n))

    def cut(digests, of, p):
        many = F.size(of) - F.size(F.array_remove(of, p))
        return F.when(many > 0, F.slice(digests, F.array_position(of, p).cast("int"), many)).otherwise(F.array().cast(_DIGESTS))

    def over_parts(n, of_a, of_b):
        # a part that only one text has differs as a whole
        alone = F.size(F.filter(of_a, lambda p: ~F.array_contains(of_b, p))) + F.size(F.filter(of_b, lambda p: ~F.array_contains(of_a, p)))
        return F.aggregate(F.array_intersect(of_a, of_b), alone, lambda total, p: total + let(
            cut(a, of_a, p), lambda x: let(cut(b, of_b, p), lambda y: part_difference(x, y))))

    return let(bits, lambda n: let(part(a, n), lambda of_a: let(part(b, n), lambda of_b: over_parts(n, of_a, of_b))))


def likeness(a: Column, a_base: Column, b: Column, b_base: Column) -> Column:
    """Shared over all distinct paragraphs of two texts, from the difference of their fingerprints, or of larger sketches."""
    first = F.size(peel(subtract(a_base, b_base), F.lit(BASE_WIDTH)))
    found = let(first, lambda d: F.when(d >= 0, d).otherwise(difference(a, b)))
    return let(found, lambda d: let((F.size(a) + F.size(b) + d) / 2, lambda union: F.when(union == 0, F.lit(1.0)).otherwise((union - d) / union)))


def as_text(digests: Column, base: Column) -> Column:
    """A fingerprint as text: number of paragraphs, then the cells' counts and digests."""
    cell = lambda c: F.concat(F.hex(c["n"]), F.lit("."), F.hex(c["key"]))
    return F.lower(F.concat(F.hex(F.size(digests)), F.lit(":"), F.array_join(F.transform(base, cell), " ")))


_KEY = ["late", "down", "hash"]


def _ordered(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, body, late, down, hash): ascending (late, down, hash) is descending id, null ids last, then the text's hash."""
    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("id"), F.coalesce(docs[f"`{text}`"], F.lit("")).alias("body"))
    return rows.select("id", "body", F.col("id").isNull().cast("int").alias("late"), F.coalesce(F.bitwise_not("id"), F.lit(0).cast("long")).alias("down"), F.xxhash64("body").alias("hash"))


def _bucketed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``bucket``: the number of bounds that are not above the key. The bounds are quantiles of a sample of
    ``SAMPLE_A_BUCKET`` keys a bucket, at most ``MAX_BUCKETS`` of them."""
    keys = rows.select(*_KEY)
    n = keys.count()
    buckets = max(1, min(MAX_BUCKETS, -(-n // ROWS_A_BUCKET)))
    if buckets == 1:
        return rows.withColumn("bucket", F.lit(0))
    share = min(1.0, SAMPLE_A_BUCKET * buckets / n)
    sample = sorted(tuple(r) for r in keys.where(F.pmod(F.xxhash64(*_KEY), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)).distinct().collect())
    bounds = sorted({sample[i * len(sample) // buckets] for i in range(1, buckets)} if sample else set())
    literal = json.dumps([dict(zip(_KEY, b)) for b in bounds])
    table = F.from_json(F.lit(literal), "array<struct<late:int,down:bigint,hash:bigint>>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, len(bounds).bit_length())))])
    key = F.struct(*_KEY)
    reached = lambda at, step: F.coalesce(F.get(table, at + step - 1) <= key, F.lit(False))
    return rows.withColumn("bucket", F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(reached(at, step), step).otherwise(0)))


def with_successor(docs: DataFrame, id_col: str = "doc_id", text: str = "text", derived=lambda body: {}) -> DataFrame:
    """(id, body, next_body, ...): each text (null: empty) with that of the next document in descending id order; the first
    follows the last. ``derived`` (columns of a text) are computed once per row and come as ``name`` and ``next_name``."""
    placed = _bucketed(_ordered(docs, id_col, text))
    # at most MAX_BUCKETS rows
    firsts = placed.groupBy("bucket").agg(F.min(F.struct(*_KEY)).alias("first"))
    order = Window.orderBy("bucket")
    before = F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy()))
    stands = firsts.select(F.col("bucket").alias("of"), *[F.col(f"first.{k}").alias(f"first_{k}") for k in _KEY], before.alias("to"))
    at_first = placed["bucket"] == stands["of"]
    for k in _KEY:
        at_first = at_first & (placed[k] == stands[f"first_{k}"])
    # rows equal in id and hash hold the same text: one of each bucket is enough
    ghosts = placed.join(F.broadcast(stands), at_first).groupBy("to", *_KEY).agg(F.min("body").alias("body"))
    names = list(derived(F.col("body")))
    more = [c.alias(n) for n, c in derived(F.col("body")).items()]
    own = placed.select("id", "body", *_KEY, "bucket", F.lit(0).alias("ghost"), *more)
    lent = ghosts.select(F.lit(None).cast("long").alias("id"), "body", *_KEY, F.col("to").alias("bucket"), F.lit(1).alias("ghost"), *more)
    w = Window.partitionBy("bucket").orderBy("ghost", *_KEY, "body")
    led = own.unionByName(lent).select("id", "ghost", "body", *names, *[F.lead(c).over(w).alias(f"next_{c}") for c in ("body", *names)])
    return led.where("ghost = 0").drop("ghost")


def compare_versions(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next): one row per input
    row. The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next."""
    # a text's digests with its fingerprint; a row's own are also its predecessor's next ones
    sketched = lambda body: let(paragraphs(body), lambda d: F.struct(d.alias("digests"), sketch(d, F.lit(BASE_WIDTH)).alias("base")))
    rows = with_successor(docs, id_col, text, lambda body: {"own": sketched(body)}).withColumn("n_chars", F.char_length("body").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("body"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("next_body"), F.lit(1), half))
    rows = rows.select("id", "n_chars", edited.alias("edited"), "own", "next_own").withColumn("new", sketched(F.col("edited")))
    rows = rows.select("id", "n_chars", "edited", F.array("own", "new", "next_own").alias("v"))
    one = lambda v, k: likeness(F.get(v, 0)["digests"], F.get(v, 0)["base"], F.get(v, k)["digests"], F.get(v, k)["base"])
    print_of = lambda v, k: as_text(F.get(v, k)["digests"], F.get(v, k)["base"])
    found = let(F.col("v"), lambda v: F.struct(
        print_of(v, 0).alias("fingerprint"), print_of(v, 1).alias("edited_fingerprint"),
        F.transform(F.array(F.lit(1), F.lit(2)), lambda k: one(v, k)).alias("near"),
    ))
    rows = rows.select("id", "n_chars", "edited", found.alias("f"))
    return rows.select("id", "n_chars", "edited", "f.fingerprint", "f.edited_fingerprint", F.col("f.near")[0].alias("near_edited"), F.col("f.near")[1].alias("near_next"))
