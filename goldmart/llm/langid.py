"""Language identification with interpolated Kneser-Ney character models.

One model per language over the letters of words (with word begin and end), orders 1 to ``order``.
The n-grams of all languages lie in one sorted array of 64-bit hashes per order, with a column of log
probabilities for each language; a second sorted array holds the back-off weights of the contexts.
A language without an n-gram has its interpolated probability there, so one search serves all.

A text gets the language of the lowest cross-entropy per letter. ``score`` is the softmax of the negative
cross-entropies at a sharpness fitted on held-back sample documents, and ``rejected`` tells a
text that is worse than nine in ten of those documents of its language by more than a margin that widens for short texts, so that
a few mislabelled documents do not loosen it.

Learning uses at most ``per_language`` documents of each language (the distinct ids with the smallest hash; of an id with
several texts the one with the smallest hash), a documented bound; of these it takes whole texts and every word. Words, n-grams and the
Kneser-Ney counts are aggregates of Spark; only the counts of each order's distinct n-grams come to the driver, one order at a time.
Prediction reads whole texts, batch by batch, and scores each distinct word of a task once.

A word is what is left of a white-space separated piece in lower case without anything but letters and the marks that follow them, in learning
and in prediction alike.

Cases: null texts and texts without a letter (numerals are none) are ``und`` with score 0 and rejected; rows with a null language or a null
id are not learned; with nothing learned every text is ``und``; ties go to the first language by name;
repeated rows are predicted one by one; columns named like an output are replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldmart.llm.chargrams import TokenCache, find, hashes, scored_texts, spell
from goldmart.llm.common import appended, ship, slices
from goldmart.session import materialize

PER_LANGUAGE, ORDER = 800, 4
# A language's limit is this quantile of its held-back entropies and a margin: mislabelled documents up to the rest do not move it.
LIMIT_QUANTILE, LIMIT_MARGIN = 0.9, 1.25
_NO_LETTER = regex.compile(r"[^\p{L}\p{M}]+|(?<![\p{L}\p{M}])\p{M}+")
_OUT = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]


@dataclass
class Model:
    """grams, logp: per order, sorted hashes and (n-gram, language) log probabilities; contexts, logbow:
    sorted context hashes and log back-off weights; floor: log probability of an unseen character."""

    langs: list
    order: int
    grams: list
    logp: list
    contexts: list
    logbow: list
    floor: object
    sharpness: float = 20.0
    limits: object = None


def _per_group(index, size, values):
    import numpy as np

    return np.stack([np.bincount(index, weights=column, minlength=size) for column in values.T], axis=1)


def letters(piece: str) -> str:
    """The letters of a piece with their marks."""
    return _NO_LETTER.sub("", piece)


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of rows (lang, text): the words that prediction would see."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 1)):
            counts = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update((lang, piece) for piece in (text or "").lower().split())
            found = [(lang, letters(piece), n) for (lang, piece), n in counts.items()]
            found = [f for f in found if f[1]]
            columns = list(zip(*found)) if found else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])

    return rows.select("lang", "text").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame, order: int = ORDER) -> DataFrame:
    """(size, gram, lang, n): the Kneser-Ney count of every n-gram of up to ``order`` characters of (lang, word, n). The longest, and those at a
    word's begin, count how often they occur; the others in how many longer n-grams they end."""
    marked = words.select("lang", "n", F.concat(F.lit("\x02"), "word", F.lit("\x03")).alias("w"))
    ends = F.sequence(F.lit(1), F.lit(order))
    places = F.flatten(F.transform(ends, lambda size: F.transform(
        F.sequence(F.greatest(size, F.lit(2)), F.char_length("w")), lambda end: F.struct(size.alias("size"), F.substring(F.col("w"), end - size + 1, size).alias("gram")))))
    # a word's marks make it three characters at least; longer n-grams than that have no place in the shortest
    fits = F.filter(places, lambda p: F.char_length(p["gram"]) == p["size"])
    seen = marked.select("lang", "n", F.explode(fits).alias("p")).groupBy("p.size", "p.gram", "lang").agg(F.sum("n").alias("n"))
    seen = materialize(seen, "langid-grams")
    at_begin = F.substring("gram", 1, 1) == "\x02"
    kinds = seen.where("size > 1").select((F.col("size") - 1).alias("size"), F.expr("substring(gram, 2)").alias("gram"), "lang").groupBy("size", "gram", "lang").agg(F.count(F.lit(1)).alias("n"))
    return seen.where((F.col("size") == order) | at_begin).unionByName(kinds.where(~at_begin))


def fit(counts, langs: list[str], alphabet: int, order: int = ORDER) -> Model:
    """Kneser-Ney models from ``counts``: a function that gives (n-grams, language numbers, counts) of a size."""
    import numpy as np

    width = len(langs)
    grams, logp, contexts, logbow, lower = [], [], [], [], None
    floor = np.zeros(width)
    for n in range(1, order + 1):
        texts, lang, number = counts(n)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        del texts
        keys, first, at = np.unique(hashes(codes, n)[n - 1::n], return_index=True, return_inverse=True)
        count = np.zeros((len(keys), width))
        np.add.at(count, (at, lang), number)
        # of each n-gram, all but its last character and all but its first
        context = hashes(codes, n - 1)[n - 2::n][first] if n > 1 else np.zeros(len(keys), np.uint64)
        suffix = hashes(codes, n - 1)[n - 1::n][first] if n > 1 else None
        del codes, at
        context_keys, of = np.unique(context, return_inverse=True)
        total, kinds_after = _per_group(of, len(context_keys), count), _per_group(of, len(context_keys), (count > 0).astype(float))
        ones, twos = (count == 1).sum(axis=0), (count == 2).sum(axis=0)
        discount = np.where(ones > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5)
        rest = np.where(total > 0, discount * kinds_after / np.maximum(total, 1e-300), 1.0)
        rest = np.maximum(rest, 1e-9)
        below = lower[1][find(lower[0], suffix)] if n > 1 else np.full((len(keys), width), 1.0 / alphabet)
        p = np.where(total[of] > 0, np.maximum(count - discount, 0) / np.maximum(total[of], 1e-300), 0.0) + rest[of] * below
        if n == 1:
            floor = np.log(rest[0] / alphabet) if len(rest) else floor
        grams.append(keys)
        logp.append(np.log(p).astype(np.float32))
        contexts.append(context_keys)
        logbow.append(np.log(rest).astype(np.float32))
        lower = (keys, p)
    return Model(list(langs), order, grams, logp, contexts, logbow, floor)


def word_scores(model: Model, tokens):
    """(token, language) sums of log probabilities and, in the last column, the number of characters scored:
    the letters and the word's end; 0 for a token without letters."""
    import numpy as np

    words = [letters(t) for t in tokens]
    codes, owner, pos = spell(words)
    width = len(model.langs)
    out = np.zeros((len(codes), width))
    open_at = np.flatnonzero(pos >= 1)
    hashed = {n: hashes(codes, n) for n in range(1, model.order + 1)}
    for n in range(model.order, 0, -1):
        fits = pos[open_at] >= n - 1
        tried = open_at[fits]
        at = find(model.grams[n - 1], hashed[n][tried])
        hit = at >= 0
        out[tried[hit]] += model.logp[n - 1][at[hit]]
        missed = tried[~hit]
        if n > 1:
            back = find(model.contexts[n - 1], hashed[n - 1][missed - 1])
            out[missed[back >= 0]] += model.logbow[n - 1][back[back >= 0]]
        else:
            out[missed] += model.floor
        open_at = np.concatenate([open_at[~fits], missed])
    sizes = np.fromiter(map(len, words), np.float64, len(words))
    scores = np.stack([np.bincount(owner, weights=out[:, k], minlength=len(words)) for k in range(width)] + [sizes + 1], axis=1)
    scores[sizes == 0] = 0
    return scores


def entropies(numbers, rows):
    """(cross-entropy per character for each language, characters), or None without a letter."""
    if not len(numbers):
        return None
    total = rows[numbers].sum(axis=0)
    return (-total[:-1] / total[-1], total[-1]) if total[-1] else None


def _score(model: Model, texts, cache):
    import numpy as np

    langs, preds, scores, rejected = model.langs, [], [], []
    for found in scored_texts(texts, cache, entropies) if langs else (None for _ in texts):
        if found is None:
            preds.append("und"), scores.append(0.0), rejected.append(True)
            continue
        xe, size = found
        best = int(np.argmin(xe))
        preds.append(langs[best])
        scores.append(float(1.0 / np.exp(-model.sharpness * (xe - xe[best])).sum()))
        rejected.append(bool(xe[best] > model.limits[best] + 4.0 / np.sqrt(size)))
    return preds, scores, rejected


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``rejected`` to every row."""
    kept, schema = appended(df, _OUT)
    at = df.columns.index(text)

    def run(batches):
        cache = TokenCache(lambda tokens: word_scores(model, tokens))
        for batch in batches:
            preds, scores, rejected = _score(model, (v.as_py() for v in batch.column(at)), cache)
            arrays = [pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in kept] + arrays, names=schema.names)

    return df.mapInArrow(run, schema)


def learn(
    docs: DataFrame, usable: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = PER_LANGUAGE, order: int = ORDER,
) -> Model:
    """Fit and calibrate on the documents where ``usable`` holds; see the module text for the bounds."""
    import numpy as np

    key = F.xxhash64(F.col("id"), F.lit("langid"))
    rows = docs.where(usable).select(docs[f"`{id_col}`"].alias("id"), docs[f"`{lang}`"].alias("lang"), docs[f"`{text}`"].alias("text"))
    rows = rows.where("lang is not null and id is not null")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(key, "id"))
    ids = rows.select("id", "lang").distinct()
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))  # a row for each language
    part = F.pmod(key, F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = ids.join(F.broadcast(sizes), "lang").where(part * F.col("n") < 4 * per_language)
    chosen = drawn.select("id", "lang").withColumn("nth", nth).where(F.col("nth") <= per_language)
    sample = rows.join(F.broadcast(chosen), ["id", "lang"]).groupBy("lang", "nth").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    sample = materialize(sample, "langid-sample")
    held = (F.col("nth") % 5) == 0

    grams = materialize(gram_counts(word_counts(sample.where(~held | (F.col("nth") < 5))), order), "langid-counts")
    langs = sorted(r["lang"] for r in grams.select("lang").distinct().collect())
    if not langs:
        return Model([], order, [], [], [], [], np.zeros(0), limits=np.zeros(0))
    place = {name: i for i, name in enumerate(langs)}

    def counts(n):
        found = grams.where(F.col("size") == n).select("gram", "lang", "n").orderBy("gram", "lang").toArrow()
        of = found.column("lang").combine_chunks().dictionary_encode()
        return found.column("gram").to_pylist(), np.array([place[name] for name in of.dictionary.to_pylist()])[of.indices.to_numpy()], found.column("n").to_numpy()

    # the characters, the begin mark and one for all unseen
    alphabet = grams.where("size = 1").select("gram").distinct().count() + 2
    model = fit(counts, langs, alphabet, order)
    model.limits = np.full(len(langs), np.log(len(model.grams[0]) + 1.0))  # without held-back documents: no better than chance
    _calibrate(model, sample.where(held).select("lang", "text"))
    return model


def _calibrate(model: Model, held: DataFrame) -> None:
    """Set the sharpness (greatest likelihood on a grid) and each language's limit: a high quantile of the
    cross-entropies of its held-back documents of 20 characters or more, plus a quarter; for a language without one, the median
    of the others' limits."""
    import numpy as np

    def run(batches):
        cache = TokenCache(lambda tokens: word_scores(model, tokens))
        for batch in batches:
            found = scored_texts((v.as_py() for v in batch.column(1)), cache, entropies)
            good = [i for i, f in enumerate(found) if f is not None]
            yield pa.RecordBatch.from_arrays([
                pa.array([batch.column(0)[i].as_py() for i in good], pa.string()),
                pa.array([found[i][0].tolist() for i in good], pa.list_(pa.float64())), pa.array([float(found[i][1]) for i in good], pa.float64()),
            ], names=["lang", "xe", "size"])

    rows = [r for r in held.mapInArrow(run, "lang string, xe array<double>, size double").collect() if r["lang"] in model.langs]
    if not rows:
        return
    xe, right = np.array([r["xe"] for r in rows]), np.array([model.langs.index(r["lang"]) for r in rows])

    def likelihood(s):
        z = -s * (xe - xe.min(axis=1, keepdims=True))
        return (z[np.arange(len(z)), right] - np.log(np.exp(z).sum(axis=1))).sum()

    model.sharpness = max([1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0], key=likelihood)
    size = np.array([r["size"] for r in rows])
    for k in range(len(model.langs)):
        own = xe[(right == k) & (size >= 20), k]
        if len(own):
            model.limits[k] = np.quantile(own, LIMIT_QUANTILE) * LIMIT_MARGIN
    known = np.isin(np.arange(len(model.langs)), right[size >= 20])
    if known.any():
        model.limits[~known] = np.median(model.limits[known])


ship(__name__)
