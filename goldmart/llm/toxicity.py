"""Toxicity scores from averaged subword embeddings and a linear softmax.

A word is the mean of its character n-gram vectors (3 to 5 characters with word begin and end,
and the word itself), so a misspelling that was never seen shares vectors with the words it resembles. A
window of ``WINDOW`` words is the mean of its word vectors (short windows are filled up to ``LEAST`` words with
zeros) and goes through a linear softmax; vectors and softmax are trained jointly. Windows overlap by half, in training and in scoring. A text's score is that of its
most toxic window, put on a probability scale by a logistic fit on held-back sample documents: one insult weighs
the same in a long text as in a short one.

Training needs window labels but has document labels: all windows of a toxic document start as
toxic; after the warm-up only its most toxic window stays so. It uses at most ``max_toxic`` and
``max_clean`` labelled documents (the distinct ids with the smallest hash; of an id with several texts the one with the smallest hash), a documented
bound on the driver's work, and all windows of these. Scoring reads whole texts, batch by batch;
since mean and softmax are linear, a task scores each distinct word once.

Cases: null and empty texts get the score of no evidence; null labels and ids are not learned;
repeated labels of a document count as toxic if one is; without both classes in the sample every score
is 0; repeated rows are scored one by one; columns named like an output are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldmart.llm.chargrams import TokenCache, find, hashes, scored_texts, spell
from goldmart.llm.common import appended, ship, slices

WINDOW, STEP, LEAST = 16, 8, 16
MAX_TOXIC, MAX_CLEAN, DIM = 800, 1600, 8
ORDERS = (3, 4, 5)
THRESHOLD = 0.7
_MARKS = re.compile(r"[\W_]+")


@dataclass
class Model:
    """Sorted n-gram hashes, the difference of the two classes' logits that each n-gram's vector gives, the bias
    of that difference, and slope and offset of the logistic scale."""

    grams: object
    weights: object
    bias: float
    slope: float = 1.0
    offset: float = 0.0


def _word_grams(words):
    """(hash, word): one row for each n-gram of each word, the whole word being one."""
    import numpy as np

    codes, owner, pos = spell(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    some = sizes > 2
    found, of = [], []
    for n in ORDERS:
        ends = (pos >= n - 1) & some[owner]
        found.append(hashes(codes, n)[ends])
        of.append(owner[ends])
    ranked = codes * (pos.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1))
    whole = np.add.reduceat(ranked, np.flatnonzero(pos == 0)) if len(words) else np.zeros(0, np.uint64)
    found.append((whole * np.uint64(0xD6E8FEB86659FD93))[some])
    of.append(np.flatnonzero(some))
    return np.concatenate(found), np.concatenate(of)


def word_logits(model: Model, tokens):
    """(token, 2): the logit difference of the token's mean vector, and 1 for a token with letters or
    digits (0: it is not a word)."""
    import numpy as np

    words = [_MARKS.sub("", t) for t in tokens]
    grams, of = _word_grams(words)
    at = find(model.grams, grams)
    given = np.where(at >= 0, model.weights[at], 0.0) if len(model.grams) else np.zeros(len(at))
    sums, counts = np.bincount(of, weights=given, minlength=len(words)), np.bincount(of, minlength=len(words))
    return np.stack([sums / np.maximum(counts, 1), (counts > 0).astype(float)], axis=1)


def top_window(numbers, rows, bias: float) -> float:
    """The largest window logit of a text."""
    import numpy as np

    if not len(numbers):
        return bias
    tops = []
    for start in range(0, min(WINDOW, len(numbers)), STEP):
        span = np.arange(len(numbers) - start) // WINDOW
        once = np.unique(span * len(rows) + numbers[start:])
        sums = np.add.reduceat(rows[once % len(rows)], np.searchsorted(once, np.arange(span[-1] + 1) * len(rows)), axis=0)
        tops.append((sums[:, 0] / np.maximum(sums[:, 1], LEAST)).max())
    return float(max(tops) + bias)


def scores(model: Model | None, texts, cache):
    import numpy as np

    tops = np.array(scored_texts(texts, cache, lambda n, r: top_window(n, r, model.bias)))
    return 1.0 / (1.0 + np.exp(-np.clip(model.slope * tops + model.offset, -40, 40)))


def score_texts(df: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 if score >= threshold) to every row."""
    kept, schema = appended(df, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    at = df.columns.index(text)

    def run(batches):
        import numpy as np

        cache = TokenCache(lambda tokens: word_logits(model, tokens))
        for batch in batches:
            found = np.zeros(batch.num_rows) if model is None or not batch.num_rows else scores(model, (v.as_py() for v in batch.column(at)), cache)
            arrays = [pa.array(found), pa.array((found >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in kept] + arrays, names=schema.names)

    return df.mapInArrow(run, schema)


def _windows(rows: DataFrame) -> DataFrame:
    """(doc, toxic, words): all windows of each text."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 2)):
            docs, labels, out = [], [], []
            for doc, label, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = (text or "").lower().split()
                for s in range(0, max(len(words), 1), STEP):
                    docs.append(doc), labels.append(label), out.append(" ".join(words[s:s + WINDOW]))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(labels, pa.int32()), pa.array(out, pa.string())], names=["doc", "toxic", "words"])

    return rows.mapInArrow(run, "doc long, toxic int, words string")


def _words_by_doc(split, doc):
    """The distinct words of each document, as an array of word numbers."""
    import numpy as np

    found = {}
    for words, d in zip(split, doc):
        found.setdefault(d, set()).update(words)
    return (np.fromiter(words, np.int64, len(words)) for words in found.values())


def _spans(first, words):
    """Places first[w] to first[w + 1] of each word, one after the other."""
    import numpy as np

    sizes = first[words + 1] - first[words]
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(first[words], sizes)


class _Trainer:
    """Joint training of n-gram vectors and softmax with Adagrad, in numpy."""

    def __init__(self, windows: list[str], doc, dim: int, min_docs: int, decay: float, start: float = 1e-12, seed: int = 7):
        import numpy as np

        self.rng = np.random.default_rng(seed)
        index = {}
        split = [[index.setdefault(w, len(index)) for w in x.split()] for x in windows]
        words = [_MARKS.sub("", w) for w in index]
        grams, of = _word_grams(words)
        per_word = np.bincount(of, minlength=len(words))
        first = np.concatenate([[0], np.cumsum(per_word)])
        grams = grams[np.argsort(of, kind="stable")]
        del of
        keys = np.unique(grams)
        by_word = np.empty(len(grams), np.int32)
        for at in range(0, len(grams), 1 << 20):
            by_word[at:at + (1 << 20)] = np.searchsorted(keys, grams[at:at + (1 << 20)])
        del grams
        seen = np.zeros(len(keys), np.int32)
        for own in _words_by_doc(split, doc):
            seen[np.unique(by_word[_spans(first, own)])] += 1
        use = seen >= min_docs  # n-grams of a few documents would be learned by heart
        rank = np.cumsum(use) - 1
        self.grams, self.decay = keys[use], decay
        kept = use[by_word]
        self.flat = rank[by_word[kept]].astype(np.int32)
        self.first = np.concatenate([[0], np.cumsum(kept)])[first]
        self.per_word, self.is_word = np.maximum(per_word, 1), per_word > 0
        self.ids = [np.array(sorted({i for i in s if self.is_word[i]}), np.int32) for s in split]
        self.vectors = self.rng.uniform(-1, 1, (len(self.grams), dim)) / dim
        self.soft, self.bias = self.rng.normal(0, 0.1, (dim, 2)), np.zeros(2)
        self.g_vectors, self.g_soft, self.g_bias = np.full(len(self.grams), start), np.full((dim, 2), start), np.full(2, start)

    def logits(self):
        """The logit difference of every window."""
        import numpy as np

        weights = self.vectors @ (self.soft[:, 1] - self.soft[:, 0])
        sums = np.bincount(np.repeat(np.arange(len(self.per_word)), np.diff(self.first)), weights=weights[self.flat], minlength=len(self.per_word))
        word = sums / self.per_word
        bias = self.bias[1] - self.bias[0]
        return np.array([word[i].sum() / max(len(i), LEAST) + bias for i in self.ids])

    def epoch(self, chosen, labels, weight, rate: float, batch: int = 256):
        import numpy as np

        order = self.rng.permutation(len(chosen))
        for start in range(0, len(order), batch):
            part = order[start:start + batch]
            self._step([self.ids[i] for i in chosen[part]], labels[part], weight[part], rate)

    def _step(self, ids, labels, weight, rate):
        import numpy as np

        sizes = np.array([len(i) for i in ids])
        flat = np.concatenate(ids) if sizes.sum() else np.zeros(0, np.int64)
        window = np.repeat(np.arange(len(ids)), sizes)
        share = (1.0 / np.maximum(sizes, LEAST))[window]
        words, inverse = np.unique(flat, return_inverse=True)
        gram_word = np.repeat(np.arange(len(words)), self.first[words + 1] - self.first[words])
        gram = self.flat[_spans(self.first, words)]
        scale = 1.0 / self.per_word[words]
        dim = self.vectors.shape[1]
        taken = self.vectors[gram]
        word_vec = np.stack([np.bincount(gram_word, weights=taken[:, k], minlength=len(words)) for k in range(dim)], axis=1) * scale[:, None]
        bags = np.stack([np.bincount(window, weights=word_vec[inverse, k] * share, minlength=len(ids)) for k in range(dim)], axis=1)
        z = bags @ self.soft + self.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(ids)), labels] -= 1
        d = p * weight[:, None] / weight.sum()
        back = d @ self.soft.T
        for value, grad, state in ((self.soft, bags.T @ d, self.g_soft), (self.bias, d.sum(axis=0), self.g_bias)):
            state += grad * grad
            value -= rate * grad / np.sqrt(state)
        to_word = np.stack([np.bincount(inverse, weights=back[window, k] * share, minlength=len(words)) for k in range(dim)], axis=1) * scale[:, None]
        grams, at = np.unique(gram, return_inverse=True)
        grad = np.stack([np.bincount(at, weights=to_word[gram_word, k], minlength=len(grams)) for k in range(dim)], axis=1)
        grad += self.decay * self.vectors[grams]
        self.g_vectors[grams] += (grad * grad).mean(axis=1)
        self.vectors[grams] -= rate * grad / np.sqrt(self.g_vectors[grams])[:, None]


def train(docs, toxic, windows, dim: int = DIM, epochs: int = 5, warm_up: int = 2, rate: float = 0.4, min_docs: int = 5, decay: float = 1e-6) -> Model | None:
    """Fit on windows (text) of documents (id) with document labels; every fifth document only sets the scale."""
    import numpy as np

    docs, toxic = np.asarray(docs, np.int64), np.asarray(toxic, np.int64)
    if not len(docs) or toxic.min() == toxic.max():
        return None
    _, doc = np.unique(docs, return_inverse=True)
    held = doc % 5 == 4
    if len(np.unique(toxic[held])) < 2:
        held[:] = False
    own = np.flatnonzero(~held)
    t = _Trainer(windows, doc, dim, min_docs, decay)

    def tops(logits):
        top = np.full(doc.max() + 1, -np.inf)
        np.maximum.at(top, doc, logits)
        return top

    for e in range(epochs):
        chosen = own
        if e >= warm_up:
            logits = t.logits()
            best = logits >= tops(logits)[doc] - 1e-12
            chosen = own[(toxic[own] == 0) | best[own]]
        labels = toxic[chosen]
        balance = np.where(labels == 1, 0.5 * len(labels) / max(labels.sum(), 1), 1.0)
        t.epoch(chosen, labels, np.minimum(balance, 20.0), rate)
    logits = t.logits()
    scale = held if held.any() else np.ones(len(doc), bool)
    label = np.zeros(doc.max() + 1, np.int64)
    label[doc] = toxic
    used = np.unique(doc[scale])
    slope, offset = _logistic(tops(logits)[used], label[used])
    return Model(t.grams, t.vectors @ (t.soft[:, 1] - t.soft[:, 0]), float(t.bias[1] - t.bias[0]), slope, offset)


def _logistic(x, label):
    """Slope and offset of a logistic fit with smoothed targets (Newton steps)."""
    import numpy as np

    positive = max(int(label.sum()), 1)
    negative = max(len(label) - positive, 1)
    target = np.where(label == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    weight = np.where(label == 1, 0.5 / positive, 0.5 / negative) * len(label)
    center, spread = x.mean(), x.std() + 1e-9
    design = np.stack([(x - center) / spread, np.ones(len(x))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weight * (p - target)) + 1e-3 * beta
        step = np.linalg.solve(design.T @ (design * (weight * p * (1 - p))[:, None]) + 1e-3 * np.eye(2), grad)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / spread), float(beta[1] - beta[0] * center / spread)


def learn(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
    max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN,
) -> Model | None:
    """Train on a bounded sample of the label rows where ``usable`` holds."""
    rows = labels.where(usable).select(labels[f"`{id_col}`"].cast("long").alias("doc"), labels[f"`{label}`"].cast("int").alias("toxic"))
    rows = rows.where("doc is not null and toxic in (0, 1)").groupBy("doc").agg(F.max("toxic").alias("toxic"))

    def some(value, most):
        return rows.where(F.col("toxic") == value).orderBy(F.xxhash64("doc", F.lit("toxicity")), "doc").limit(most)

    chosen = some(1, max_toxic).unionByName(some(0, max_clean))
    texts = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc"), docs[f"`{text}`"].alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc").groupBy("doc", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    found = _windows(sample).toPandas().sort_values(["doc", "words"], kind="stable")
    return train(found["doc"].to_numpy(), found["toxic"].to_numpy(), found["words"].tolist())


ship(__name__)
