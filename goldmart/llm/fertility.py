"""Quality rules by tokeniser fertility.

A public vocabulary with byte fallback (a sentencepiece model file) cuts the words of a text into tokens. Three figures tell how well
the text fits written language: characters per token, the share of tokens that are bare bytes, and the entropy of
the text's tokens in bits. Each has a band for the script that most letters of the text belong to (``BANDS``, or
bands learned from a corpus by ``learn_bands``); a text outside one of its script's bands is rejected. Upper-case shouting and
symbol litter need many tokens for few characters, repetition has little entropy, and noise needs bytes.

Before the bands come base rules on the words (runs of anything but ASCII white space): fewer than ``LEAST_WORDS`` words, or over
``MOST_REPEATED`` per cent of the words inside three-word windows that occur twice or more in the text.

Row-wise, no shuffle. Each distinct word of a task is cut once, ``KEEP_WORDS`` words are remembered at most, and texts are
worked on in slices of a few MB; a word over ``LONG`` characters is cut in parts of that length, so that a text without
spaces costs linear time.

Cases: a null text has no words; a text without a word has figures 0 and fails the base rules; a text without letters
has the script ``none``; of equally many letters the script first in ``SCRIPTS`` wins; repeated rows are judged one by one;
an empty table gives an empty result; other columns pass through, one named like an output is replaced by it.
"""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldmart.llm.chargrams import TokenIds
from goldmart.llm.common import appended, ship, slices

LEAST_WORDS, MOST_REPEATED = 50, 50
KEEP_WORDS, LONG = 200_000, 1000
_SYMBOLS = b"#*$%&|<>"

# First code points of stretches of the letters of each script.
SCRIPTS = ("latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "thai", "hangul", "kana", "han", "other")
_STRETCHES = (
    (0x00, None), (0x41, "latin"), (0x5B, None), (0x61, "latin"), (0x7B, None), (0xC0, "latin"), (0xD7, None), (0xD8, "latin"), (0xF7, None),
    (0xF8, "latin"), (0x250, "other"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"), (0x590, "hebrew"), (0x600, "arabic"),
    (0x780, "other"), (0x900, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, None), (0x2C00, "other"), (0x3000, None), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xE000, None), (0xF900, "han"), (0xFB00, "other"), (0xFFF0, None),
    (0x10000, "other"), (0x1F000, None), (0x20000, "han"), (0x32000, None),
)

# Fixed values: (least and most characters per token, most share of byte tokens, least entropy in bits) of each script.
BANDS: dict[str, tuple[float, float, float, float]] = {
    "latin": (1.4, 9.0, 0.10, 4.8), "greek": (0.8, 6.0, 0.30, 4.0), "cyrillic": (1.2, 7.0, 0.15, 4.5), "hebrew": (0.7, 5.0, 0.50, 3.5),
    "arabic": (0.7, 5.0, 0.50, 3.5), "indic": (0.5, 4.0, 0.80, 3.0), "thai": (0.4, 4.0, 0.90, 3.0), "hangul": (0.3, 3.0, 0.95, 3.0),
    "kana": (0.3, 3.0, 0.90, 3.0), "han": (0.3, 3.0, 0.95, 3.0), "other": (0.2, 9.0, 1.0, 3.0), "none": (0.5, 9.0, 0.30, 3.5),
}

FIGURES = ("chars_per_token", "byte_share", "token_entropy")
_OUT = [
    *[T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")],
    *[T.StructField(n, T.DoubleType()) for n in FIGURES],
    T.StructField("script", T.StringType()), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
]


def model_bytes(path: str) -> bytes:
    """The vocabulary file, read once on the driver; its bytes go to the workers with the task."""
    with open(path, "rb") as lines:
        return lines.read()


class Words:
    """Numbers of a task's distinct words and, for each, its tokens and its letters by script."""

    def __init__(self, model: bytes):
        import numpy as np
        import sentencepiece

        self.cutter = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.is_byte = np.array([self.cutter.is_byte(i) for i in range(self.cutter.get_piece_size())])
        starts, scripts = zip(*_STRETCHES)
        self.starts = np.array(starts)
        self.of_stretch = np.array([len(SCRIPTS) if s is None else SCRIPTS.index(s) for s in scripts])
        self.forget()

    def forget(self):
        import numpy as np

        self.ids = TokenIds()
        self.tokens, self.first, self.letters = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros((0, len(SCRIPTS)), np.int32)

    def number(self, words):
        import numpy as np

        return np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))

    def learn(self):
        """Cut the words that are new since the last call."""
        import numpy as np

        texts = [w.decode("utf-8", "replace") for w in self.ids.fresh]
        self.ids.fresh = []
        if not texts:
            return
        parts = [t[i:i + LONG] for t in texts for i in range(0, len(t), LONG)]
        cut = self.cutter.encode(parts, num_threads=1)
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        owner = np.repeat(np.arange(len(texts)), [-(-len(t) // LONG) for t in texts])
        per_word = np.bincount(owner, weights=sizes, minlength=len(texts)).astype(np.int64)
        flat = np.fromiter((t for c in cut for t in c), np.int32, int(sizes.sum()))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        script = self.of_stretch[np.searchsorted(self.starts, codes, side="right") - 1]
        word = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        width = len(SCRIPTS) + 1
        letters = np.bincount(word * width + script, minlength=len(texts) * width).reshape(len(texts), width)[:, :-1]
        self.tokens = np.concatenate([self.tokens, flat])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(per_word)])
        self.letters = np.concatenate([self.letters, letters.astype(np.int32)])

    def figures(self, numbers, chars: int):
        """(tokens, characters per token, share of byte tokens, entropy, script) of a text's words."""
        import numpy as np

        if not len(numbers):
            return 0, 0.0, 0.0, 0.0, "none"
        sizes = self.first[numbers + 1] - self.first[numbers]
        ends = np.cumsum(sizes)
        tokens = self.tokens[np.arange(ends[-1]) + np.repeat(self.first[numbers] - (ends - sizes), sizes)]
        count = np.bincount(tokens)
        share = count[count > 0] / len(tokens)
        letters = self.letters[numbers].sum(axis=0)
        script = SCRIPTS[int(letters.argmax())] if letters.any() else "none"
        return len(tokens), chars / len(tokens), float(self.is_byte[tokens].mean()), float(-(share * np.log2(share)).sum()), script


def repeated_words(numbers) -> int:
    """Words inside three-word windows that occur twice or more in the text, the first occurrence included."""
    import numpy as np

    if len(numbers) < 4:
        return 0
    if numbers.max() >= 1 << 21:  # three numbers fit in 63 bits
        _, numbers = np.unique(numbers, return_inverse=True)
    if numbers.max() < 1 << 21:
        window = numbers[:-2] << 42 | numbers[1:-1] << 21 | numbers[2:]
    else:
        _, pair = np.unique(numbers[:-1] * len(numbers) + numbers[1:], return_inverse=True)
        window = pair[:-1] * len(numbers) + numbers[2:]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    again = np.zeros(len(window), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    inside = np.zeros(len(numbers), bool)
    for k in range(3):
        inside[k:len(again) + k] |= again
    return int(inside.sum())


def _in_band(figures, band) -> bool:
    chars, byte_share, entropy = figures
    return band[0] <= chars <= band[1] and byte_share <= band[2] and entropy >= band[3]


def _plain(data: bytes, words) -> tuple[int, int, int]:
    """(code points in words, symbols, repeated lines) of a text."""
    import numpy as np

    joined = b"".join(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    chars = int(np.count_nonzero((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80))
    return chars, len(joined) - len(joined.translate(None, _SYMBOLS)), len(lines) - len(set(lines))


def judge(df: DataFrame, model: bytes, text: str = "text", bands: Mapping[str, tuple[float, float, float, float]] = BANDS) -> DataFrame:
    """Add the counts, the three figures, ``script``, ``base_failed`` and ``kept`` to every row."""
    kept_at, schema = appended(df, _OUT)
    at, bands = df.columns.index(text), dict(bands)

    def verdict(words, data, found, numbers):
        chars, symbols, dup_lines = _plain(data, words)
        repeated = repeated_words(numbers)
        tokens, *figures, script = found.figures(numbers, chars)
        failed = len(words) < LEAST_WORDS or 100 * repeated > MOST_REPEATED * len(words)
        return len(words), chars, symbols, dup_lines, repeated, tokens, *figures, script, failed, not failed and _in_band(figures, bands[script])

    def run(batches):
        found = Words(model)
        types = [{"bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}[f.dataType.simpleString()] for f in _OUT]
        for batch in (part for whole in batches for part in slices(whole, at)):
            texts = [t.as_py() or b"" for t in batch.column(at).cast(pa.binary())]
            split = [data.split() for data in texts]
            numbers = [found.number(words) for words in split]
            found.learn()
            rows = [verdict(w, d, found, n) for w, d, n in zip(split, texts, numbers)]
            if len(found.ids) > KEEP_WORDS:
                found.forget()
            made = [pa.array([r[i] for r in rows], types[i]) for i in range(len(_OUT))]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in kept_at] + made, names=schema.names)

    return df.mapInArrow(run, schema)


def learn_bands(judged: DataFrame, tail: float = 0.01, slack: float = 0.25) -> dict[str, tuple[float, float, float, float]]:
    """Bands of the scripts of a judged corpus: the quantiles ``tail`` and 1 - ``tail`` of the rows that pass the base rules, each widened by
    ``slack`` of its value. All rows count, by one partial aggregate; a row for each script comes back. Other scripts keep ``BANDS``."""
    low, high = (lambda c, q=q: F.percentile_approx(c, q, 10_000) for q in (tail, 1 - tail))
    rows = judged.where(~F.col("base_failed")).groupBy("script").agg(
        low("chars_per_token").alias("least"), high("chars_per_token").alias("most"), high("byte_share").alias("bytes"), low("token_entropy").alias("entropy"),
    ).collect()
    learned = {r["script"]: (r["least"] * (1 - slack), r["most"] * (1 + slack), r["bytes"] * (1 + slack) + 0.01, r["entropy"] * (1 - slack)) for r in rows}
    return {**BANDS, **learned}


ship(__name__)
