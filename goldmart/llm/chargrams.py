"""Character n-grams of many tokens at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from goldmart.llm.common import ship

_BASE = 0x9E3779B97F4A7C15  # odd multiplier of the rolling hash
_WRAP = (1 << 64) - 1


def spell(tokens, left: str = "\x02", right: str = "\x03"):
    """(codes, owner, pos): the code points of all tokens between the two marks, the token that each
    belongs to, and its place in the token."""
    import numpy as np

    joined = "".join([f"{left}{t}{right}" for t in tokens])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 2
    owner = np.repeat(np.arange(len(tokens), dtype=np.int32), lengths)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(tokens) else np.zeros(0, np.int64)
    return codes, owner, np.arange(len(codes), dtype=np.int32) - starts.astype(np.int32)[owner]


def hashes(codes, n: int):
    """Hash of the n codes that end at each place (of use only where n codes of one token do)."""
    import numpy as np

    out = codes.copy()
    for j in range(1, n):
        out[j:] += codes[:-j] * np.uint64(pow(_BASE, j, _WRAP + 1))
    out ^= out >> np.uint64(31)
    out *= np.uint64((0xBF58476D1CE4E5B9 + 2 * n) & _WRAP)
    return out ^ (out >> np.uint64(29))


def find(table, wanted):
    """Places of the wanted hashes in a sorted hash array, -1 where absent."""
    import numpy as np

    if not len(table):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return np.where(table[at] == wanted, at, -1)


class TokenIds(dict):
    """Numbers tokens in order of appearance; ``fresh`` are those not yet scored."""

    def __init__(self):
        super().__init__()
        self.fresh = []

    def __missing__(self, token):
        self[token] = number = len(self)
        self.fresh.append(token)
        return number


class TokenCache:
    """Scores of the tokens seen by a task: each distinct token is scored once. At most about
    ``limit`` tokens are kept between chunks, so memory stays bounded."""

    def __init__(self, score, limit: int = 300_000):
        self.score, self.limit = score, limit
        self._reset()

    def _reset(self):
        self.ids, self.blocks, self.values = TokenIds(), [], None

    def number(self, words):
        import numpy as np

        return np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))

    def rows(self):
        """Array with a row of scores for each token number given out so far."""
        import numpy as np

        if self.ids.fresh:
            new = self.score(self.ids.fresh)
            self.ids.fresh = []
            self.values = new if self.values is None else np.concatenate([self.values, new])
        return self.values

    def end_chunk(self):
        if len(self.ids) > self.limit:
            self._reset()


def scored_texts(texts, cache: TokenCache, judge, words_a_chunk: int = 100_000):
    """``judge(token numbers, score rows)`` of each text (null: empty), in order."""
    out, waiting, words_waiting = [], [], 0

    def settle():
        rows = cache.rows()
        out.extend(judge(numbers, rows) for numbers in waiting)
        waiting.clear()
        cache.end_chunk()

    for text in texts:
        words = (text or "").lower().split()
        waiting.append(cache.number(words))
        words_waiting += len(words)
        if words_waiting >= words_a_chunk:
            settle()
            words_waiting = 0
    settle()
    return out


ship(__name__)
