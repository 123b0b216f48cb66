"""Packets of a De Bruijn graph over words: rolling hashes, minimizers and runs of windows.

A window of ``k`` words is an edge of the graph.  Consecutive windows of a text whose least
``m``-word hash is the same travel as one packet, so a text is cut where its words say so,
and equal passages give equal packets in every text but at their ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import xxhash

from cartlark.llm.common import SPACE_WORD

#: Multiplier of the rolling hash (odd, so that it has an inverse modulo 2^64).
BASE = 0x9E3779B97F4A7C15
#: Characters of a text that are cut into words at a time.
CHUNK = 1 << 20
#: Word hashes held by a worker at most.
MEMO_WORDS = 200_000


class WordHashes(dict):
    """Hashes of words; a full memo keeps the words that came first."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"), self.seed)
        if len(self) < MEMO_WORDS:
            self[word] = value
        return value


@lru_cache(maxsize=2)
def word_hashes(seed: int) -> WordHashes:
    """One memo per worker process and seed."""
    return WordHashes(seed)


def word_lists(text: str) -> Iterator[list[str]]:
    """The words of a text in lists, so that a very long text is not held as one list."""
    start = 0
    while len(text) - start > CHUNK:
        end = start + CHUNK
        while end < len(text) and text[end] not in " \t\n\v\f\r":
            end += 1
        yield SPACE_WORD.findall(text, start, end)
        start = end
    yield SPACE_WORD.findall(text, start)


def hashed(text: str, seed: int) -> np.ndarray:
    """One 64-bit hash per word."""
    memo = word_hashes(seed)
    parts = [
        np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        for words in word_lists(text)
    ]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


class _Powers:
    """Powers of ``BASE`` and of its inverse, grown as longer texts come."""

    def __init__(self):
        self.up, self.down = self._of(BASE, 1024), self._of(pow(BASE, -1, 1 << 64), 1024)

    @staticmethod
    def _of(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << n.bit_length()
            self.up = self._of(BASE, size)
            self.down = self._of(pow(BASE, -1, 1 << 64), size)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads all bits of a rolling hash over all bits of the result."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Hashes of any span of a text from prefix sums."""

    def __init__(self, words: np.ndarray):
        up, self.down = _POWERS.upto(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[:-1], out=self.sums[1:])

    def spans(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        raw = (self.sums[start + length] - self.sums[start]) * self.down[start]
        return mixed(raw + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def all_of(self, length: int) -> np.ndarray:
        """The hash of every span of ``length`` words."""
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    reach, least = 1, values
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def packets(rolling: Rolling, k: int, m: int) -> tuple[np.ndarray, ...]:
    """``start``, number of windows, minimizer and hash of the words of every packet.

    A packet holds at most ``k - m + 1`` windows; longer runs, as of one repeated word, are cut.
    """
    width = k - m + 1
    least = sliding_least(rolling.all_of(m), width)
    start = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    n = np.diff(np.r_[start, len(least)])
    if n.max() > width:
        pieces = -(-n // width)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        n = np.minimum(np.repeat(n, pieces) - within * width, width)
        start = np.repeat(start, pieces) + within * width
    return start, n, least[start], rolling.spans(start, n + (k - 1))
