"""Word spans and word hashes of one text, on its UTF-8 bytes with numpy.

Hashes are polynomial hashes modulo 2^64 read off prefix sums, mixed afterwards; a window of words
gets its hash the same way from the hashes of its words. No loop runs per word.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASES = [(0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^(n-1) and the powers of its inverse modulo 2^64; base must be odd."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        tables = []
        for b in (base, inverse):
            t = np.full(size, b, dtype=U)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=U))
        have = _powers[base] = (tables[0], tables[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the result."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def spans(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], is_word, [False])).astype(np.int8)))
    return edge[0::2], edge[1::2]


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word data[start:end]; equal bytes give equal hashes in every text."""
    h = _ranges(data.astype(U) + U(1), starts, ends, _BASES[seed][0])
    return mix(h + (ends - starts).astype(U) * U(0x8CB92BA72F3D8DD7))


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """64-bit hash of every run of `size` consecutive word hashes; empty if there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    starts = np.arange(n)
    return mix(_ranges(words, starts, starts + size, _BASES[seed][1]))


# Words are runs of ASCII digits and letters (A-Z folded to a-z) and of all characters from U+0080 on.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
# White space is the blank and U+0009 to U+000D.
IS_TEXT = np.ones(256, dtype=bool)
IS_TEXT[32] = IS_TEXT[9:14] = False


def folded_words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, word starts and ends of a text; null has no words."""
    data = FOLD[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    return (data, *spans(IS_WORD[data]))
