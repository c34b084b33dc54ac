"""The binary Golay code of length 23: a perfect covering code of radius 3."""

from functools import lru_cache

import numpy as np

LENGTH, RADIUS = 23, 3
MASK = (1 << LENGTH) - 1
# Fixed value: the code's generator polynomial, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0xAE3


def _remainders(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.int64).copy()
    for bit in range(LENGTH - 1, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return rest


@lru_cache(maxsize=1)
def _tables(reach: int):
    """Error patterns of at most ``reach`` bits by syndrome and weight.

    Returns syndromes of the low 12 and high 11 bits, the patterns, where those of (syndrome,
    weight) start, how many there are, and the least weight of each syndrome.
    """
    low, high = _remainders(np.arange(1 << 12)), _remainders(np.arange(1 << 11) << 12)
    words = np.arange(1 << LENGTH, dtype=np.int64)
    weight = np.bitwise_count(words).astype(np.int64)
    words, weight = words[weight <= reach], weight[weight <= reach]
    cell = (low[words & 0xFFF] ^ high[words >> 12]) * (reach + 1) + weight
    order = np.argsort(cell, kind="stable")
    counts = np.bincount(cell, minlength=(1 << 11) * (reach + 1))
    starts = np.cumsum(counts) - counts
    counts, starts = counts.reshape(-1, reach + 1), starts.reshape(-1, reach + 1)
    return low, high, words[order], starts, counts, (counts > 0).argmax(axis=1)


def syndromes(words: np.ndarray, reach: int) -> np.ndarray:
    low, high = _tables(reach)[:2]
    return low[words & 0xFFF] ^ high[words >> 12]


def codeword_pairs(first: np.ndarray, second: np.ndarray, reach: int):
    """Pairs of code words within ``reach`` bits, in sum, of pairs of 23-bit words.

    Yields (rows, pairs): row numbers of the input and, for each, the code words as one integer of
    46 bits. How many code words lie at a distance depends on a word's distance from the code
    alone, so rows are handled together by those distances.
    """
    _, _, patterns, starts, counts, leaders = _tables(reach)
    s1, s2 = syndromes(first, reach), syndromes(second, reach)
    kinds = leaders[s1] * (RADIUS + 1) + leaders[s2]
    for kind in np.unique(kinds):
        rows = np.flatnonzero(kinds == kind)
        r1, r2 = s1[rows], s2[rows]
        for i in range(reach + 1):
            n1 = counts[r1[0], i]
            if not n1:
                continue
            near1 = first[rows][:, None] ^ patterns[starts[r1, i][:, None] + np.arange(n1)]
            for j in range(reach + 1 - i):
                n2 = counts[r2[0], j]
                if not n2:
                    continue
                near2 = second[rows][:, None] ^ patterns[starts[r2, j][:, None] + np.arange(n2)]
                pairs = (near1[:, :, None] << LENGTH) | near2[:, None, :]
                yield np.repeat(rows, n1 * n2), pairs.ravel()
