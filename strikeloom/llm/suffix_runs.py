"""Sorted runs of strings: front coding, and merging that never compares a known prefix again."""

from collections.abc import Iterator

import numpy as np
import zstandard


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the longest common prefix of two strings that share at least ``known`` bytes."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    step = 16
    while a[low : low + step] == b[low : low + step]:
        low += step
    high = min(high, low + step)
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_coded(strings: list[bytes]) -> bytes:
    """A sorted run of strings (up to 255 bytes each): shared prefix lengths, then what follows them."""
    shared, rests, before = [], [], b""
    for string in strings:
        n = common_prefix(before, string, 0)
        shared.append(n)
        rests.append(string[n:])
        before = string
    sizes = np.array([[n, len(r)] for n, r in zip(shared, rests)], np.uint8).tobytes()
    packed = zstandard.ZstdCompressor(level=1).compress(sizes + b"".join(rests))
    return len(strings).to_bytes(4, "little") + packed


def decoded(run: bytes) -> Iterator[tuple[bytes, int]]:
    """The strings of a run, each with the length of the prefix it shares with the one before it."""
    n = int.from_bytes(run[:4], "little")
    data = zstandard.ZstdDecompressor().decompress(run[4:])
    at, before = 2 * n, b""
    for k in range(n):
        shared, rest = data[2 * k], data[2 * k + 1]
        before = before[:shared] + data[at : at + rest]
        at += rest
        yield before, shared


def merged(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[int, int]]:
    """Merge sorted runs by a loser tree: (number of the run, prefix shared with the last output).

    Every contender carries the prefix it shares with the last winner. The longer one wins without
    a look at the strings; only equal ones are compared, from that length on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list[tuple[bytes, int] | None] = [next(run, None) for run in runs]
    heads += [None] * (k - len(runs))
    string = [head[0] if head else b"" for head in heads]
    known = [head[1] if head else -1 for head in heads]
    losers = [0] * (2 * k)

    def beats(a: int, b: int) -> bool:
        """Whether run ``a`` comes before run ``b``; updates what the loser shares with the winner."""
        if known[a] != known[b]:
            return known[a] > known[b]
        if known[a] < 0:
            return True
        x, y = string[a], string[b]
        shared = common_prefix(x, y, known[a])
        wins = shared == len(x) or (shared < len(y) and x[shared] < y[shared])
        known[b if wins else a] = shared
        return wins

    winners = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        first = beats(a, b)
        winners[node], losers[node] = (a, b) if first else (b, a)
    top = winners[1]
    while known[top] >= 0:
        yield top, known[top]
        head = next(runs[top], None)
        string[top], known[top] = head if head else (b"", -1)
        node = (k + top) // 2
        while node:
            if beats(losers[node], top):
                losers[node], top = top, losers[node]
            node //= 2
