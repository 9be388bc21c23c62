"""Word shingles as 64-bit hashes, computed for a batch of texts at once with numpy."""

from __future__ import annotations

import numpy as np

_M = np.uint64(0x9E3779B97F4A7C15 | 5)
_K = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
BLOCK_BYTES = 1 << 19


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    h = h + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of the polynomial's base and of its inverse modulo 2 ** 64, as many as the longest block needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            base = np.full(n, _M, np.uint64)
            base[0] = 1
            self.up = np.multiply.accumulate(base)
            base[1:] = pow(int(_M), -1, 1 << 64)
            self.down = np.multiply.accumulate(base)
        return self.up[:n], self.down[:n]


_powers = Powers()


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, scale): the polynomial hash of data[a:b] is (sums[b] - sums[a]) * scale[a]."""
    up, down = _powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums, down


def blocks(texts: list[bytes], most: int = BLOCK_BYTES):
    """Index ranges of consecutive texts of about ``most`` bytes."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= most:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def shingle_sets(texts: list[bytes], k: int, seed: int = 0) -> list[np.ndarray]:
    """Of each text, A-Z lower-cased: its distinct shingles of ``k`` words, sorted; the whole sequence if it is shorter; none without words."""
    out: list[np.ndarray] = []
    for a, b in blocks(texts):
        part = [t.lower() for t in texts[a:b]]
        data = np.frombuffer(b"\n" + b"\n".join(part) + b"\n", np.uint8)
        space = _SPACE[data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        first, last = edge[0::2], edge[1::2]
        sums, scale = prefix_hashes(data)
        word = mix((sums[last] - sums[first]) * scale[first] + (last - first).astype(np.uint64), seed)
        ends = np.cumsum([len(t) + 1 for t in part])
        upto = np.searchsorted(first, ends)  # words before each text's end
        n = len(word)
        rolled = word.copy()
        for j in range(1, min(k, n)):
            rolled[: n - j] = rolled[: n - j] * _K + word[j:]
        rolled = mix(rolled, seed + 1)
        at = 0
        for end in upto.tolist():
            words = end - at
            if words >= k:
                out.append(np.unique(rolled[at : end - k + 1]))
            elif words:
                h = np.uint64(words)
                with np.errstate(over="ignore"):
                    for w in word[at:end]:
                        h = h * _K + w
                out.append(mix(np.array([h], np.uint64), seed + 2))
            else:
                out.append(np.empty(0, np.uint64))
            at = end
    return out
