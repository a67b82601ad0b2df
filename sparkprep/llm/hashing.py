"""Hashes of words and of runs of words, worked out over whole batches of texts with numpy."""

from __future__ import annotations

import numpy as np

# Fixed value of the polynomial hash: an odd base has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)

# A-Z to a-z; other bytes stay.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        held = np.multiply.accumulate(factors)
        if n <= 1 << 23:
            _powers[base] = held
    return held[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def by_fragment(rows: np.ndarray, hashes: np.ndarray, fragments: int) -> list[tuple[int, np.ndarray]]:
    """The rows of each fragment that has any.

    Hashes are mixed again first: those of seeds and anchors are least ones, so they are far from even.
    """
    fragment = (mixed(hashes) >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
    order = np.argsort(fragment, kind="stable")
    borders = np.searchsorted(fragment[order], np.arange(fragments + 1)).tolist()
    return [(f, rows[order[a:b]]) for f, (a, b) in enumerate(zip(borders, borders[1:])) if b > a]


class PrefixHashes:
    """Polynomial hashes of all prefixes of a byte string, so that any substring's is at hand."""

    def __init__(self, data: np.ndarray):
        terms = (data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.inverse = powers(_INVERSE, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


class Words:
    """The words of several texts: where each begins and ends, its hash and the text it is in."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer((b" ".join(texts) + b" ").translate(LOWER), np.uint8)
        space = IS_SPACE[data]
        before = np.concatenate(([True], space[:-1]))
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(space & ~before)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.text_start = np.concatenate(([0], np.cumsum(sizes)))
        self.text = np.searchsorted(self.text_start, self.start, "right") - 1
        lengths = (self.end - self.start).astype(np.uint64)
        self.hash = mixed(PrefixHashes(data).of(self.start, self.end) + lengths)
        # words[first[t]:first[t + 1]] are those of text t
        self.first = np.searchsorted(self.start, self.text_start)

    def runs(self, k: int) -> np.ndarray:
        """A hash for each place of the run of ``k`` words there; the last ``k - 1`` places have none."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total = total * np.uint64(BASE) + self.hash[j : j + n]
        return mixed(total)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``k``-word shingles; of all its words if it has fewer."""
    words = Words(texts)
    runs = words.runs(k)
    out = []
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if last - first >= k:
            out.append(np.unique(runs[first : last - k + 1]))
        elif last > first:
            total = np.uint64(last - first)
            with np.errstate(over="ignore"):
                for h in words.hash[first:last]:
                    total = total * np.uint64(BASE) + h
            out.append(mixed(np.array([total], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
