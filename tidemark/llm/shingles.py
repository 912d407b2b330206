"""Weighted word shingles of many texts at a time, as arrays.

A word is a run of bytes above the space, with A-Z in lower case. A text's shingles are its runs of five
words (all its words, if it has one to four), each a 64-bit hash; its weight is its number of occurrences in the text
times an inverse document frequency.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE, _BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, each on its own."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word and the text it is in."""
    letter = data > 32
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # where a text begins
    start, end = letter.copy(), letter.copy()
    start[1:] &= ~letter[:-1] | first[1:-1]
    end[:-1] &= ~letter[1:] | first[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end)
    sums = np.cumsum(_LOWER[data] * _power(_BASE, len(data)))
    before = np.where(start > 0, sums[start - 1], np.uint64(0))
    hashes = mix((sums[end] - before) * _power(_BASE_INVERSE, len(data))[start])
    return hashes, np.searchsorted(offsets, start, "right") - 1


def shingles(texts: pa.Array, words: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the text, hash and number of occurrences of each distinct shingle, ordered by text and hash."""
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    empty = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not len(texts) or offsets[-1] == offsets[0]:
        return empty
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    word, text = _words(data, offsets - offsets[0])
    if not len(word):
        return empty
    factors = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    found, of = [], []
    if len(word) >= words:
        whole = text[words - 1:] == text[:len(text) - words + 1]
        total = np.zeros(len(whole), np.uint64)
        for j in range(words):
            total += word[j:len(word) - words + 1 + j] * factors[j]
        found.append(total[whole])
        of.append(text[:len(whole)][whole])
    counts = np.bincount(text, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(counts)])
    for n in range(1, words):
        few = np.flatnonzero(counts == n)
        if len(few):
            found.append(sum(word[begin[few] + j] * factors[j] for j in range(n)) + np.uint64(n))
            of.append(few)
    found, of = mix(np.concatenate(found)), np.concatenate(of)
    order = np.lexsort((found, of))
    found, of = found[order], of[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return of[at], found[at], np.diff(np.append(at, len(found)))


class Idf:
    """Inverse document frequency over 2^20 hashed features, as few levels of weight.

    Shingles in less than ``rare`` of all documents have weight 1; above, the weight falls with the logarithm of the
    share of documents down to ``least`` for a shingle that all documents have. Only the share counts, so
    the same corpus twice over has the same weights. ``least`` is close to 1, so that copies in a group that makes up much of the
    corpus are still found: with 0.8 no pair whose unweighted similarity is 5/6 falls below 0.8. The feature's error (the average number of
    shingles a text over 2^20) does not depend on the corpus size.
    """

    BITS = 20
    LEVELS = 16

    def __init__(self, counts: dict[int, int], documents: int, rare: float = 0.01, least: float = 0.8):
        self.level = np.zeros(1 << self.BITS, np.uint8)
        for feature, n in counts.items():
            share = np.log(max(n / documents / rare, 1)) / np.log(1 / rare)
            self.level[feature] = min(self.LEVELS, round(share * self.LEVELS))
        self.weight = 1 - (1 - least) * np.arange(self.LEVELS + 1) / self.LEVELS

    @classmethod
    def feature(cls, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - cls.BITS)).astype(np.int64)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        return self.level[self.feature(hashes)]


class WeightedSampler:
    """Improved consistent weighted sampling: two texts agree in a sample with the probability of their weighted Jaccard similarity.

    For a shingle of weight w and sample k, with r and c from Gamma(2, 1) and b from [0, 1), all fixed by
    shingle and k: t = floor(ln w / r + b), y = exp(r (t - b)), a = c / (y e^r); the sample is the (shingle, t) of the
    smallest a. r, c and b come from a table of 2^16 triples, entered at another place for each k; equal
    places are told apart by further bits of the shingle.
    """

    _ENTRIES = 1 << 16

    def __init__(self, samples: int):
        draw = np.random.default_rng(20240607)
        u = 1 - draw.random((5, self._ENTRIES))
        self.r, self.log_c, self.b = -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3])), 1 - u[4]
        self.plain = self._key(self.log_c - self.r + self.r * self.b)  # weight 1, where t = 0
        self.factors = draw.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @staticmethod
    def _key(log_a: np.ndarray) -> np.ndarray:
        return np.exp(log_a).astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)

    def samples(self, hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A row of samples for each text; its shingles begin at ``starts``."""
        found = np.empty((len(starts), len(self.factors)), np.uint64)
        odd = np.flatnonzero(weights != 1)
        log_w = np.log(weights[odd])
        for k, factor in enumerate(self.factors):
            place = hashes * factor
            entry = (place >> np.uint64(48)).astype(np.int64)
            key = self.plain[entry]
            if len(odd):
                e = entry[odd]
                r, b = self.r[e], self.b[e]
                t = np.floor(log_w / r + b)
                key[odd] = self._key(self.log_c[e] - r - r * (t - b))
            key |= (place >> np.uint64(16)) & np.uint64(0xFFFFFFFF)
            found[:, k] = np.minimum.reduceat(key, starts)
        return found


def weighted_jaccard(a: tuple, b: tuple, idf: Idf, rows: int) -> np.ndarray:
    """Row by row the similarity of two columns of texts, given as :func:`shingles`."""
    of, hashes = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    weight = np.concatenate([a[2], b[2]]) * idf.weight[idf.levels(hashes)]
    order = np.lexsort((hashes, of))
    of, hashes, weight = of[order], hashes[order], weight[order]
    both = np.flatnonzero((of[1:] == of[:-1]) & (hashes[1:] == hashes[:-1]))
    low = np.bincount(of[both], np.minimum(weight[both], weight[both + 1]), rows)
    total = np.bincount(of, weight, rows)
    return np.divide(low, total - low, out=np.zeros(rows), where=total > low)
