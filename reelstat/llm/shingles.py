"""Word shingles as 64-bit hashes, and MinHash signatures of them. Runs inside tasks, one text at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
from xxhash import xxh3_64_intdigest

WORDS = 5
STEP = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 2048
GROUP = 250_000  # characters of the texts that are split into words at a time


def split_words(text: str | None) -> list[bytes]:
    """Lower-cases A-Z only and splits at space and \\t to \\r, as bytes.lower and bytes.split do."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, width: int = WORDS) -> np.ndarray:
    """One hash per run of `width` words, in order; fewer words are one shingle; no words, none."""
    n = len(hashes)
    if not n:
        return hashes
    length = min(n, width)
    out = np.full(n - length + 1, length, np.uint64)
    for i in range(length):
        out = out * STEP + hashes[i : n - length + 1 + i]
    return mixed(out)


def shingle_set(text: str | None, width: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text, ascending."""
    hashes = np.sort(shingle_hashes(word_hashes(split_words(text)), width))
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])] if len(hashes) else hashes


def groups(texts: Iterable[str | None], size: int = GROUP) -> Iterator[list[str | None]]:
    """The texts in order, in groups of about `size` characters: bounds the words held at a time."""
    group, have = [], 0
    for text in texts:
        group.append(text)
        have += len(text or "") + 1
        if have >= size:
            yield group
            group, have = [], 0
    if group:
        yield group


def shingle_sets(texts: list[str | None], width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """`shingle_set` of each text, one after the other, and the bounds between them (one more than texts).

    Words are hashed together and runs of words made over all of them; runs that cross from text to text are not taken.
    """
    words = [split_words(text) for text in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    hashes = word_hashes(list(chain.from_iterable(words)))
    runs = shingle_hashes(hashes, width)
    starts = np.cumsum(lengths) - lengths
    sizes = np.where(lengths >= width, lengths - width + 1, lengths > 0)
    ends = np.cumsum(sizes)
    values = np.empty(ends[-1] if len(ends) else 0, np.uint64)
    for start, n, end, size in zip(starts.tolist(), lengths.tolist(), ends.tolist(), sizes.tolist()):
        own = values[end - size : end]
        own[:] = runs[start : start + size] if n >= width else shingle_hashes(hashes[start : start + n], width)
        own.sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[(ends - sizes)[sizes > 0]] = True
    return values[new], np.concatenate([[0], np.cumsum(new)])[np.concatenate([[0], ends])]


@cache
def multipliers(n: int, seed: int = 1) -> np.ndarray:
    """Odd multipliers, the same on every machine."""
    state = np.arange(1, n + 1, dtype=np.uint64) * STEP + np.uint64(seed * 0xBF58476D1CE4E5B9 % 2**64)
    return mixed(state) | np.uint64(1)


def minhash(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least of factor * shingle for each factor. Blocks bound the memory of very long texts."""
    if 0 < len(shingles) <= BLOCK:
        return (factors[:, None] * shingles[None, :]).min(axis=1)
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        block = shingles[at : at + BLOCK]
        np.minimum(least, (factors[:, None] * block[None, :]).min(axis=1), out=least)
    return least


def minhashes(values: np.ndarray, bounds: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """`minhash` of each set between the bounds, a row each. No set may be empty."""
    least = np.empty((len(bounds) - 1, len(factors)), np.uint64)
    at = 0
    while at < len(least):
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK, "right")) - 1)
        block = values[bounds[at] : bounds[end]]
        if end == at + 1:
            least[at] = minhash(block, factors)
        else:
            products = factors[:, None] * block[None, :]
            least[at:end] = np.minimum.reduceat(products, bounds[at:end] - bounds[at], axis=1).T
        at = end
    return least


def overlaps(one: np.ndarray, others: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """`overlap` of an ascending set with each of others. No set may be empty."""
    sizes = np.array([len(other) for other in others], np.int64)
    joined = np.concatenate(others)
    found = one[np.minimum(np.searchsorted(one, joined), len(one) - 1)] == joined
    both = np.add.reduceat(found.astype(np.int64), np.cumsum(sizes) - sizes)
    return both, len(one) + sizes - both


def overlap(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two ascending sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both
