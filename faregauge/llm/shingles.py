"""Multisets of word shingles, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
# Texts are taken in runs of about so many bytes, which bounds the arrays of a step.
RUN_BYTES = 1 << 20
# Words whose hashes a worker remembers.
REMEMBERED = 100_000

_GOLDEN = 0x9E3779B97F4A7C15
_hashes: dict[str, int] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits scattered over 64 bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in a row, and the offsets of the texts.

    Words are what stands between ASCII white space.
    """
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(real)])[bounds - bounds[0]]
    coded = words.filter(pa.array(real)).dictionary_encode()
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    keys = coded.dictionary.to_pylist()
    own = [_hashes.get(k) for k in keys]
    for i, key in enumerate(keys):
        if own[i] is None:
            own[i] = _hashes[key] = xxhash.xxh3_64_intdigest(key)
    return np.array(own, np.uint64)[coded.indices.to_numpy()], bounds


def runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Consecutive spans of texts of about ``RUN_BYTES`` each."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        done = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + RUN_BYTES, "right")))
        yield start, stop
        start = stop


def shingle_bags(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, count), sorted; the multiset of word runs of every text.

    A text with fewer words has one shingle of all its words; one without words has none.
    """
    hashes, bounds = word_hashes(texts)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    powers = [np.uint64(pow(_GOLDEN, j + 1, 1 << 64)) for j in range(words)]
    whole = max(len(hashes) - words + 1, 0)
    made = np.zeros(whole, np.uint64)
    for j in range(words):
        made += hashes[j : whole + j] * powers[j]
    inside = owner[:whole] == owner[words - 1 :] if whole else np.zeros(0, bool)
    short = np.flatnonzero((sizes > 0) & (sizes < words))
    alone = np.zeros(len(short), np.uint64)
    for j in range(words - 1):
        there = sizes[short] > j
        alone[there] += hashes[bounds[short[there]] + j] * powers[j]
    alone += sizes[short].astype(np.uint64)
    text = np.concatenate([owner[:whole][inside], short])
    shingle = mixed(np.concatenate([made[inside], alone]))
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])
    starts = np.flatnonzero(first)
    return text[starts], shingle[starts], np.diff(np.append(starts, len(text)))
