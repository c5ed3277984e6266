"""Sets of word shingles as sorted 64-bit hashes, computed for whole Arrow batches at once."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: Words of a shingle; words longer than LONG bytes are hashed one by one.
N, LONG, STEP = 5, 256, 1 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWER = np.cumprod(np.full(LONG, 0x9E3779B97F4A7C15, dtype=np.uint64))
_PLACE = _rng.integers(1, 1 << 63, N, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, dtype=bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash a word; some STEP bytes of words are worked on at a time."""
    out = np.empty(len(starts), dtype=np.uint64)
    lengths = ends - starts
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + STEP)))
        size = np.minimum(lengths[i:j], LONG)
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        byte = data[np.repeat(starts[i:j], size) + place]
        out[i:j] = _mixed(np.add.reduceat(_BYTE[byte] * _POWER[place], first) + lengths[i:j].astype(np.uint64))
        i = j
    for k in np.flatnonzero(lengths > LONG):
        out[k] = int.from_bytes(blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, sorted; a null or blank text has none.

    Words are runs of bytes other than ASCII blanks, A-Z lowered. A text with fewer words than a
    shingle has its whole sequence as its one shingle.
    """
    for i in range(0, len(texts), 256):
        yield from _sets(texts.slice(i, 256))


def word_hashes(texts: pa.Array, word: np.ndarray = _WORD) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and for each text the number of words up to its end.

    ``word`` says which bytes, A-Z lowered, belong to words. Null texts have none.
    """
    parts = [(x.as_buffer() if x.is_valid else None) for x in texts.cast(pa.large_string())]
    sizes = np.array([0 if x is None else x.size for x in parts], dtype=np.int64)
    ends_of = np.cumsum(sizes + 1)
    data = np.full(int(ends_of[-1]) if len(ends_of) else 0, 32, dtype=np.uint8)
    for x, end, size in zip(parts, ends_of, sizes):
        if size:
            data[end - 1 - size:end - 1] = np.frombuffer(x, dtype=np.uint8)
    data = _LOWER[data]
    inside = word[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    return _word_hashes(data, starts, ends), np.searchsorted(starts, ends_of)


def grams(hashes: np.ndarray, n: int = N) -> np.ndarray:
    """A hash of every run of n words."""
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    return _mixed(sum(hashes[k:len(hashes) - n + 1 + k] * _PLACE[k] for k in range(n)))


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    hashes, upto = word_hashes(texts)
    rolled = grams(hashes)
    low = 0
    for high in upto:
        n = high - low
        if n >= N:
            own = np.sort(rolled[low:high - N + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif n:
            yield np.array([_short(hashes[low:high])], dtype=np.uint64)
        else:
            yield np.empty(0, dtype=np.uint64)
        low = high


def _short(hashes: np.ndarray) -> int:
    """The hash of a sequence too short for a shingle, its length included."""
    total = sum(int(h) * int(p) for h, p in zip(hashes, _PLACE)) + len(hashes)
    return int(_mixed(np.array([total & (1 << 64) - 1], dtype=np.uint64))[0])


def node(shingles: np.ndarray) -> int | None:
    """A signed 64-bit name of a set: equal for equal sets."""
    if not len(shingles):
        return None
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)
