"""Words of many texts at once: their places and 64-bit hashes, by numpy over the bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = 0x9E3779B97F4A7C15

#: Bytes that part words: ASCII white space, and all ASCII but digits and letters.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

#: Bytes looked at in one go; temporaries are a fixed multiple of it, however long a text is.
BLOCK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A word's hash sums one random value for each pair of place and byte (tabulation hashing), so
#: no two texts collide by their structure. The values of the first places are kept in a table.
_PLACES = 64
_SEEDS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_VALUES = mix(mix(np.arange(_PLACES, dtype=np.uint64) + np.uint64(_BASE))[:, None] + _SEEDS).ravel()


def _values(bytes_: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The value of each byte at its place in its word."""
    out = _VALUES[np.minimum(places, _PLACES - 1) * 256 + bytes_]
    late = np.flatnonzero(places >= _PLACES)
    if len(late):
        out[late] = mix(mix(places[late].astype(np.uint64) + np.uint64(_BASE)) + _SEEDS[bytes_[late]])
    return out


def _hashes(bytes_: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over whole words, block after block; a word over a border gets the rest in the next."""
    out = np.zeros(len(starts), np.uint64)
    first = 0
    for low in range(0, len(bytes_), BLOCK):
        high = min(low + BLOCK, len(bytes_))
        first += int(np.searchsorted(ends[first:], low, "right"))
        last = first + int(np.searchsorted(starts[first:], high, "left"))
        if first == last:
            continue
        begin, end = np.maximum(starts[first:last], low), np.minimum(ends[first:last], high)
        sizes = end - begin
        edges = np.cumsum(sizes)
        at = np.arange(edges[-1])
        at += np.repeat(begin - (edges - sizes), sizes)
        values = _values(bytes_[at], at - np.repeat(starts[first:last], sizes))
        out[first:last] += np.add.reduceat(values, edges - sizes)
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def _edges(bytes_: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words."""
    found, inside = [], False
    for low in range(0, len(bytes_), BLOCK):
        word = ~parts[bytes_[low:low + BLOCK]]
        change = np.flatnonzero(word[1:] != word[:-1]) + (low + 1)
        if word[0] != inside:
            found.append(np.array([low]))
        found.append(change)
        inside = bool(word[-1])
    edges = np.concatenate([*found, np.array([len(bytes_)] * inside, np.int64)]).astype(np.int64)
    return edges[0::2], edges[1::2]


@dataclass
class Words:
    """``starts``/``ends`` are byte places in ``data``; the words of text i are
    ``hashes[first[i]:first[i + 1]]``."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]]


def words_of(texts: list[str], parts: np.ndarray = SPACE) -> Words:
    """Lower-cases A-Z and splits each text at the bytes marked in ``parts``.

    A text costs its bytes a few times and 24 bytes for each word, kept while they are put together
    once more: up to 15 times its bytes where words are short.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
    data = (b" ".join(raw) + b" ").lower()
    bytes_ = np.frombuffer(data, np.uint8)
    starts, ends = _edges(bytes_, parts)
    first = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
    return Words(data, starts, ends, _hashes(bytes_, starts, ends), first)


def shingles_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out *= np.uint64(_BASE)
        out += hashes[i:i + n]
        out ^= out >> np.uint64(29)
    return mix(out)
