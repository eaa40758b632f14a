"""Words of a text as 64-bit hashes, computed with arrays.

A word is a run of ASCII letters, digits, `_` and characters beyond ASCII, in lower case. Hashes
are the same on every machine and in every run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np

_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True
_BASE = 0x9E3779B97F4A7C15
_SEGMENT = 1 << 20
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def text_bytes(text: str | None) -> np.ndarray:
    """The text in lower case as UTF-8; characters that are no text become `?`."""
    return np.frombuffer(_lowered(text), dtype=np.uint8)


def texts_bytes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of several texts, a line feed after each, and where each begins. No word reaches
    into the next text."""
    lowered = [_lowered(text) for text in texts]
    begins = np.cumsum([0, *[len(data) + 1 for data in lowered]])[:-1]
    return np.frombuffer(b"\n".join([*lowered, b""]), dtype=np.uint8), begins


def _lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes."""
    inside = np.concatenate(([False], _WORD_BYTE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each range; ranges are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    for first, last, hashed in _hashers(data, starts, ends):
        out[first:last] = hashed(starts[first:last], ends[first:last])
    return out


def beginning_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: Sequence[int]
) -> list[tuple[np.ndarray, np.ndarray]]:
    """The hashes of the ranges, and for each size those of the first bytes of longer ranges; with
    the number of the range of each. All are taken from the same running sums."""
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(1 + len(sizes))]
    for first, last, hashed in _hashers(data, starts, ends):
        low, high = starts[first:last], ends[first:last]
        found[0].append((hashed(low, high), np.arange(first, last)))
        for size, parts in zip(sizes, found[1:], strict=True):
            long = np.flatnonzero(high - low > size)
            parts.append((hashed(low[long], low[long] + size), first + long))
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return [
        tuple(np.concatenate(arrays) for arrays in zip(none, *parts, strict=True))
        for parts in found
    ]


def _hashers(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> Iterator[tuple[int, int, Callable[[np.ndarray, np.ndarray], np.ndarray]]]:
    """The ranges in groups that lie close together, with a function for hashes inside a group."""
    first = 0
    while first < len(starts):
        origin = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, origin + _SEGMENT, "right")))
        yield first, last, _hasher(data[origin : int(ends[last - 1])], origin)
        first = last


def _hasher(
    piece: np.ndarray, origin: int
) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    powers, inverses = _tables(len(piece) + 1)
    sums = np.zeros(len(piece) + 1, dtype=np.uint64)
    np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * powers[: len(piece)], out=sums[1:])

    def hashed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        low, high = low - origin, high - origin
        return mix((sums[high] - sums[low]) * inverses[low])

    return hashed


def words(text: str | None) -> np.ndarray:
    data = text_bytes(text)
    return range_hashes(data, *spans(data))


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """A hash for each run of `size` words; a shorter text is one shingle of all its words."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    count = len(hashes) - size + 1
    out = np.zeros(count, dtype=np.uint64)
    for offset in range(size):
        out = out * np.uint64(_BASE) + hashes[offset : offset + count]
    return mix(out)


def sequence_hash(hashes: np.ndarray) -> bytes:
    """128 bits for a whole sequence of words, order included."""
    place = mix(np.arange(1, len(hashes) + 1, dtype=np.uint64))
    parts = [
        np.sum(mix(hashes + place * np.uint64(odd)), dtype=np.uint64)
        for odd in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
    ]
    return np.array([*parts, len(hashes)], dtype=np.uint64).tobytes()


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < size:
        size = max(size, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        _powers = _running_powers(_BASE, size)
        _inverses = _running_powers(inverse, size)
    return _powers, _inverses


def _running_powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)
