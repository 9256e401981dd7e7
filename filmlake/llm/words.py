"""Words of texts as 64-bit hashes, many texts at a time.

A word is a maximal run of bytes that are neither a space nor one of the control
characters 9 to 13, taken from the UTF-8 form of the text. Its hash is a function
of its bytes alone, so equal words have equal hashes in every task and session.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# bytes of text hashed at once; a longer text is still taken whole
BUFFER_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

_random = np.random.Generator(np.random.PCG64(20260101))
_BYTE = _random.integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i below n."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, BUFFER_BYTES + 4096)
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= BUFFER_BYTES + 4096:
            _powers[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of each value over all 64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def encoded(text: str | None, lower: bool = False) -> bytes:
    """UTF-8 of a text, A to Z lower-cased if asked for; empty for no text."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    return raw.translate(_LOWER) if lower else raw


def spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after it."""
    space = np.ones(len(raw) + 2, dtype=bool)
    space[1:-1] = _SPACE[np.frombuffer(raw, dtype=np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def span_hashes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each piece ``raw[start:end]``."""
    codes = _BYTE[np.frombuffer(raw, dtype=np.uint8)]
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(codes * _power(_BASE, len(raw)), out=sums[1:])
    moved = (sums[ends] - sums[starts]) * _power(_INVERSE, len(raw) + 1)[starts]
    return mix(moved + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def buffers(raws: Sequence[bytes]) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Texts first to last-1, joined by line breaks, and where each starts in the joined bytes."""
    first, size = 0, 0
    for i in range(len(raws) + 1):
        if i == len(raws) or (size and size + len(raws[i]) > BUFFER_BYTES):
            if i > first:
                starts = np.zeros(i - first, dtype=np.int64)
                np.cumsum([len(x) + 1 for x in raws[first : i - 1]], out=starts[1:])
                yield first, i, b"\n".join(raws[first:i]), starts
            first, size = i, 0
        if i < len(raws):
            size += len(raws[i]) + 1


def hashed(raws: Sequence[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For texts first to last-1: the hashes of all their words, and where each text's begin.

    The second array has one more entry, the number of words.
    """
    for first, last, raw, starts in buffers(raws):
        begins, ends = spans(raw)
        bounds = np.append(np.searchsorted(begins, starts), len(begins))
        yield first, last, span_hashes(raw, begins, ends), bounds


def chain(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``width`` hashes in a row, from each position that has that many after it."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = mix(hashes[:n] + np.uint64(width))
    for i in range(1, width):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + hashes[i : i + n])
    return out


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """As ``chain``, with work that does not grow with ``width``."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _power(_BASE, len(hashes)), out=sums[1:])
    return mix((sums[width:] - sums[:n]) * _power(_INVERSE, n))


def within(bounds: np.ndarray, width: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ``n`` positions, those whose ``width`` words lie in one text; and the text of each."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    inside = np.arange(n) + width <= bounds[1:][text]
    return np.flatnonzero(inside), text[inside]


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one text."""
    if not len(words):
        return words
    return np.unique(chain(words, min(width, len(words))))
