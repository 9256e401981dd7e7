"""Locally consistent parsing of word sequences by recompression.

A round first names every maximal run of one symbol, then splits the symbols into
left and right ones by a bit of their name and names every pair of a left symbol
followed by a right one. Names are hashes of what they stand for, so all tasks
agree on them without a dictionary, and equal names mean equal words.

Whether two neighbours are joined depends on these two alone. So wherever the same
words occur, they are parsed alike, but for a few symbols at either edge that may
reach into the surroundings. ``choose`` uses that: it gives every window of
``width`` words a symbol settled by the words of the window alone.
"""

from __future__ import annotations

import numpy as np

from filmlake.llm.words import chain, mix, rolling

# with two rounds a window of 35 words has some sixteen symbols settled
ROUNDS = 2
# neighbours on either side that are named together with a chosen symbol
AROUND = 3

_RUN = np.uint64(0xA0761D6478BD642F)
_PAIR = np.uint64(0xE7037ED1A0B428DB)
_WHOLE = np.uint64(0x8EBC6AF09C88C6E3)


def _joined(names: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Which symbols equal the one before, in the same text."""
    same = np.zeros(len(names), dtype=bool)
    same[1:] = (names[1:] == names[:-1]) & (texts[1:] == texts[:-1])
    return same


def _least(rank: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place of the least rank in each range ``first`` to ``last`` - 1, the leftmost of equal ones."""
    best = np.arange(len(rank))
    out = np.empty(len(first), dtype=np.int64)
    level = np.frexp(last - first)[1] - 1  # of the largest power of two that fits
    for k in range(int(level.max()) + 1 if len(level) else 0):
        mine = level == k
        a, b = best[first[mine]], best[last[mine] - (1 << k)]
        out[mine] = np.where(rank[b] < rank[a], b, a)
        head, tail = best[: -(1 << k)], best[1 << k :]
        best = np.where(rank[tail] < rank[head], tail, head)
    return out


def choose(
    words: np.ndarray,
    texts: np.ndarray,
    bounds: np.ndarray,
    width: int,
    rounds: int = ROUNDS,
    around: int = AROUND,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows that choose the same high-level symbol.

    ``words`` are the hashes of the words of some texts, ``texts`` the text of
    each and ``bounds`` where the texts begin. Returns the chosen name, the first
    window, the number of windows and the weight of each run.

    After the last round every symbol is named once more together with ``around``
    neighbours on either side. A window chooses the least of these names among
    those it settles, so windows of the same words choose the same name. A window
    that settles none, such as one inside a long run, has its own hash as name;
    such windows weigh one each, since equal names there mean equal windows.
    """
    n = len(words)
    starts = np.arange(n)
    starts = starts[starts + width <= bounds[1:][texts]] if n else starts
    if not len(starts):
        empty = np.empty(0, dtype=np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    names, owner = words, texts
    left, right = starts, starts + width  # boundaries settled from either side
    for _ in range(rounds):
        # runs: the first and the last one may reach beyond the window
        same = _joined(names, owner)
        heads = np.flatnonzero(~same)
        run_of = np.cumsum(~same) - 1
        lengths = np.diff(np.append(heads, len(names)))
        left = np.where(left < len(names), run_of[np.minimum(left, len(names) - 1)] + 1, len(heads))
        right = np.where(right > 0, run_of[right - 1], 0)
        names, owner = names[heads], owner[heads]
        long = lengths > 1
        names[long] = mix(names[long] * _RUN + lengths[long].astype(np.uint64))
        # pairs: a right symbol may belong to the one before, a left one to the one after
        m = len(names)
        is_right = np.ones(m + 1, dtype=bool)
        is_right[:m] = mix(names ^ _PAIR) >> np.uint64(63)
        second = np.zeros(m + 1, dtype=bool)
        second[1:m] = ~is_right[: m - 1] & is_right[1:m] & (owner[1:] == owner[:-1])
        new_of = np.cumsum(~second) - 1  # of the boundary before a symbol that is no second one
        left = new_of[np.minimum(left + is_right[left], m)]
        right = np.where(right > 0, new_of[right - ~is_right[right - 1]], 0)
        heads = np.flatnonzero(~second[:m])
        paired = second[heads + 1]
        merged, owner = names[heads], owner[heads]
        merged[paired] = mix(merged[paired] * _PAIR + names[heads[paired] + 1])
        names = merged
    span = 2 * around + 1
    settled = right - left >= span
    name = np.empty(len(starts), dtype=np.uint64)
    place = np.full(len(starts), -1, dtype=np.int64)
    if settled.any():
        high = chain(names, span)
        best = _least(mix(high), left[settled], right[settled] - span + 1)
        name[settled], place[settled] = high[best], best
    if not settled.all():
        name[~settled] = mix(rolling(words, width)[starts[~settled]] ^ _WHOLE)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (name[1:] != name[:-1]) | (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    firsts = np.flatnonzero(new)
    counts = np.diff(np.append(firsts, len(starts)))
    return name[firsts], starts[firsts], counts, np.where(place[firsts] < 0, counts, 1)
