"""Repeated byte strings across documents, by anchored suffixes that are sorted with hash-compared extensions."""

from __future__ import annotations

import numpy as np

from tidelog.llm.texts import mix

GRAM = 20  # bytes of an anchor

_BASE = np.uint64(0x5851F42D4C957F2D)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
# another hash, of another base and of random numbers in place of bytes
_SECOND = np.uint64(0x2545F4914F6CDD1D)
_SECOND_BACK = np.uint64(pow(int(_SECOND), -1, 1 << 64))
_UPPER = np.uint64(0xFFFFFFFF00000000)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)  # no place is so large
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _powers(n: int, base: np.uint64, known: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006  grown once per worker
    if len(known.get(int(base), ())) < n:
        known[int(base)] = np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(2 * n, 1 << 12), base)])
    return known[int(base)][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, one more than there are bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), _BASE), out=out[1:])
    return out


def second_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes that do not depend on those of ``prefix_hashes``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _powers(len(data), _SECOND), out=out[1:])
    return out


def span_hashes(prefixes: np.ndarray, back: np.ndarray, starts: np.ndarray, lengths) -> np.ndarray:
    """Hashes of spans that do not depend on where they stand. ``back``: powers of the inverse base."""
    return (prefixes[starts + lengths] - prefixes[starts]) * back[starts]


def _extreme(values: np.ndarray, width: int, take) -> np.ndarray:
    """The smallest or largest of every ``width`` values in a row."""
    done = 1
    while 2 * done <= width:
        values = take(values[: len(values) - done], values[done:])
        done *= 2
    return take(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def anchors(
    data: np.ndarray, length: int, prefixes: np.ndarray | None = None, offsets: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, first window, last window) of each anchor of a text, or of all texts that ``offsets`` cut the data into.

    A window is ``length`` bytes of one text; its anchor is the first of its GRAM-byte strings with the smallest hash, judged by the
    upper half of the hashes. Equal windows have their anchors in the same place, and an anchor serves a run of windows.
    """
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none
    prefixes, back = prefix_hashes(data) if prefixes is None else prefixes, _powers(len(data) + 1, _BACK)
    grams = mix((prefixes[GRAM:] - prefixes[:-GRAM]) * back[: len(data) - GRAM + 1])
    # the lower half is the place, so that the smallest one is the first of its kind, too
    lowest = _extreme(grams & _UPPER | np.arange(len(grams), dtype=np.uint64), length - GRAM + 1, np.minimum)
    if offsets is not None:
        beyond = np.maximum(offsets[1:, None] - np.arange(1, length), offsets[:-1, None]).ravel()
        beyond = beyond[np.repeat(np.diff(offsets) > 0, length - 1)]
        lowest[beyond[beyond < len(lowest)]] = _NONE
    changes = np.r_[0, np.flatnonzero(lowest[1:] != lowest[:-1]) + 1]
    last = np.r_[changes[1:], len(lowest)] - 1
    found = lowest[changes]
    real = found != _NONE
    places = (found[real] & ~_UPPER).astype(np.int64)
    return places, grams[places], changes[real], last[real]


def extensions(prefixes: np.ndarray, back: np.ndarray, one: np.ndarray, two: np.ndarray, length: int) -> np.ndarray:
    """How many bytes the suffixes at ``one`` and ``two`` have in common, up to ``length``: by halving, on hashes."""
    low, high = np.zeros(len(one), np.int64), np.full(len(one), length, np.int64)
    from_one, from_two, back_one, back_two = prefixes[one], prefixes[two], back[one], back[two]
    for _ in range(length.bit_length()):
        middle = (low + high + 1) // 2
        same = (prefixes[one + middle] - from_one) * back_one == (prefixes[two + middle] - from_two) * back_two
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number; zeros follow the last byte."""
    padded = np.r_[data, np.zeros(8, np.uint8)]
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(data)]).view(">u8")[:, 0].astype(np.uint64)


def sort_suffixes(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes that start ``at`` the given places, by their first ``length`` bytes within their groups,
    and for each in that order whether it is equal to the one before.

    Groups are numbered in order. All groups are merge-sorted together: in each round every suffix finds its place
    in the run beside its own by halving, and two suffixes are compared by their first eight bytes or, if these are equal, by the
    first byte after their common extension. Equal neighbours are compared byte by byte in the end, so that no equal hashes of different bytes count.
    """
    prefixes, back = prefix_hashes(data), _powers(len(data) + 1, _BACK)
    starts = np.searchsorted(group, group, "left")
    ends = np.searchsorted(group, group, "right")
    order = np.arange(len(at))
    words = _words(data) if length >= 8 else np.zeros(len(data), np.uint64)
    width = 1
    while len(at) and width < int((ends - starts).max()):
        live = np.flatnonzero(ends - starts > width)
        within = live - starts[live]
        run = within // width
        left = run % 2 == 0
        beside = np.minimum(starts[live] + np.where(left, run + 1, run - 1) * width, ends[live])
        low, high = beside.copy(), np.minimum(beside + width, ends[live])
        mine = at[order[live]]
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            theirs, own = at[order[middle]], mine[open_]
            less = words[theirs] < words[own]
            alike = np.flatnonzero(words[theirs] == words[own])
            one, two = theirs[alike], own[alike]
            common = extensions(prefixes, back, one, two, length)
            full = common == length
            step = np.where(full, 0, common)
            less[alike] = np.where(full, ~left[open_[alike]], data[one + step] < data[two + step])  # equal: those on the left first
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
        pair = starts[live] + (run - run % 2) * width
        place = pair + within % width + (low - beside)
        moved = order.copy()
        moved[place] = order[live]
        order, width = moved, 2 * width
    equal = np.zeros(len(at), bool)
    if len(at) > 1:
        one, two = at[order[:-1]], at[order[1:]]
        near = np.flatnonzero((group[:-1] == group[1:]) & (extensions(prefixes, back, one, two, length) == length))
        for part in np.array_split(near, len(near) // 20000 + 1):
            equal[part + 1] = (data[one[part, None] + np.arange(length)] == data[two[part, None] + np.arange(length)]).all(axis=1)
    return order, equal
