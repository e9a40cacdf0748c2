"""Repeated substrings of one shard's texts, from a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

# Intervals up to this size are read row by row, larger ones character by character.
NARROW = 48


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by at least their first ``depth`` codes.

    Prefixes double in length from round to round, and only suffixes that still
    share theirs with another are sorted again.
    """
    n = codes.size
    padded = np.concatenate([codes.astype(np.uint64), np.zeros(8, np.uint64)])
    key = np.zeros(n, np.uint64)
    for step in range(6):
        key = (key << np.uint64(10)) | padded[step : step + n]
    order = np.argsort(key)
    ordered = key[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    del key, padded
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    reach, open_ = 6, _shared(new)
    while reach < depth and open_.size:
        starts = order[open_]
        beyond = starts + reach
        after = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        pair = (rank[starts] << 32) | after
        by = np.argsort(pair)
        starts, pair = starts[by], pair[by]
        order[open_] = starts
        new = np.r_[True, pair[1:] != pair[:-1]]
        rank[starts] = open_[np.maximum.accumulate(np.where(new, np.arange(open_.size), 0))]
        open_ = open_[_shared(new)]
        reach *= 2
    return order


def _shared(new: np.ndarray) -> np.ndarray:
    """Places in classes of more than one, given where classes begin."""
    return np.flatnonzero(~(new & np.r_[new[1:], True]))


def short_prefixes(transform: np.ndarray, depth: int) -> np.ndarray:
    """True at i where the suffixes at i - 1 and i share less than ``depth`` codes.

    Common prefixes come in increasing length: every interval of suffixes that
    begin with some string w is extended backwards by each code that stands
    before it; the end of the interval of c + w is a border of common length
    len(w), unless it was one of a smaller length before.  Each border is thus
    found once, and at ``depth`` the search stops.
    """
    n = transform.size
    by_code = np.argsort(transform, kind="stable")
    codes = transform[by_code].astype(np.int64)
    # Sorted (code, place): a search in it counts a code before a place.
    place = codes * (n + 1) + by_code
    same = codes[1:] == codes[:-1]
    following = np.full(n, n, np.int32)
    following[by_code[:-1][same]] = by_code[1:][same]
    front = np.empty(n, np.int32)
    front[by_code] = np.arange(n, dtype=np.int32)
    alphabet = np.unique(codes)
    border = np.zeros(n + 1, bool)
    border[0] = border[n] = True
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(depth):
        narrow = high - low <= NARROW
        ends, lows, of = [], [], []
        if narrow.any():
            left, right = low[narrow], high[narrow]
            sizes = right - left
            whose = np.repeat(np.arange(left.size), sizes)
            row = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + left[whose]
            last = following[row] >= right[whose]
            row, whose = row[last], whose[last]
            end = front[row].astype(np.int64) + 1
            fresh = ~border[end]
            ends.append(end[fresh])
            lows.append(left[whose[fresh]])
            of.append(transform[row[fresh]].astype(np.int64))
        if not narrow.all():
            left, right = low[~narrow], high[~narrow]
            code = np.tile(alphabet, left.size)
            left, right = np.repeat(left, alphabet.size), np.repeat(right, alphabet.size)
            end = np.searchsorted(place, code * (n + 1) + right)
            before = place[np.maximum(end - 1, 0)]
            fresh = (end > 0) & (before >= code * (n + 1) + left) & ~border[end]
            ends.append(end[fresh])
            lows.append(left[fresh])
            of.append(code[fresh])
        high = np.concatenate(ends)
        if not high.size:
            break
        low = np.searchsorted(place, np.concatenate(of) * (n + 1) + np.concatenate(lows))
        border[high] = True
    return border[:n]


def repeated_starts(texts: list[bytes], groups: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where strings of ``length`` bytes start that occur twice in texts of one group.

    Gives a flag per byte of the texts joined with one separator after each, and
    the offset of every text in them.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.cumsum(sizes + 1) - (sizes + 1)
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    codes = joined.astype(np.uint16) + 2
    codes[offsets + sizes] = 1
    order = suffix_order(codes, length)
    transform = np.where(order > 0, codes[order - 1], 0).astype(np.uint16)
    run = np.cumsum(short_prefixes(transform, length))
    text_of = np.repeat(np.arange(len(texts)), sizes + 1)
    whole = offsets[text_of] + sizes[text_of] >= np.arange(codes.size) + length
    keep = whole[order]
    order, run = order[keep], run[keep]
    group = groups[text_of[order]]
    by = np.lexsort((group, run))
    same = (run[by][1:] == run[by][:-1]) & (group[by][1:] == group[by][:-1])
    twice = np.zeros(by.size, bool)
    twice[1:] |= same
    twice[:-1] |= same
    flags = np.zeros(codes.size, bool)
    flags[order[by[twice]]] = True
    return flags, offsets


def covered(flags: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that flagged strings cover."""
    step = np.zeros(flags.size + length + 1, np.int32)
    at = np.flatnonzero(flags)
    step[at] += 1
    step[at + length] -= 1
    inside = np.r_[False, np.cumsum(step) > 0, False]
    change = np.flatnonzero(inside[1:] != inside[:-1])
    return change[::2], change[1::2]
