"""Strings of a set length that occur twice in a text, by interval expansion on its Burrows-Wheeler transform.

Suffixes are sorted by as many bytes as the length asks for. Backward extension then goes breadth
first from the interval of the empty string: the interval of c + w comes from that of w through the
last-to-first map, and where the boundary behind it has no common prefix yet, that prefix is as
long as w. So common prefixes appear in increasing order, and the search stops at the set length:
boundaries that are still open there have at least that much in common.
"""

from __future__ import annotations

import numpy as np

#: Ends a text of the collection; no UTF-8 text has this byte.
SEPARATOR = 0xFF


def sorted_suffixes(text: np.ndarray, length: int) -> np.ndarray:
    """Suffix places in the order of their first ``length`` bytes at least, by prefix doubling."""
    n = len(text)
    key = text.astype(np.uint64)
    for step in (1, 2, 4):
        after = np.zeros(n, np.uint64)
        after[: n - step] = key[step:]
        key = (key << np.uint64(8 * step)) | after
    sa = np.argsort(key).astype(np.int32)
    ordered = key[sa]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    slot = np.flatnonzero(new)
    head = np.repeat(slot, np.diff(np.append(slot, n)))
    rank = np.empty(n, np.int64)
    rank[sa] = head
    del key, ordered
    open_ = np.flatnonzero(~(new & np.append(new[1:], True)))
    known = 8
    while known < length and len(open_):
        place = sa[open_]
        behind = place.astype(np.int64) + known
        tail = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        key = head[open_] * (n + 1) + tail
        order = np.argsort(key)
        key, place = key[order], place[order]
        sa[open_] = place
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first = open_[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        head[open_] = first
        rank[place] = first
        open_ = open_[~(new & np.append(new[1:], True))]
        known *= 2
    return sa


def repeated_starts(text: np.ndarray, length: int) -> np.ndarray:
    """For every place whether the ``length`` bytes from there also start elsewhere in the text.

    Places so near the end of a text that they reach its separator are not to be asked for.
    """
    n = len(text)
    sa = sorted_suffixes(text, length)
    slot = np.empty(n, np.int32)
    slot[sa] = np.arange(n, dtype=np.int32)
    back = slot[sa - 1]  # last-to-first: place 0 follows the last one
    first = text[sa]
    shared = np.full(n + 1, -1, np.int16)
    shared[0] = shared[n] = 0
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for depth in range(length):
        if not len(low):
            break
        size = high - low
        total = int(size.sum())
        owner = np.repeat(np.arange(len(low), dtype=np.int32), size)
        within = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        image = back[within + np.repeat(low, size)]
        if total > n >> 4:
            mark = np.full(n, -1, np.int32)
            mark[image] = owner
            image = np.flatnonzero(mark >= 0)
            owner = mark[image]
        else:
            order = np.argsort(image)
            image, owner = image[order].astype(np.int64), owner[order]
        char = first[image]
        new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (char[1:] != char[:-1])))
        begin = np.flatnonzero(new)
        low = image[begin]
        high = image[np.append(begin[1:], total) - 1] + 1
        open_ = shared[high] < 0
        low, high = low[open_], high[open_]
        shared[high] = depth
    far = shared < 0
    return (far[:-1] | far[1:])[slot]
