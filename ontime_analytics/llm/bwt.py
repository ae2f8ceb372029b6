"""Burrows-Wheeler transform of a collection of short strings, built column by column.

Round j inserts, for every string that is long enough, its suffix of length j:
the symbol before the suffix inserted in the round before says where (the
rank of that symbol among all symbols so far).  Nothing is sorted but symbols.
Common prefixes follow from the rows between a symbol's occurrences: one more
than the least common prefix among them.  The rows are read and rewritten in
order each round, in memory: callers give bounded batches.
"""

from __future__ import annotations

import numpy as np

CAP = 255            # common prefixes are counted up to here


def _put_between(old_values: np.ndarray, old: np.ndarray, places: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The rows of a round: the old ones in their order, new ones at ``places``."""
    out = np.empty(len(old_values) + len(places), old_values.dtype)
    out[old] = old_values
    out[places] = values
    return out


def collection_suffixes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, length, common prefix with the row before) of all suffixes of all strings, in order.

    ``data`` holds the strings' bytes, string i at ``starts[i]`` with
    ``sizes[i]`` bytes.  Equal suffixes go by the order of the strings that
    hold them, decided at their ends; empty suffixes come first."""
    m = len(starts)
    ends = starts + sizes
    used = np.bincount(data, minlength=256) > 0
    end = int(used.sum())          # the symbol before a whole string: after all bytes that occur, which are renumbered
    kind = np.uint8 if end < 256 else np.uint16
    data = (np.cumsum(used) - 1).astype(kind)[data]

    def symbol(which: np.ndarray, length: int) -> np.ndarray:
        at = ends[which] - length - 1
        return np.where(at >= starts[which], data[np.maximum(at, 0)] if len(data) else end, end).astype(kind)

    every = np.arange(m)
    symbols, common = symbol(every, 0), np.zeros(m, np.uint8)
    who, size = every.astype(np.uint32), np.zeros(m, np.uint16)
    last = every.copy()
    for j in range(1, int(sizes.max()) + 1 if m else 1):
        active = np.flatnonzero(sizes >= j)
        order = np.argsort(symbols, kind="stable")
        order = order[:len(order) - int(np.count_nonzero(symbols == end))]
        rank = np.empty(len(symbols), np.int64)
        rank[order] = np.arange(len(order))
        active = active[np.argsort(last[active])]   # by place, so that the gaps between the ranges below stay short
        row = last[active]
        q = rank[row]
        mine = symbols[row]

        def between(low: np.ndarray, high: np.ndarray, common=common) -> np.ndarray:
            """1 + the least common prefix in the rows low + 1 to high, for each pair."""
            if not len(low):
                return np.empty(0, np.uint8)
            edges = np.stack([low + 1, high + 1], axis=1).reshape(-1)
            tail = np.concatenate([common, np.zeros(1, np.uint8)])
            return np.minimum(np.minimum.reduceat(tail, edges)[::2], CAP - 1) + np.uint8(1)

        before = np.flatnonzero((q > 0) & (symbols[order[np.maximum(q - 1, 0)]] == mine))
        new = np.zeros(len(active), np.uint8)
        new[before] = between(order[q[before] - 1], row[before])
        after = np.flatnonzero((q + 1 < len(order)) & (symbols[order[np.minimum(q + 1, len(order) - 1)]] == mine))
        next_ = between(row[after], order[q[after] + 1])

        places = m + q
        old = np.ones(len(symbols) + len(active), bool)
        old[places] = False
        symbols = _put_between(symbols, old, places, symbol(active, j))
        common = _put_between(common, old, places, new)
        common[places[after] + 1] = next_
        who = _put_between(who, old, places, active.astype(np.uint32))
        size = _put_between(size, old, places, np.full(len(active), j, np.uint16))
        last[active] = places
    return who, size, common


def earlier_occurrences(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, owners: np.ndarray, width: int) -> np.ndarray:
    """(string, offset) rows of the ``width``-byte strings that also start in a string with a smaller owner."""
    who, size, lcp = collection_suffixes(data, starts, sizes)
    if not len(who):
        return np.empty((0, 2), np.int64)
    first = np.flatnonzero(np.concatenate([[True], lcp[1:] < width]))
    owner = owners[who]
    least = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.concatenate([first, [len(who)]])))
    hit = (size >= width) & (least < owner)
    return np.stack([who[hit].astype(np.int64), sizes[who[hit]] - size[hit].astype(np.int64)], axis=1)
