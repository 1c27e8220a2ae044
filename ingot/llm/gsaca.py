"""Suffix sorting by grouping (linear grouping construction).

Phase 1 puts every suffix in the group of its Lyndon prefix, the longest prefix that is a
Lyndon word.  Groups start as the symbols and are taken in descending order.  For each suffix of
the group taken, the previous-smaller pointer names the nearest suffix to its left of a smaller
group; that suffix's Lyndon prefix grows by the group's word, once per suffix that points to
it, so it moves to a new group right behind those of its old group that do not grow as far.

Phase 2 emits the order: the suffixes of a group follow each other as the suffixes behind their
Lyndon prefixes do, and those are smaller and therefore already placed.  One pass fills all
groups; nothing is renamed and nothing recurses.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of ``symbols`` (non-negative integers), in lexicographic
    order; a suffix that is a prefix of another comes first."""
    n = len(symbols)
    if n < 2:
        return np.arange(n)
    start = np.argsort(symbols, kind="stable")
    by = symbols[start]
    new = np.concatenate([[True], by[1:] != by[:-1]])
    heads = np.flatnonzero(new)
    slots: list[int] = start.tolist()  # suffixes, grouped
    place = np.empty(n, np.int64)
    place[start] = np.arange(n)
    place: list[int] = place.tolist()  # slot of each suffix
    group = np.empty(n, np.int64)
    group[start] = np.repeat(heads, np.diff(np.append(heads, n)))
    group: list[int] = group.tolist()  # first slot of each suffix's group: ordered as the groups are
    length = [0] * (n + 1)  # by a group's first slot
    for h, k in zip(heads.tolist(), np.diff(np.append(heads, n)).tolist()):
        length[h] = k
    after: list[int] = list(range(1, n + 1))  # end of each suffix's Lyndon prefix
    before = [-1] * n  # previous-smaller pointers of the suffixes taken
    end = n
    while end > 0:
        low = group[slots[end - 1]]
        members = slots[low:end] if end - low == 1 else sorted(slots[low:end])
        end = low
        grows: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[i] = p
            if p >= 0:
                grows[p] = grows.get(p, 0) + 1
        if not grows:
            continue
        word = after[members[0]] - members[0]
        if len(grows) == 1:
            batches = [list(grows)]
            times = [next(iter(grows.values()))]
        else:
            times = sorted(set(grows.values()), reverse=True)
            batches = [list(grows)] if len(times) == 1 else [[p for p, k in grows.items() if k == t] for t in times]
        for t, batch in zip(times, batches):
            for p in batch:  # to the end of its old group
                g = group[p]
                length[g] = k = length[g] - 1
                last, at = g + k, place[p]
                if last != at:
                    other = slots[last]
                    slots[at], place[other] = other, at
                    slots[last], place[p] = p, last
            heads_ = [group[p] + length[group[p]] for p in batch]
            for p, h in zip(batch, heads_):
                group[p] = h
                length[h] += 1
                after[p] += t * word
    # phase 2
    waiting: list = [None] * (n + 1)  # suffixes by the end of their Lyndon prefix
    for i, a in enumerate(after):
        if waiting[a] is None:
            waiting[a] = [i]
        else:
            waiting[a].append(i)
    free = list(range(n))  # next slot of the group that starts here
    order = [0] * n
    for i in waiting[n] or ():
        g = group[i]
        order[free[g]] = i
        free[g] += 1
    for r in range(n):
        w = waiting[order[r]]
        if w is not None:
            for i in w:
                g = group[i]
                order[free[g]] = i
                free[g] += 1
    return np.array(order, np.int64)
