"""Suffix array by linear grouping construction, without recursion or renaming.

Phase one sorts suffixes into groups by their longest Lyndon prefix. Groups are processed from the greatest to
the smallest; each suffix of the group finds its previous smaller suffix through the pointers already known, and
the suffixes so pointed at leave their group for a new one right above it, those with more pointers higher.
Phase two walks the finished order from the smallest suffix: whenever a suffix is known, the suffixes whose
Lyndon prefix ends where it begins take the next free place of their group.
"""

from __future__ import annotations

from collections import Counter

#: A suffix whose previous smaller one is not known yet; -1 stands for none.
UNKNOWN = -2


def suffix_array(text: list[int]) -> list[int]:
    """Order of the suffixes of a sequence of non-negative integers whose last item is its only smallest."""
    n = len(text)
    if n < 2:
        return list(range(n))
    # groups are intervals of `order`, named by where they begin
    size: dict[int, int] = {}
    at = 0
    begin = {}
    for symbol, count in sorted(Counter(text).items()):
        begin[symbol], size[at] = at, count
        at += count
    group = [begin[s] for s in text]
    free = dict(begin)
    order, place = [0] * n, [0] * n
    for i, s in enumerate(text):
        p = free[s]
        free[s] = p + 1
        order[p], place[i] = i, p
    before = [UNKNOWN] * n
    top = n
    while top > 0:
        g = group[order[top - 1]]
        if top - g == 1:
            i = order[g]
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = before[j]
            before[i] = j
            if j >= 0:
                # one pointer: the suffix moves to the end of its group and becomes a group of its own
                h = group[j]
                left = size[h] - 1
                if left:
                    size[h] = left
                    last, spot = h + left, place[j]
                    other = order[last]
                    order[spot], place[other] = other, spot
                    order[last], place[j] = j, last
                    group[j], size[last] = last, 1
            top = g
            continue
        # members that meet one another on their way to the left have one previous smaller suffix: each step is taken once
        pointers: dict[int, int] = {}
        for i in order[g:top]:
            if before[i] != UNKNOWN:
                continue
            chain, j = [i], i - 1
            while j >= 0 and group[j] >= g:
                k = before[j]
                if k == UNKNOWN:
                    chain.append(j)
                    k = j - 1
                j = k
            for i in chain:
                before[i] = j
            if j >= 0:
                pointers[j] = pointers.get(j, 0) + len(chain)
        by_count: dict[int, list[int]] = {}
        for j, c in pointers.items():
            by_count.setdefault(c, []).append(j)
        for c in sorted(by_count, reverse=True):
            moved = by_count[c]
            for j in moved:
                h = group[j]
                left = size[h] - 1
                size[h] = left
                last, spot = h + left, place[j]
                other = order[last]
                order[spot], place[other] = other, spot
                order[last], place[j] = j, last
            fresh: dict[int, int] = {}
            for j in moved:
                h = group[j]
                new = fresh.get(h)
                if new is None:
                    new = fresh[h] = h + size[h]
                group[j] = new
            for j in moved:
                size[group[j]] = 0
            for j in moved:
                size[group[j]] += 1
        top = g
    out = [-1] * n
    placed = [False] * n
    head = group  # next free place of a group, kept at the group's first place
    nxt = list(range(n))
    out[0], placed[n - 1] = n - 1, True
    for p in range(n):
        i = out[p] - 1
        while i >= 0 and not placed[i]:
            h = head[i]
            q = nxt[h]
            nxt[h] = q + 1
            out[q], placed[i] = i, True
            i = before[i]
    return out
