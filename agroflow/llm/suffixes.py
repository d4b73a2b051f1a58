"""Suffix arrays by linear grouping.

Suffixes are first grouped by their longest Lyndon prefix. The groups are taken in descending order; the
previous-smaller pointer of each member (the nearest suffix before it in a lower group) tells which suffixes
are followed by that group, and how often, and these move up inside their own groups. Then one scan over the
growing array emits every group's order: a suffix's predecessor, and what its pointers lead to, take the next
free places of their groups. Nothing is renamed and no smaller text is sorted.
"""

from __future__ import annotations

from collections import defaultdict


def _grouped(symbols: list[int]) -> tuple[list[int], list[int]]:
    """(group of each suffix, its previous-smaller pointer); a group's number is its first place in the array."""
    n = len(symbols)
    placed = sorted(range(n), key=symbols.__getitem__)
    place = [0] * n
    group = [0] * n
    end = {}
    start = 0
    for at, i in enumerate(placed):
        if at and symbols[i] != symbols[placed[at - 1]]:
            end[start] = at
            start = at
        place[i] = at
        group[i] = start
    end[start] = n
    smaller = [-1] * n
    top = n
    while top:
        current = group[placed[top - 1]]
        followed: dict[int, int] = defaultdict(int)
        # In text order, the pointers of members further left are known.
        for i in sorted(placed[current:top]):
            p = i - 1
            while p >= 0 and group[p] >= current:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                followed[p] += 1
        if len(set(followed.values())) == 1:
            rounds = [followed]
        else:
            by_count = defaultdict(list)
            for p, times in followed.items():
                by_count[times].append(p)
            rounds = [by_count[times] for times in sorted(by_count, reverse=True)]
        for members in rounds:
            free: dict[int, int] = {}
            for p in members:
                g = group[p]
                last = free.get(g, end[g]) - 1
                free[g] = last
                at, other = place[p], placed[last]
                placed[at], placed[last] = other, p
                place[other], place[p] = at, last
            for g, first in free.items():
                if first != g:
                    end[first] = end[g]
                    end[g] = first
                    for p in placed[first : end[first]]:
                        group[p] = first
        top = current
    return group, smaller


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of all suffixes in their order; a suffix is smaller than those it begins."""
    n = len(symbols)
    if not n:
        return []
    group, smaller = _grouped(symbols)
    free = {g: g for g in group}
    out = [-1] * n
    done = [False] * n
    i = n - 1
    for at in range(n + 1):
        while i >= 0 and not done[i]:
            g = group[i]
            out[free[g]] = i
            free[g] += 1
            done[i] = True
            i = smaller[i]
        if at < n:
            i = out[at] - 1
    return out


def common_prefixes(symbols: list[int], suffixes: list[int], limit: int) -> list[int]:
    """Symbols that each suffix shares with the one before it in the array, counted up to ``limit``."""
    n = len(symbols)
    place = [0] * n
    for at, i in enumerate(suffixes):
        place[i] = at
    out = [0] * n
    size = 0
    for i in range(n):
        at = place[i]
        if not at:
            size = 0
            continue
        j = suffixes[at - 1]
        most = min(n - max(i, j), limit)
        while size < most and symbols[i + size] == symbols[j + size]:
            size += 1
        out[at] = size
        if size:
            size -= 1
    return out
