"""A suffix array by linear grouping, without renaming and recursion."""

from __future__ import annotations

import numpy as np


def _nearest(link: list[int], i: int) -> int:
    """The last place at or before ``i`` that is not linked further back, or -1."""
    at = i
    while at >= 0 and link[at] != at:
        at = link[at]
    while i >= 0 and link[i] != i and link[i] != at:
        link[i], i = at, link[i]
    return at


def _lyndon_groups(symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """For each suffix the first rank of its group and the length of the group's common Lyndon prefix.

    Suffixes start in groups of equal first symbols. Groups are taken from the highest to the lowest.
    The previous smaller pointer of a member leads to the nearest suffix before it in a lower group; that
    one's prefix is continued by the group's as often as members point to it, and it moves behind those of its
    old group whose prefix is not, the further the more often. What has been taken never changes again.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    first = np.flatnonzero(np.diff(symbols[order], prepend=-1))
    group = np.empty(n, np.int64)
    group[order] = np.repeat(first, np.diff(np.append(first, n)))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    ends = np.zeros(n, np.int64)
    ends[first] = np.append(first[1:], n)
    order, group, place, ends = order.tolist(), group.tolist(), place.tolist(), ends.tolist()
    length, link = [1] * n, list(range(n))

    def move(p: int, to: int) -> None:
        at, other = place[p], order[to]
        order[at], order[to] = other, p
        place[other], place[p] = at, to

    end = n
    while end:
        start = group[order[end - 1]]
        if end - start == 1:
            i = order[start]
            link[i] = i - 1
            p = _nearest(link, i - 1)
            if p >= 0:
                length[p] += length[i]
                old = group[p]
                last = ends[old] - 1
                if last > old:
                    move(p, last)
                    ends[old], group[p], ends[last] = last, last, last + 1
        else:
            members = order[start:end]
            size = length[members[0]]
            for i in members:
                link[i] = i - 1
            times: dict[int, int] = {}
            for i in members:
                p = _nearest(link, i - 1)
                if p >= 0:
                    times[p] = times.get(p, 0) + 1
            parts: dict[int, list[tuple[int, int]]] = {}
            for p, k in times.items():
                length[p] += k * size
                parts.setdefault(group[p], []).append((k, p))
            for old, moved in parts.items():
                if len(moved) > 1:
                    moved.sort(reverse=True)
                to = ends[old]
                before, upper = None, to
                for k, p in moved:
                    if before is not None and k != before:  # the part above is complete
                        for at in range(to, upper):
                            group[order[at]] = to
                        ends[to], upper = upper, to
                    to -= 1
                    move(p, to)
                    before = k
                for at in range(to, upper):
                    group[order[at]] = to
                ends[to] = upper
                if to > old:
                    ends[old] = to
        end = start
    return group, length


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The starts of all suffixes of whole numbers from 0, in lexicographic order; linear in their number.

    After the grouping, ranks are given out in ascending order: the members of a group stand in the order of the suffixes
    that follow their common prefix, all of which are smaller, so each suffix that has its rank sends those that it follows
    to the next free rank of their groups. The empty suffix begins.
    """
    symbols = np.asarray(symbols, np.int64)
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    group, length = _lyndon_groups(symbols)
    follower = np.arange(n) + np.array(length)
    by_follower = np.argsort(follower, kind="stable").tolist()
    begin = np.searchsorted(follower[by_follower], np.arange(n + 2)).tolist()
    free, ranked = list(range(n)), [0] * n
    s = n
    for rank in range(-1, n):
        if rank >= 0:
            s = ranked[rank]
        for p in by_follower[begin[s]:begin[s + 1]]:
            g = group[p]
            ranked[free[g]] = p
            free[g] += 1
    return np.array(ranked, np.int64)
