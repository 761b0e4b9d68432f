"""Lyndon arrays by the grouping phase of Baier's suffix sorter, and the runs they hold.

A group holds the suffixes that begin with the same Lyndon word, and groups stand in
lexicographic order. They are taken from the highest down; each suffix lends its word to the
nearest suffix before it in a lower group, which moves to a group of its own right behind
the one it leaves. When a group is taken, its word is the longest Lyndon word that begins at
each of its suffixes. Everything is linear in the number of letters.
"""

from __future__ import annotations

import numpy as np


def lyndon_array(letters: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place; the end is smaller than any letter."""
    n = len(letters)
    _, rank, size = np.unique(letters, return_inverse=True, return_counts=True)
    first = np.cumsum(size) - size
    order = np.argsort(rank, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    group = first[rank].tolist()  # a group is named by where it begins in `order`
    order, place = order.tolist(), place.tolist()
    members, width = [0] * n, [1] * n
    for begin, count in zip(first.tolist(), size.tolist(), strict=True):
        members[begin] = count
    before = [-1] * n  # nearest earlier suffix of a lower group, once a suffix is taken
    longest = [0] * n

    def part_off(begin: int, movers: list[int], more: int) -> None:
        """Move suffixes of one group behind its others; their word grows by ``more`` letters."""
        rest = members[begin] - len(movers)
        if not rest:
            width[begin] += more
            return
        new = begin + rest
        at = new + len(movers)
        for s in movers:
            at -= 1
            other, hole = order[at], place[s]
            order[at], order[hole] = s, other
            place[s], place[other] = at, hole
            group[s] = new
        members[begin], members[new] = rest, len(movers)
        width[new] = width[begin] + more

    end = n
    while end:
        begin = group[order[end - 1]]
        w = width[begin]
        if end - begin == 1:
            s = order[begin]
            longest[s] = w
            p = s - 1
            while p >= 0 and group[p] >= begin:
                p = before[p]
            before[s] = p
            if p >= 0:
                part_off(group[p], [p], w)
        else:
            lends: dict[int, int] = {}
            for s in sorted(order[begin:end]):
                longest[s] = w
                p = s - 1
                while p >= 0 and group[p] >= begin:
                    p = before[p]
                before[s] = p
                if p >= 0:
                    lends[p] = lends.get(p, 0) + 1
            times: dict[int, dict[int, list[int]]] = {}
            for p, count in lends.items():
                times.setdefault(count, {}).setdefault(group[p], []).append(p)
            for count in sorted(times, reverse=True):
                for g, movers in times[count].items():
                    part_off(g, movers, count * w)
        end = begin
    return np.array(longest, np.int64)


def runs(letters: np.ndarray, exponent: int = 2, shortest: int = 2) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``exponent`` periods and ``shortest`` letters.

    ``letters`` are numbers from 1; 0 parts sequences, and no run holds it. By the runs theorem
    a run's primitive root is a longest Lyndon word in one of the two orders of the alphabet,
    at each of its places within the run. So every run shows as ``exponent - 1`` equal lengths,
    each one period behind the other, and is found by extending one of them to both sides.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    found = set()
    text = letters.tolist()
    n = len(text)
    for flipped in (False, True):
        order = np.where(letters > 0, letters.max(initial=0) + 1 - letters, 0) if flipped else letters
        period = lyndon_array(order)
        at = np.flatnonzero(letters > 0)
        for k in range(1, exponent - 1):
            again = at + k * period[at]
            at = at[again < n]
            at = at[period[at + k * period[at]] == period[at]]
        at = at[at + (exponent - 1) * period[at] <= n]
        reached: dict[int, int] = {}  # by period: where the last run found ends
        for s, p in zip(at.tolist(), period[at].tolist(), strict=True):
            if s < reached.get(p, 0):
                continue
            right = s
            while right + p < n and text[right] == text[right + p]:
                right += 1
            left = s
            while left and text[left - 1] == text[left - 1 + p]:
                left -= 1
            length = right + p - left
            if length >= max(shortest, exponent * p):
                reached[p] = right
                found.add((left, length, p))
    return sorted(found, key=lambda r: (r[0], r[2]))
