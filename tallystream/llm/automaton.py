"""A suffix automaton over several sequences of numbers."""

from __future__ import annotations

from collections.abc import Sequence


class SuffixAutomaton:
    """Accepts every run of every sequence added; at most two states per number."""

    def __init__(self):
        self.link = [-1]
        self.length = [0]
        self.next: list[dict[int, int]] = [{}]

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(follow)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for the shorter runs that end in it by way of ``p``."""
        length, link, follow = self.length, self.link, self.next
        copy = self._state(length[p] + 1, link[q], dict(follow[q]))
        while p != -1 and follow[p].get(c) == q:
            follow[p][c] = copy
            p = link[p]
        link[q] = copy
        return copy

    def add(self, sequence: Sequence[int]) -> None:
        length, link, follow = self.length, self.link, self.next
        last = 0
        for c in sequence:
            q = follow[last].get(c)
            if q is not None:  # known from a sequence added before
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
                continue
            new = self._state(length[last] + 1, 0, {})
            p = last
            while p != -1 and c not in follow[p]:
                follow[p][c] = new
                p = link[p]
            if p != -1:
                q = follow[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = new

    def matches(self, sequence: Sequence[int]) -> list[int]:
        """Matching statistics: for each place, the longest run ending there that some sequence has."""
        length, link, follow = self.length, self.link, self.next
        state, run, out = 0, 0, []
        for c in sequence:
            q = follow[state].get(c)
            while q is None and state:
                state = link[state]
                run = length[state]
                q = follow[state].get(c)
            if q is None:
                run = 0
            else:
                state = q
                run += 1
            out.append(run)
        return out
