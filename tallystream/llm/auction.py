"""Cheapest edits of a conversation by the auction algorithm for shortest paths.

The lattice has a node for each place between turns and each state of the form
``(s?(ua)+)?``: nothing yet, behind the system turn, behind a user turn, behind an assistant turn.
Costs are integers. Every node has a price, at most the cost of an arc plus the price of where
it leads; a path grows from the start along arcs that meet this exactly, and shrinks, raising
the price of its last node, where none does. When it reaches the end, every shortest path
consists of such tight arcs, and the least one is traced among them letter by letter.
"""

from __future__ import annotations

from collections.abc import Sequence

STATES = 4
START, SYSTEM, USER, ASSISTANT = range(STATES)
#: No way there. Larger than any cost.
NONE = 1 << 50
#: What a whole conversation may end in, at no cost.
ENDS = (0, NONE, NONE, 0)

INITIALS = "sua"
OTHER = 3
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
UNFINISHED = 5

#: State behind a turn of each initial, and behind the turn that the form asks for.
_NEXT = (
    {"s": SYSTEM, "u": USER},
    {"u": USER},
    {"a": ASSISTANT},
    {"u": USER},
)
_WANTED = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}

Arc = tuple[str, int, int]


def turn_code(initial: str, fault: int) -> int:
    """One byte for what the lattice needs to know of a turn."""
    kind = INITIALS.index(initial) if initial and initial in INITIALS else OTHER
    return kind * STATES + fault


def _arcs(kind: int, fault: int, state: int) -> tuple[Arc, ...]:
    """(letter, step to the node, cost) by letter."""
    insert = ("I", _WANTED[state] - state, INSERT)
    arcs = [("D", STATES, DELETE), insert]
    if fault in (SOUND, TRUNCATED):
        more = UNFINISHED if fault == TRUNCATED else 0
        behind = _NEXT[state].get(INITIALS[kind]) if kind != OTHER else None
        if behind is not None:
            arcs.append(("K", STATES + behind - state, KEEP + more))
        arcs.append(("R", STATES + _WANTED[state] - state, REROLE + more))
    return tuple(arcs)


_ARCS = [[_arcs(code // STATES, code % STATES, s) for s in range(STATES)] for code in range(4 * STATES)]
_LEAST = [0, DELETE, DELETE, DELETE]  # what a turn of each fault costs at least


class Lattice:
    """A stretch of turns, and the cost ``ends`` of leaving it in each state."""

    def __init__(self, codes: bytes, ends: Sequence[int] = ENDS) -> None:
        n = len(codes)
        self.sink = STATES * (n + 1)
        self.arcs = [_ARCS[code][s] for code in codes for s in range(STATES)]
        for s, cost in enumerate(ends):
            leave = (("", self.sink - STATES * n - s, cost),) if cost < NONE else ()
            self.arcs.append((("I", _WANTED[s] - s, INSERT), *leave))
        self.price = self._bounds(codes, ends)

    def _bounds(self, codes: bytes, ends: Sequence[int]) -> list[int]:
        """Prices to begin with: what the turns behind a node cost at least; none without a way out."""
        open_end = min(ends[USER], ends[ASSISTANT]) < NONE
        rest = min(ends)
        keeps = False  # a turn that may be kept as the system turn comes
        columns = []
        for code in (None, *reversed(codes)):
            if code is not None:
                rest += _LEAST[code % STATES]
                keeps |= code // STATES == 0 and code % STATES in (SOUND, TRUNCATED)
            alive = (
                open_end or ends[START] < NONE or (keeps and ends[SYSTEM] < NONE),
                open_end or ends[SYSTEM] < NONE,
                open_end,
                open_end,
            )
            columns.append([rest if a else NONE for a in alive])
        return [p for column in reversed(columns) for p in column] + [0]

    def cost(self, state: int) -> int:
        """Cost of the cheapest path from the first node of ``state``; prices stay for the next one."""
        price, arcs, sink = self.price, self.arcs, self.sink
        if price[state] >= NONE:
            return NONE
        path = [state]
        while True:
            node = path[-1]
            best, to = NONE, -1
            for _, step, cost in arcs[node]:
                cost += price[node + step]
                if cost < best:
                    best, to = cost, node + step
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            elif to == sink:
                return price[state]
            else:
                path.append(to)

    def audit(self, state: int) -> tuple[str, int, int]:
        """Letters of the cheapest path (the least of them in ASCII), the state it ends in, its cost."""
        total = self.cost(state)
        if total >= NONE:
            return "", -1, NONE
        price, arcs, sink = self.price, self.arcs, self.sink
        dead = set()  # tight arcs may lead to nodes whose price is still too low
        path, letters = [state], []
        while True:
            node = path[-1]
            for letter, step, cost in arcs[node]:
                to = node + step
                if price[node] == cost + price[to] and to not in dead:
                    if to == sink:
                        return "".join(letters), node % STATES, total
                    path.append(to)
                    letters.append(letter)
                    break
            else:
                dead.add(path.pop())
                letters.pop()


def matrix(codes: bytes) -> list[int]:
    """Cost of crossing a stretch, from each state (rows) to each state."""
    costs = [[NONE] * STATES for _ in range(STATES)]
    for end in range(STATES):
        lattice = Lattice(codes, [0 if s == end else NONE for s in range(STATES)])
        for state in range(STATES):
            costs[state][end] = lattice.cost(state)
    return [c for row in costs for c in row]


def paid(audit: str, codes: bytes) -> int:
    """What the edits of a stretch cost."""
    total, turns = 0, iter(codes)
    for letter in audit:
        total += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[letter]
        if letter != "I" and next(turns) % STATES == TRUNCATED and letter != "D":
            total += UNFINISHED
    return total


def apply(audit: str, state: int, roles: Sequence[str], texts: Sequence[str]) -> list[dict[str, str]]:
    """The turns that the edits leave, entered in ``state``."""
    turns = []
    i = 0
    for letter in audit:
        wanted = _WANTED[state]
        if letter == "I":
            turns.append({"role": ROLES[wanted], "text": ""})
            state = wanted
            continue
        if letter == "K":
            turns.append({"role": roles[i], "text": texts[i]})
            state = _NEXT[state][roles[i][0]]
        elif letter == "R":
            turns.append({"role": ROLES[wanted], "text": texts[i]})
            state = wanted
        i += 1
    return turns
