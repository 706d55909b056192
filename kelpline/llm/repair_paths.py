"""Cheapest repairs of a sequence of roles: shortest paths by Dial's bucket queue, and the walk along tight arcs.

A node is a place before a row and a state: 0 nothing yet, 1 after a system row, 2 after a user row, 3 after an assistant row. Only 0 and 3 may
end a conversation, so that the initials kept are (s?(ua)+)?. A row is a code: 0 to 3 for the initial s, u, a or another,
plus 4 if its text is truncated, or 8 if it has to be deleted.
"""

from __future__ import annotations

from functools import lru_cache

# Costs of the edits, as the contract has them
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = "sua"
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant row that is inserted, or got by a new role.
NEXT = (USER, USER, ASSISTANT, USER)
#: The state after a row of initial s, u or a that is kept; None if it can't be.
KEPT = {START: (SYSTEM, USER, None), SYSTEM: (None, USER, None), USER: (None, None, ASSISTANT), ASSISTANT: (None, USER, None)}
FAR = 1 << 40
GOAL = (0, FAR, FAR, 0)


def _arcs(code: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and new state of the edits of a row, by letter."""
    out = [("D", DELETE, state)]
    if code < 8:
        role, more = code % 4, TRUNCATED if code >= 4 else 0
        if role < 3 and KEPT[state][role] is not None:
            out.append(("K", more, KEPT[state][role]))
        out.append(("R", REROLE + more, NEXT[state]))
    return out


_ARCS = [[_arcs(code, state) for state in range(4)] for code in range(12)]
#: For each code and state after the row: (cost, state before it).
_BACK = [[[(cost, s) for s in range(4) for _, cost, to in _ARCS[code][s] if to == t] for t in range(4)] for code in range(12)]
_INSERTED = [[s for s in range(4) if NEXT[s] == t] for t in range(4)]


def distances(codes: bytes, end: tuple[int, ...]) -> list[list[int]]:
    """The least cost from each node to the end, where state s still costs end[s]; FAR if there is no way."""
    n, least = len(codes), min(end)
    out = [[FAR] * 4 for _ in range(n + 1)]
    buckets: list[list[tuple[int, int]]] = []

    def meet(d: int, i: int, s: int) -> None:
        if d < out[i][s]:
            out[i][s] = d
            while len(buckets) <= d:
                buckets.append([])
            buckets[d].append((i, s))

    for s in range(4):
        if end[s] < FAR:
            meet(end[s] - least, n, s)
    d = 0
    while d < len(buckets):
        for i, s in buckets[d]:  # all arcs cost something but K, which leads to an earlier place of the same bucket
            if out[i][s] == d:
                for before in _INSERTED[s]:
                    meet(d + INSERT, i, before)
                if i:
                    for cost, before in _BACK[codes[i - 1]][s]:
                        meet(d + cost, i - 1, before)
        buckets[d] = []
        d += 1
    return [[x + least if x < FAR else FAR for x in row] for row in out]


@lru_cache(1 << 14)
def matrix(codes: bytes) -> tuple[int, ...]:
    """The least cost from each state before the rows to each state after them, row by row."""
    ends = [distances(codes, tuple(0 if s == e else FAR for s in range(4)))[0] for e in range(4)]
    return tuple(ends[e][s] for s in range(4) for e in range(4))


def combined(a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
    """The matrix of the rows of a and then those of b."""
    return tuple(min(FAR, *(a[4 * s + m] + b[4 * m + e] for m in range(4))) for s in range(4) for e in range(4))


def before(a: tuple[int, ...], end: tuple[int, ...]) -> tuple[int, ...]:
    """The distances before the rows of matrix a, given those after them."""
    return tuple(min(FAR, *(a[4 * s + e] + end[e] for e in range(4))) for s in range(4))


@lru_cache(1 << 14)
def walk(codes: bytes, start: int, end: tuple[int, ...], last: bool) -> tuple[str, int]:
    """The letters of the least cheapest edits from `start`, and the state after the rows.

    What is inserted behind the rows belongs to the rows that follow, and to these only if they are the last.
    """
    dist = distances(codes, end)
    letters, i, s = [], 0, start
    while i < len(codes) or (last and dist[i][s] > 0):
        arcs = [("I", INSERT, NEXT[s], i)] + ([(x, cost, to, i + 1) for x, cost, to in _ARCS[codes[i]][s]] if i < len(codes) else [])
        letter, _, s, i = min((x, cost, to, at) for x, cost, to, at in arcs if cost + dist[at][to] == dist[i][s])
        letters.append(letter)
    return "".join(letters), s


def cost_of(letters: str, codes: bytes) -> int:
    out, i = 0, 0
    for x in letters:
        if x == "I":
            out += INSERT
            continue
        out += DELETE if x == "D" else (REROLE if x == "R" else 0) + (TRUNCATED if codes[i] >= 4 else 0)
        i += 1
    return out


def edited(letters: str, start: int, roles: list[str], texts: list[str]) -> list[tuple[str, str | None, str | None]]:
    """Each edit's letter with the role and text that it leaves; nulls for a deletion."""
    out, i, s = [], 0, start
    for x in letters:
        if x == "D":
            out.append((x, None, None))
        elif x == "K":
            s = KEPT[s][ROLES.index(roles[i][0])]
            out.append((x, roles[i], texts[i]))
        else:
            s = NEXT[s]
            out.append((x, "user" if s == USER else "assistant", texts[i] if x == "R" else ""))
        i += x != "I"
    return out
