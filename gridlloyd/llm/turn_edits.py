"""Cheapest edits that bring a conversation into turn order, in linear space.

The order of roles is ``(s?(ua)+)?``, so what has been written so far is in one of four states: nothing, a
system turn, a user turn, an assistant turn. A step takes some rows from a state to a state. Each row is
kept, given another role, or deleted, after any inserted turns; each letter leads from a state to one
other state only, so the letters (the audit) and the states determine each other.

Two ways to different states after the same rows are never prefixes of each other: the last letter of
each takes a row. So which of two audits comes first is settled by the order of the states before, and a
vector of four costs with their order is all that has to be kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = range(4)
#: The state after a user or assistant turn is put in.
_ONWARD = (USER, USER, ASSISTANT, USER)
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "": {}}
_INITIALS = ("s", "u", "a", "")
CLEAN, MUST_GO, TRUNCATED = range(3)
# Costs of the edits.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
NEVER = 1 << 60
#: Turns to insert at the end, by state.
TAIL = ("", "II", "I", "")

#: From each state to each state: cost, and the place of the audit among those from the same state.
Step = tuple[tuple[tuple[int, int], ...], ...]


def code(initial: str, fault: int) -> int:
    """A row as a number below 12."""
    return 3 * (_INITIALS.index(initial) if initial in ("s", "u", "a") else 3) + fault


def _edits(row: int) -> list[list[tuple[int, str]]]:
    """The cheapest (cost, letters) from each state to each state over one row; of equal ones the ASCII-least."""
    initial, fault = _INITIALS[row // 3], row % 3
    table = [[(NEVER, "")] * 4 for _ in _STATES]
    for start in _STATES:
        at = start
        for inserted in range(3):  # a third one would come back to the same state
            extra = CUT_OFF if fault == TRUNCATED else 0
            ends = [(at, DELETE, "D")]
            if fault != MUST_GO:
                ends.append((_ONWARD[at], REROLE + extra, "R"))
                ends += [(_KEPT[initial][at], extra, "K")] if at in _KEPT[initial] else []
            for end, cost, letter in ends:
                table[start][end] = min(table[start][end], (INSERT * inserted + cost, "I" * inserted + letter))
            at = _ONWARD[at]
    return table


LETTERS = [[[letters for _, letters in row] for row in _edits(c)] for c in range(12)]
ROW_STEPS: list[Step] = [
    tuple(tuple((cost, sorted(x for _, x in row).index(letters)) for cost, letters in row) for row in _edits(c)) for c in range(12)]


def only(state: int) -> Step:
    """The vector of having arrived in one state."""
    return tuple((0, 0) if s == state else (NEVER, 0) for s in _STATES)


@lru_cache(maxsize=1 << 14)
def _moved(vector, step: Step):
    best = []
    for end in _STATES:
        best.append(min((vector[s][0] + step[s][end][0], vector[s][1], step[s][end][1]) for s in _STATES))
    order = sorted(set((rank, place) for _, rank, place in best))
    return tuple((min(cost, NEVER), order.index((rank, place))) for cost, rank, place in best)


def forward(vector, steps: Sequence[Step]):
    """Costs of reaching each state, with the order of their audits, after further steps."""
    base = 0
    for step in steps:
        vector = _moved(vector, step)
        least = min(c for c, _ in vector)
        if least:
            base += least
            vector = tuple((c - least if c < NEVER else c, r) for c, r in vector)
    return tuple((c + base if c < NEVER else c, r) for c, r in vector)


@lru_cache(maxsize=1 << 14)
def _back(costs, step: Step):
    return tuple(min(NEVER, min(step[s][end][0] + costs[end] for end in _STATES)) for s in _STATES)


def backward(costs, steps: Sequence[Step]):
    """Costs of going from each state through the steps to the end."""
    base = 0
    for step in reversed(steps):
        costs = _back(costs, step)
        least = min(costs)
        if 0 < least < NEVER:
            base += least
            costs = tuple(c - least if c < NEVER else c for c in costs)
    return tuple(c + base if c < NEVER else c for c in costs)


def crossing(vector, costs) -> int:
    """The state in which the cheapest ways meet; of several that with the ASCII-least audit."""
    return min(_STATES, key=lambda s: (vector[s][0] + costs[s], vector[s][1]))


def states(steps: Sequence[Step], start: int, end: int) -> list[int]:
    """The state after each step on the cheapest way from ``start`` to ``end``, ASCII-least in its audit.

    Costs from the front and from the back meet in the middle; the crossing splits the work in two.
    """
    out = [end] * len(steps)
    work = [(0, len(steps), start, end)]
    while work:
        low, high, a, b = work.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        target = tuple(0 if s == b else NEVER for s in _STATES)
        meet = crossing(forward(only(a), steps[low:middle]), backward(target, steps[middle:high]))
        out[middle - 1] = meet
        work += [(low, middle, a, meet), (middle, high, meet, b)]
    return out


def whole_step(rows: Sequence[int]) -> Step:
    """Many rows as one step."""
    steps = [ROW_STEPS[r] for r in rows]
    return tuple(forward(only(s), steps) for s in _STATES)


def best_end(vector) -> tuple[int, int]:
    """The state to end in and the cost with the turns inserted at the end."""
    tail = tuple(INSERT * len(t) for t in TAIL)
    end = crossing(vector, tail)
    return end, vector[end][0] + tail[end]


def letters(rows: Sequence[int], start: int, end: int) -> tuple[list[str], list[int]]:
    """The letters of each row, and the state before each, from ``start`` to ``end``."""
    after = states([ROW_STEPS[r] for r in rows], start, end)
    before = [start, *after[:-1]]
    return [LETTERS[r][a][b] for r, a, b in zip(rows, before, after)], before


def turns(edit: str, state: int) -> list[tuple[str, str]]:
    """What the letters of a row (or of the end) write: (letter, new role), deleted rows left out."""
    out = []
    for letter in edit:
        if letter == "D":
            continue
        state = _ONWARD[state] if letter != "K" else state
        out.append((letter, {USER: "user", ASSISTANT: "assistant"}.get(state, "")))
    return out
