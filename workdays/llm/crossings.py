"""Cheapest edit strings over four states, found by divide and conquer in linear space.

An *item* (a row, or a block of rows) maps each of four states to each with (cost, key) or None.
Keys of one start state order the edit strings behind them; strings over whole items are
prefix-free, so two different strings compare by their first differing item. Forward vectors hold,
for each state, the least cost from the start and the place of its string among the four;
backward vectors hold costs. They meet in the middle of the items: among the states with the least
sum, the one whose string comes first is the crossing, and both halves are solved between their
ends. Only vectors and the crossings are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

STATES = 4
# Row codes: a role (0 system, 1 user, 2 assistant, 3 any other) plus 4 * a fault.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
SOUND, TRUNCATED, DOOMED = range(3)
# State: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. The accepted role strings
# are (s?(ua)+)?, so one role may be put in at each state, and the strings end in 0 or 3.
NEXT = (2, 2, 3, 2)
PUT = (USER, USER, ASSISTANT, USER)
ENDS = (0, 3)

Item = Sequence[Sequence["tuple | None"]]


class Costs:
    """Costs of the edits; ``truncated`` is added to an undeleted truncated row."""

    def __init__(self, keep: int = 0, rerole: int = 1, delete: int = 2, insert: int = 5, truncated: int = 5):
        if min(keep, rerole, delete, truncated) < 0 or insert <= 0:
            raise ValueError("an insertion must cost something, the other edits no less than nothing")
        self.keep, self.rerole, self.delete, self.insert, self.truncated = keep, rerole, delete, insert, truncated
        self.items = [self._item(code) for code in range(12)]
        # What it takes to end from each state: cheapest insertions.
        self.ends = [min((k * insert, "I" * k) for k in range(3) if _after(q, k) in ENDS) for q in range(STATES)]

    def _item(self, code: int) -> list:
        role, fault = code % 4, code // 4
        item: list = [[None] * STATES for _ in range(STATES)]
        for q in range(STATES):
            for put in range(3):  # a third insertion comes back to a state that the first one reached
                at = _after(q, put)
                ways = [(self.delete, "D", at)]
                if fault != DOOMED:
                    extra = self.truncated if fault == TRUNCATED else 0
                    ways.append((self.rerole + extra, "R", NEXT[at]))
                    if role == PUT[at]:
                        ways.append((self.keep + extra, "K", NEXT[at]))
                    if role == SYSTEM and at == 0:
                        ways.append((self.keep + extra, "K", 1))
                for cost, letter, to in ways:
                    way = (cost + put * self.insert, "I" * put + letter)
                    if item[q][to] is None or way < item[q][to]:
                        item[q][to] = way
        return item


def _after(q: int, put: int) -> int:
    for _ in range(put):
        q = NEXT[q]
    return q


def forward(items: Sequence[Item], start: int) -> list:
    """(cost, place of its string) of each state behind ``items``, or None."""
    at: list = [None] * STATES
    at[start] = (0, 0)
    for item in items:
        ways: list = [None] * STATES
        for q in range(STATES):
            if at[q] is not None:
                cost, place = at[q]
                for to, step in enumerate(item[q]):
                    if step is not None:
                        way = (cost + step[0], place, step[1])
                        if ways[to] is None or way < ways[to]:
                            ways[to] = way
        order = sorted(w[1:] for w in ways if w is not None)
        at = [None if w is None else (w[0], order.index(w[1:])) for w in ways]
    return at


def backward(items: Sequence[Item], end: int) -> list:
    """Least cost from each state through ``items`` to ``end``, or None."""
    at: list = [None] * STATES
    at[end] = 0
    for item in reversed(items):
        at = [
            min((s[0] + c for s, c in zip(item[q], at, strict=True) if s is not None and c is not None), default=None)
            for q in range(STATES)
        ]
    return at


def last_state(items: Sequence[Item], start: int, ends: Sequence[tuple[int, str]]) -> tuple[int, int]:
    """(whole cost, state behind the items) of the cheapest way, ties by the least edit string."""
    found = forward(items, start)
    cost, _, state = min((f[0] + ends[q][0], f[1], q) for q, f in enumerate(found) if f is not None)
    return cost, state


def crossings(items: Sequence[Item], start: int, end: int) -> list[int]:
    """State behind each item of the cheapest, then least, way from ``start`` to ``end``."""
    if len(items) <= 1:
        return [end] * len(items)
    half = len(items) // 2
    there, back = forward(items[:half], start), backward(items[half:], end)
    _, _, met = min((f[0] + b, f[1], q) for q, (f, b) in enumerate(zip(there, back, strict=True)) if f is not None and b is not None)
    return crossings(items[:half], start, met) + crossings(items[half:], met, end)


def transfer(items: Sequence[Item]) -> list[list]:
    """The items as one: (cost, place among the strings of the same start) between all states."""
    return [forward(items, q) for q in range(STATES)]


def edits(codes: bytes, costs: Costs, start: int, end: int) -> list[tuple[int, str]]:
    """(cost, edit string) of each row between two states."""
    items, q, out = [costs.items[c] for c in codes], start, []
    for item, to in zip(items, crossings(items, start, end), strict=True):
        out.append(item[q][to])
        q = to
    return out
