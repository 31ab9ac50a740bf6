"""Cheapest repairs of a run of turns against the grammar (s?(ua)+)?, by Wagner-Fischer alignment.

A run is a string of codes, one a turn: the role's initial `s`, `u`, `a` or `x` (any other), in upper
case if the turn is truncated, or `d` for a turn that must go. What came before it is a state: `0`
nothing, `s` a system turn, `u` a user turn that waits for its answer, `a` a finished exchange.
"""

from __future__ import annotations

import os
from functools import lru_cache

INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
STATES = "0sua"
#: States in which a conversation may end.
FINAL = "0a"
#: Turns aligned at once; longer runs are composed of such pieces, which is exact.
PIECE = 8

_INFINITE = 1 << 40
#: A best repair for each state a run can end in: its cost and its edits' initials.
Ends = dict[str, tuple[int, str]]


def _targets(entry: str, length: int) -> list[str]:
    """Strings of this length that may follow `entry`: at most one without and one with a system turn."""
    if entry == "u":
        return [("au" * length)[:length]]
    plain = ("ua" * length)[:length]
    return [plain, "s" + plain[:-1]] if entry == "0" and length else [plain]


def _align(codes: str, target: str, budget: int) -> tuple[int, str] | None:
    """The cheapest alignment, ASCII-least among equals, if it costs at most `budget`.

    suffix[i][j] is the cost of turns i.. against target j.. . A cell is only filled inside Ukkonen's
    band: where the edits that its diagonal needs before and behind it still fit the budget.
    """
    n, length = len(codes), len(target)
    live = [0]
    for c in codes:
        live.append(live[-1] + (c != "d"))
    spare = budget - DELETE * (n - live[n])
    ends = length - live[n]

    def gap(offset: int) -> int:
        return INSERT * offset if offset > 0 else -DELETE * offset

    suffix = [[_INFINITE] * (length + 1) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row, code = suffix[i], codes[i] if i < n else ""
        for j in range(length, -1, -1):
            if gap(j - live[i]) + gap(ends - j + live[i]) > spare:
                continue
            if i == n and j == length:
                row[j] = 0
                continue
            best = _INFINITE
            if i < n:
                best = suffix[i + 1][j] + DELETE
                if j < length and code != "d":
                    best = min(best, suffix[i + 1][j + 1] + _match(code, target[j]))
            if j < length and target[j] != "s":
                best = min(best, row[j + 1] + INSERT)
            row[j] = best
    if suffix[0][0] > budget:
        return None
    i = j = 0
    edits = []
    while i < n or j < length:
        cost = suffix[i][j]
        if i < n and cost == suffix[i + 1][j] + DELETE:
            edits.append("D")
            i += 1
        elif j < length and target[j] != "s" and cost == suffix[i][j + 1] + INSERT:
            edits.append("I")
            j += 1
        else:
            edits.append("K" if codes[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return suffix[0][0], "".join(edits)


def _match(code: str, symbol: str) -> int:
    extra = TRUNCATED if code.isupper() else 0
    if code.lower() == symbol:
        return extra
    return _INFINITE if symbol == "s" else REROLE + extra


@lru_cache(maxsize=50_000)
def _piece(codes: str, entry: str) -> Ends:
    """Best repairs of a short run by the state they end in.

    Target lengths go outwards from the number of turns that may stay; a length is feasible while
    the edits it needs at least do not cost more than the incumbent of the state it ends in.
    """
    live = sum(c != "d" for c in codes)
    least = DELETE * (len(codes) - live)
    best: Ends = {}

    def try_length(length: int) -> None:
        for target in _targets(entry, length):
            end = target[-1] if target else entry
            found = _align(codes, target, best[end][0] if end in best else _INFINITE - 1)
            if found is not None and (end not in best or found < best[end]):
                best[end] = found

    def feasible(needed: int) -> bool:
        return any(end not in best or needed <= best[end][0] for end in "ua")

    length = live
    while feasible(least + INSERT * (length - live)):
        try_length(length)
        length += 1
    length = live - 1
    while length >= 0 and feasible(least + DELETE * (live - length)):
        try_length(length)
        length -= 1
    # ends that only one length has
    if entry in "0s":
        try_length(0)
    if entry == "0":
        try_length(1)
    return best


def follow(before: Ends, codes: str) -> Ends:
    """Best repairs of all that came before and then this run, by the state they end in.

    Equal costs with edits that start alike cannot differ only in insertions at the end, so the least
    string of a prefix is part of the least whole one.
    """
    for first in range(0, len(codes), PIECE):
        piece, after = codes[first : first + PIECE], {}
        for state, (cost, edits) in before.items():
            for end, (more, added) in _piece(piece, state).items():
                found = (cost + more, edits + added)
                if end not in after or found < after[end]:
                    after[end] = found
        before = after
    return before


def run_table(codes: str) -> dict[str, Ends]:
    """What a run does from every state that may come before it."""
    return {entry: follow({entry: (0, "")}, codes) for entry in STATES}


class Chain:
    """Runs of one conversation put together in order; what all candidates share is settled."""

    def __init__(self) -> None:
        self.settled: list[str] = []
        self.ends: Ends = {"0": (0, "")}

    def add(self, table: dict[str, Ends]) -> None:
        after: Ends = {}
        for state, (cost, edits) in self.ends.items():
            for end, (more, added) in table.get(state, {}).items():
                found = (cost + more, edits + added)
                if end not in after or found < after[end]:
                    after[end] = found
        shared = len(os.path.commonprefix([edits for _, edits in after.values()]))
        if shared:
            self.settled.append(next(iter(after.values()))[1][:shared])
        self.ends = {end: (cost, edits[shared:]) for end, (cost, edits) in after.items()}

    def best(self) -> tuple[int, str]:
        """Cost and edits of the whole conversation."""
        cost, edits = min(self.ends[end] for end in FINAL if end in self.ends)
        return cost, "".join(self.settled) + edits
