"""Persistent edit strings and the cheapest repair of a run of turns.

Edit strings grow at their end and share their beginnings: a string is a node
with its parent, its last edit, its length, a rolling hash of the whole string
and its ancestors at distances 1, 2, 4, ... Two strings of equal cost are
compared by their longest common prefix, searched through those ancestors by
hash; equal hashes are verified edit by edit.

The repair reads turns from left to right. States say what the kept turns'
role initials may go on with: START (none yet), SYSTEM (after the one leading
s), USER and ASSISTANT; START and ASSISTANT may end. Between two turns the
strings of different states end in a turn's edit and hold equally many of them,
so none is a prefix of another, and the lesser one stays the lesser whatever
follows: one string per state is enough.
"""

from __future__ import annotations

from functools import cmp_to_key

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
NEVER = 1 << 60
# Fixed values of the repair: what an edit costs, and what a kept truncated turn costs more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# Inserts that take a state to the end of a well-formed conversation.
ENDING = ("", "II", "I", "")
SOUND, BLANK, DUPLICATE, CUT = range(4)      # a turn's fault
_MOD = (1 << 61) - 1
_BASE = 1_000_003


class Edits:
    """Shared edit strings; node 0 is the empty one."""

    def __init__(self):
        self.edit, self.depth, self.hash, self.up = [""], [0], [0], [()]

    def add(self, node: int, edit: str) -> int:
        ancestors, k, at = [node], 0, self.up[node]
        while k < len(at):
            nearer = at[k]
            ancestors.append(nearer)
            k += 1
            at = self.up[nearer]
        self.edit.append(edit)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(edit)) % _MOD)
        self.up.append(tuple(ancestors))
        return len(self.edit) - 1

    def same(self, a: int, b: int) -> bool:
        """Whether two strings of one length are equal: by hash, then edit by edit."""
        if a == b:
            return True
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def _lifted(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            node = self.up[node][(self.depth[node] - depth).bit_length() - 1]
        return node

    def compare(self, a: int, b: int) -> int:
        """Below 0 if a's string is the lesser, over 0 if b's is, 0 if equal."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._lifted(a, depth), self._lifted(b, depth)
        if self.same(x, y):
            return self.depth[a] - self.depth[b]
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and not self.same(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
        return -1 if self.edit[x] < self.edit[y] else 1

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def run_edits(initials: list[str], faults: list[int], start: int = START) -> tuple[list[int], list[int], list[str]]:
    """The cheapest edits of a run of turns entered in state ``start``: for every
    state that it may be left in, the cost (``NEVER``: it cannot), the rank of its
    edit string among the states', and the string. Inserts stand before turns."""
    log = Edits()
    cost, node = [NEVER] * STATES, [0] * STATES
    cost[start] = 0
    for initial, fault in zip(initials, faults):
        new_cost, new_node = [NEVER] * STATES, [0] * STATES
        picks: list[tuple[int, int, int, str]] = []          # state after, cost, node before, edits
        for s in range(STATES):                              # (an insert before a deleted turn is never least)
            if cost[s] < NEVER:
                picks.append((s, cost[s] + DELETE, node[s], "D"))
        if fault != BLANK and fault != DUPLICATE:
            more = TRUNCATED if fault == CUT else 0
            for s in range(STATES):
                if cost[s] >= NEVER:
                    continue
                at, spent, inserts = s, cost[s] + more, ""
                while True:
                    to = ASSISTANT if at == USER else USER
                    if initial == ("a" if at == USER else "u"):
                        picks.append((to, spent, node[s], inserts + "K"))
                    else:
                        picks.append((to, spent + REROLE, node[s], inserts + "R"))
                    if at == START and initial == "s":
                        picks.append((SYSTEM, spent, node[s], inserts + "K"))
                    if inserts and (at == ASSISTANT or s in (USER, ASSISTANT)):
                        break                                # further inserts come round to a state passed
                    at, spent, inserts = to, spent + INSERT, inserts + "I"
        best: list[list[tuple[int, str]]] = [[] for _ in range(STATES)]
        for to, spent, before, edits in picks:
            if spent < new_cost[to]:
                new_cost[to], best[to] = spent, [(before, edits)]
            elif spent == new_cost[to]:
                best[to].append((before, edits))
        for to in range(STATES):
            for before, edits in best[to]:
                for e in edits:
                    before = log.add(before, e)
                if not new_node[to] or log.compare(before, new_node[to]) < 0:
                    new_node[to] = before
        cost, node = new_cost, new_node
    ranked = sorted((s for s in range(STATES) if cost[s] < NEVER), key=cmp_to_key(lambda a, b: log.compare(node[a], node[b])))
    return cost, [ranked.index(s) if s in ranked else STATES for s in range(STATES)], [log.text(node[s]) for s in range(STATES)]


def ended(cost: list[int], rank: list[int]) -> tuple[int, int]:
    """Cost of the whole repair and the state in which the last turn leaves it."""
    total = [cost[s] + INSERT * len(ENDING[s]) for s in range(STATES)]
    end = min(range(STATES), key=lambda s: (total[s], rank[s]))
    return total[end], end


def chained(runs: list[tuple[list[int], list[int]]]) -> tuple[int, list[int]]:
    """Cost of the repair of consecutive runs and the state at every bound.

    A run is given by its costs and ranks, ``STATES`` for every state it may be
    entered in, one after the other."""
    cost, rank = [0] + [NEVER] * (STATES - 1), [0] * STATES
    came: list[list[int]] = []
    for costs, ranks in runs:
        new_cost, source = [NEVER] * STATES, [START] * STATES
        for to in range(STATES):
            new_cost[to], _, source[to] = min((min(cost[s] + costs[STATES * s + to], NEVER), rank[s], s) for s in range(STATES))
        order = sorted(range(STATES), key=lambda to: (rank[source[to]], ranks[STATES * source[to] + to]))
        cost, rank = new_cost, [order.index(to) for to in range(STATES)]
        came.append(source)
    total, state = ended(cost, rank)
    states = [state]
    for source in reversed(came):
        state = source[state]
        states.append(state)
    return total, states[::-1]


def applied(edits: str, roles: list[str], texts: list[str], start: int = START) -> list[tuple[str, str]]:
    """The turns that ``edits`` make of a run entered in state ``start``."""
    out, at, i = [], start, 0
    for e in edits:
        to = ASSISTANT if at == USER else USER
        if e == "D":
            i += 1
            continue
        if e == "K":
            out.append((roles[i], texts[i]))
            to = SYSTEM if at == START and roles[i][:1] == "s" else to
        else:
            out.append(("assistant" if to == ASSISTANT else "user", texts[i] if e == "R" else ""))
        i += e != "I"
        at = to
    return out
