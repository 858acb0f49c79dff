"""Byte rules compiled to one minimal deterministic automaton held in transition arrays.

Rules are regular expressions over bytes: literals, ``\\`` escapes, ``[...]`` classes, groups,
``(?i:...)``, ``|``, ``?``, ``*``, ``+`` and ``{m}``, ``{m,}``, ``{m,n}``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_FOLD = {b: {b, b ^ 32} for b in range(256) if chr(b).isascii() and chr(b).isalpha()}


class _Nfa:
    """States are numbers; ``free`` has the moves without a byte, ``moves`` those with one of a set."""

    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.moves: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


class _Builder:
    """Recursive descent over one rule; every part adds states between an entry and an exit."""

    def __init__(self, nfa: _Nfa, rule: str):
        self.nfa, self.rule, self.at, self.fold = nfa, rule, 0, False

    def peek(self) -> str:
        return self.rule[self.at : self.at + 1]

    def choice(self, entry: int) -> int:
        ends = [self.sequence(entry)]
        while self.peek() == "|":
            self.at += 1
            ends.append(self.sequence(entry))
        out = self.nfa.state()
        for x in ends:
            self.nfa.free[x].append(out)
        return out

    def sequence(self, entry: int) -> int:
        at = self.nfa.state()
        self.nfa.free[entry].append(at)
        while self.peek() not in ("", "|", ")"):
            begin = self.at
            self.atom(self.nfa.state())  # once unattached, to see where the atom ends
            low, high = self.repeat()
            after = self.at
            for _ in range(low):
                at = self.again(begin, at)
            if high is None:
                loop = self.nfa.state()
                self.nfa.free[at].append(loop)
                self.nfa.free[self.again(begin, loop)].append(loop)
                at = loop
            else:
                out = self.nfa.state()
                self.nfa.free[at].append(out)
                for _ in range(high - low):
                    at = self.again(begin, at)
                    self.nfa.free[at].append(out)
                at = out
            self.at = after
        return at

    def again(self, begin: int, entry: int) -> int:
        self.at = begin
        return self.atom(entry)

    def repeat(self) -> tuple[int, int | None]:
        c = self.peek()
        if c in ("?", "*", "+") and c:
            self.at += 1
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        if c == "{":
            stop = self.rule.index("}", self.at)
            low, comma, high = self.rule[self.at + 1 : stop].partition(",")
            self.at = stop + 1
            return int(low), int(high) if high else (None if comma else int(low))
        return 1, 1

    def atom(self, entry: int) -> int:
        c = self.peek()
        if c == "(":
            fold = self.fold
            self.at += 1
            if self.rule.startswith("?i:", self.at):
                self.at += 3
                self.fold = True
            out = self.choice(entry)
            self.fold = fold
            self.at += 1
            return out
        accepted = self.bracket() if c == "[" else {self.byte()}
        if self.fold:
            accepted = set().union(*(_FOLD.get(b, {b}) for b in accepted))
        out = self.nfa.state()
        self.nfa.moves[entry].append((frozenset(accepted), out))
        return out

    def byte(self) -> int:
        if self.peek() == "\\":
            self.at += 1
            if self.peek() == "x":
                self.at += 3
                return int(self.rule[self.at - 2 : self.at], 16)
        self.at += 1
        return ord(self.rule[self.at - 1])

    def bracket(self) -> set[int]:
        self.at += 1
        negated = self.peek() == "^"
        self.at += negated
        out: set[int] = set()
        while self.peek() != "]":
            low = high = self.byte()
            if self.peek() == "-" and self.rule[self.at + 1] != "]":
                self.at += 1
                high = self.byte()
            out.update(range(low, high + 1))
        self.at += 1
        return set(range(256)) - out if negated else out


class Automaton:
    """``step[state, byte]`` and ``accept[state]``, a bit for each rule; state 0 starts, state 1 is dead."""

    def __init__(self, step: np.ndarray, accept: np.ndarray):
        self.step, self.accept = step, accept
        self._rows: tuple[list[list[int]], list[int]] | None = None

    def rows(self) -> tuple[list[list[int]], list[int]]:
        """The arrays as lists, which a loop over bytes reads faster."""
        if self._rows is None:
            self._rows = self.step.tolist(), self.accept.tolist()
        return self._rows

    def begins(self, data: bytes) -> list[tuple[int, int]]:
        """(place, rules) of every byte at which a match begins, in order; for a ``backward`` automaton."""
        step, accept = self.rows()
        state, found = 0, []
        for k in range(len(data) - 1, -1, -1):
            state = step[state][data[k]]
            if accept[state]:
                found.append((k, accept[state]))
        return found[::-1]

    def longest(self, data: bytes, start: int) -> int:
        """End of the longest match that starts at ``start``, or -1."""
        state, best = 0, -1
        step, accept = self.rows()
        for k in range(start, len(data)):
            state = step[state][data[k]]
            if state == 1:
                break
            if accept[state]:
                best = k + 1
        return best


def _turned(nfa: _Nfa, ends: list[int]) -> _Nfa:
    """The moves of ``nfa`` the other way round; its last state leads to each of ``ends``."""
    out = _Nfa()
    for _ in range(len(nfa.free) + 1):
        out.state()
    for x in range(len(nfa.free)):
        for y in nfa.free[x]:
            out.free[y].append(x)
        for accepted, y in nfa.moves[x]:
            out.moves[y].append((accepted, x))
    out.free[-1] = list(ends)
    return out


def compile_rules(rules: Sequence[str], anywhere: bool, backward: bool = False) -> Automaton:
    """Subset construction, then minimisation by splitting classes of states until they are stable.

    With ``anywhere``, a match may start at every byte, so one pass over a text tells which rules match in it.
    Then a rule is done at the end of its shortest match, which keeps the number of states small.  A ``backward``
    automaton reads a text from its end and accepts wherever a match begins, be it short or long.
    """
    nfa = _Nfa()
    root = nfa.state()
    final: dict[int, int] = {}
    begins: dict[int, int] = {}
    for k, rule in enumerate(rules):
        builder, entry = _Builder(nfa, rule), nfa.state()
        nfa.free[root].append(entry)
        begins[entry] = 1 << k
        final[builder.choice(entry)] = 1 << k
        if builder.at != len(rule):
            raise ValueError(f"rule {rule!r} cannot be read from position {builder.at} on")
    if backward:
        nfa.free[root] = []
        nfa = _turned(nfa, list(final))
        root, final = len(nfa.free) - 1, begins
    elif anywhere:
        for x in range(len(nfa.moves)):
            if final.keys() & nfa.closure([x]):
                nfa.moves[x] = []
    start = nfa.closure([root])
    known = {start: 0, frozenset(): 1}
    todo, rows = [start], {1: np.full(256, 0 if anywhere else 1)}
    while todo:
        states = todo.pop()
        targets: list[set] = [set() for _ in range(256)]
        for x in states:
            for accepted, y in nfa.moves[x]:
                for b in accepted:
                    targets[b].add(y)
        row, seen = np.zeros(256, np.int64), {}
        for b, reached in enumerate(targets):
            key = frozenset(reached)
            if key not in seen:
                whole = nfa.closure(key)
                if anywhere:
                    whole |= start
                if whole not in known:
                    known[whole] = len(known)
                    todo.append(whole)
                seen[key] = known[whole]
            row[b] = seen[key]
        rows[known[states]] = row
    step = np.stack([rows[k] for k in range(len(known))])
    accept = np.zeros(len(known), np.int64)
    for states, k in known.items():
        for x in states:
            accept[k] |= final.get(x, 0)
    return _minimal(step, accept)


def _minimal(step: np.ndarray, accept: np.ndarray) -> Automaton:
    group = np.unique(accept, return_inverse=True)[1]
    while True:
        signature = np.column_stack([group, group[step]])
        finer = np.unique(signature, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    # State 0 stays the start; the dead state, where it is a state of its own, is 1.
    order = [group[0]] + ([group[1]] if group[1] != group[0] else [])
    order += [g for g in range(group.max() + 1) if g not in order]
    name = np.empty(len(order), np.int64)
    name[order] = np.arange(len(order))
    first = np.array([np.flatnonzero(group == g)[0] for g in order])
    return Automaton(name[group[step[first]]].astype(np.int32), accept[first])
