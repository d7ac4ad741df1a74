"""Rule regexes compiled into one deterministic automaton over bytes.

Each rule becomes a nondeterministic automaton (Thompson's construction). Subset
construction runs over all rules side by side: a state holds, per rule, the sets
of positions reached from each start that is still alive, the earliest start first.
Sets that an earlier start has reached as well are left out, so there are finitely
many. As soon as the earliest start accepts, later ones are dropped, and no new ones
begin until it dies: the transition on which it dies reports the rule, and the byte
is read anew as a start. That is the leftmost, longest, non-overlapping match.

States that report and move alike are merged (partition refinement), bytes that no
state tells apart share a column, and what remains are two arrays: ``move`` and the
reports. One pass over the bytes finds the ends of all matches of all rules; the
start of a match is where its rule's reversed automaton, walked back from the end,
accepts last, no further than the rule's match before.

Syntax: literals, ``\\xHH`` and escaped characters, classes, groups, ``(?i:...)`` for
ASCII letters in either case, ``|``, ``?``, ``*``, ``+``, ``{n}`` and ``{n,}``. A rule
that could stop accepting and go on (like ``ab(cd)?``) is refused, since its end
would lie behind the byte that shows it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np

_TOKEN = re.compile(r"\\x([0-9A-Fa-f]{2})|\\(.)|(\(\?i:)|(\{\d+(?:,?)\})|(.)", re.DOTALL)


class Nfa:
    """States are numbers; ``step[s]`` lists (bytes, target), ``free[s]`` targets."""

    def __init__(self, pattern: str):
        self.step: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []
        self._tokens = [
            (m.lastindex, m.group(m.lastindex)) for m in _TOKEN.finditer(pattern)
        ]
        self._at, self._fold = 0, False
        self.start, self.end = self._either()
        if self._at < len(self._tokens):
            raise ValueError(f"cannot read {pattern!r} from token {self._at}")

    def _state(self) -> int:
        self.step.append([])
        self.free.append([])
        return len(self.step) - 1

    def _peek(self, *symbols: str) -> bool:
        """Is the next token one of these, unescaped?"""
        if self._at == len(self._tokens):
            return False
        kind, text = self._tokens[self._at]
        return kind == 5 and text in symbols

    def _next(self) -> tuple[int, str]:
        self._at += 1
        return self._tokens[self._at - 1]

    def _either(self) -> tuple[int, int]:
        start, end = self._state(), self._state()
        while True:
            first, last = self._sequence()
            self.free[start].append(first)
            self.free[last].append(end)
            if not self._peek("|"):
                return start, end
            self._next()

    def _sequence(self) -> tuple[int, int]:
        start = end = self._state()
        while self._at < len(self._tokens) and not self._peek("|", ")"):
            begin = self._at
            first, last = self._atom()
            self.free[end].append(first)
            after = self._at
            if self._peek("?", "*", "+"):
                sign = self._next()[1]
                if sign in "*+":
                    self.free[last].append(first)
                if sign in "?*":
                    self.free[first].append(last)
            elif self._at < len(self._tokens) and self._tokens[self._at][0] == 4:
                count = self._next()[1]
                rest, times = self._at, int(re.sub(r"\D", "", count))
                for _ in range(times - 1):
                    self._at = begin
                    again, end_again = self._atom()
                    self.free[last].append(again)
                    first, last = again, end_again
                    assert self._at == after
                if "," in count:
                    self.free[last].append(first)
                self._at = rest
            end = self._state()
            self.free[last].append(end)
        return start, end

    def _atom(self) -> tuple[int, int]:
        kind, text = self._next()
        if kind == 3 or (kind == 5 and text == "("):
            outer, self._fold = self._fold, self._fold or kind == 3
            inner = self._either()
            self._fold = outer
            if not self._peek(")"):
                raise ValueError("a group is not closed")
            self._next()
            return inner
        if kind == 5 and text == "[":
            read = self._class()
        else:
            read = self._bytes(kind, text)
        start, end = self._state(), self._state()
        first, last = self._state(), self._state()
        self.free[start].append(first)
        self.step[first].append((frozenset(read), last))
        self.free[last].append(end)
        return start, end

    def _bytes(self, kind: int, text: str) -> set[int]:
        value = int(text, 16) if kind == 1 else ord(text)
        if value > 127:
            raise ValueError("rules read ASCII; use a negated class for the rest")
        read = {value}
        if self._fold and chr(value).isalpha():
            read |= {value ^ 32}
        return read

    def _class(self) -> set[int]:
        negated = self._peek("^")
        if negated:
            self._next()
        read: set[int] = set()
        while not self._peek("]"):
            low = self._bytes(*self._next())
            if self._peek("-") and self._tokens[self._at + 1] != (5, "]"):
                self._next()
                read |= set(range(min(low), max(self._bytes(*self._next())) + 1))
            else:
                read |= low
        self._next()
        return set(range(256)) - read if negated else read

    def closure(self, states) -> frozenset:
        found, waiting = set(states), list(states)
        while waiting:
            for target in self.free[waiting.pop()]:
                if target not in found:
                    found.add(target)
                    waiting.append(target)
        return frozenset(found)

    def after(self, states: frozenset, byte: int) -> frozenset:
        return self.closure(
            {t for s in states for read, t in self.step[s] if byte in read}
        )

    def reversed(self) -> Nfa:
        back = object.__new__(Nfa)
        back.step = [[] for _ in self.step]
        back.free = [[] for _ in self.free]
        for s in range(len(self.step)):
            for read, t in self.step[s]:
                back.step[t].append((read, s))
            for t in self.free[s]:
                back.free[t].append(s)
        back.start, back.end = self.end, self.start
        return back

    def byte_sets(self) -> Iterator[frozenset]:
        for steps in self.step:
            for read, _ in steps:
                yield read


def _byte_classes(nfas: Sequence[Nfa]) -> tuple[bytes, list[int]]:
    """A class for each byte, and one byte of each class."""
    sets = list(dict.fromkeys(s for nfa in nfas for s in nfa.byte_sets()))
    known: dict[tuple, int] = {}
    classes = bytes(
        known.setdefault(tuple(b in s for s in sets), len(known)) for b in range(256)
    )
    return classes, [classes.index(c) for c in range(len(known))]


class Scanner:
    """All rules in one automaton: the ends of their matches in one pass."""

    def __init__(self, patterns: Sequence[str]):
        self._nfas = [Nfa(pattern) for pattern in patterns]
        self._starts = [nfa.closure({nfa.start}) for nfa in self._nfas]
        for nfa, start, pattern in zip(self._nfas, self._starts, patterns, strict=True):
            if nfa.end in start:
                raise ValueError(f"{pattern!r} matches nothing at all")
        self.byte_class, samples = _byte_classes(self._nfas)
        width = len(samples)
        self._known: dict[tuple, tuple] = {}
        begin = tuple(() for _ in self._nfas)
        numbers, waiting = {begin: 0}, [begin]
        rows: list[list[tuple[int, tuple[int, ...]]]] = []
        while len(rows) < len(waiting):
            row = []
            for byte in samples:
                target, reports = self._step(waiting[len(rows)], byte)
                if target not in numbers:
                    numbers[target] = len(numbers)
                    waiting.append(target)
                row.append((numbers[target], reports))
            rows.append(row)
        final = [self._accepting(state) for state in waiting]
        self.subsets = len(rows)
        self._minimise(rows, final, width)
        self.backwards = [Backward(nfa) for nfa in self._nfas]
        # The arrays are all that a scan needs, and all that travels to the tasks.
        del self._nfas, self._starts, self._known

    def _accepting(self, state: tuple) -> tuple[int, ...]:
        return tuple(
            r for r, sets in enumerate(state) if sets and self._nfas[r].end in sets[0]
        )

    def _step(self, state: tuple, byte: int) -> tuple[tuple, tuple[int, ...]]:
        target, reports = [], []
        for r, sets in enumerate(state):
            key = (r, sets, byte)
            if key not in self._known:
                self._known[key] = self._step_of_rule(*key)
            moved, ended = self._known[key]
            target.append(moved)
            if ended:
                reports.append(r)
        return tuple(target), tuple(reports)

    def _step_of_rule(self, r: int, sets: tuple, byte: int) -> tuple[tuple, bool]:
        """The sets of one rule after a byte, and whether its match ended before it."""
        nfa, ended = self._nfas[r], False
        if sets and nfa.end in sets[0]:
            on = nfa.after(sets[0], byte)
            if on:
                if nfa.end not in on:
                    raise ValueError("a rule goes on after its end")
                return (on,), False
            sets, ended = (), True
        moved, seen = [], frozenset()
        for reached in (*sets, self._starts[r]):
            on = nfa.after(reached, byte) - seen
            if on:
                moved.append(on)
                seen |= on
                if nfa.end in on:
                    # Later starts lose to this one.
                    break
        # One that accepts behind an earlier live start would have to wait its turn.
        if any(nfa.end in on for on in moved[1:]):
            raise ValueError("a later start of a rule ends before an earlier one")
        return tuple(moved), ended

    def _minimise(self, rows: list, final: list, width: int) -> None:
        kinds: dict[tuple, int] = {}
        report = np.array(
            [[kinds.setdefault(reports, len(kinds)) for _, reports in row] for row in rows]
        )
        last = np.array([kinds.setdefault(reports, len(kinds)) for reports in final])
        move = np.array([[target for target, _ in row] for row in rows])
        block, count = np.zeros(len(rows), dtype=np.int64), 0
        while True:
            signs = np.column_stack([last, report, block[move]])
            _, block = np.unique(signs, axis=0, return_inverse=True)
            block = block.ravel()
            if block.max() + 1 == count:
                break
            count = int(block.max()) + 1
        # The start keeps number 0.
        order = np.argsort([block[0] != b for b in range(count)], kind="stable")
        number = np.empty(count, dtype=np.int64)
        number[order] = np.arange(count)
        block = number[block]
        first = np.full(count, -1)
        first[block[::-1]] = np.arange(len(rows))[::-1]
        self.states, self.width = count, width
        self.reports = list(kinds)
        self.final = [self.reports[last[s]] for s in first]
        # A move is the first cell of the next state's row; one that reports is that
        # cell's complement, and its report is looked up beside it.
        cells = block[move[first]] * width
        self.report = report[first].ravel().astype(np.int32)
        silent = np.array([not reports for reports in self.reports])
        self.move = np.where(silent[self.report], cells.ravel(), ~cells.ravel()).tolist()

    def ends(self, raw: bytes) -> list[tuple[int, int]]:
        """(rule, end) of all matches, in the order of their ends."""
        move, state, found = self.move, 0, []
        for at, column in enumerate(raw.translate(self.byte_class)):
            cell = move[state + column]
            if cell < 0:
                found.extend((r, at) for r in self.reports[self.report[state + column]])
                cell = ~cell
            state = cell
        found.extend((r, len(raw)) for r in self.final[state // self.width])
        return found

    def spans(self, raw: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) in bytes."""
        before, found = [0] * len(self.backwards), []
        for rule, end in self.ends(raw):
            start = self.backwards[rule].start(raw, end, before[rule])
            found.append((rule, start, end))
            before[rule] = end
        return found


class Backward:
    """The reversed automaton of one rule."""

    def __init__(self, nfa: Nfa):
        back = nfa.reversed()
        self.byte_class, samples = _byte_classes([back])
        begin = back.closure({back.start})
        numbers, waiting = {begin: 0}, [begin]
        self.move: list[list[int]] = []
        while len(self.move) < len(waiting):
            row = []
            for byte in samples:
                target = back.after(waiting[len(self.move)], byte)
                if not target:
                    row.append(-1)
                    continue
                if target not in numbers:
                    numbers[target] = len(numbers)
                    waiting.append(target)
                row.append(numbers[target])
            self.move.append(row)
        self.accepts = [back.end in state for state in waiting]

    def start(self, raw: bytes, end: int, least: int) -> int:
        state, found = 0, end
        for at in range(end - 1, least - 1, -1):
            state = self.move[state][self.byte_class[raw[at]]]
            if state < 0:
                break
            if self.accepts[state]:
                found = at
        return found

    def longest(self, raw: bytes) -> int:
        """How many of the last bytes of ``raw`` the rule takes at most."""
        return len(raw) - self.start(raw, len(raw), 0)
