"""Weighted acyclic automata that map short word sequences to counts.

States are shared: two states with the same weight and the same transitions are one.
They are built from n-grams sorted by their words, level by level from the deepest,
so that a state's transitions are complete and final when it is looked up in the
register of states built before. The weight of a state is the count of the sequence that leads
to it; 0 means that only longer sequences are counted here.

Words are numbered in the order of their bytes, so sorted numbers are sorted
sequences. Sequences have ``DEPTH`` words at most; one is a 64-bit code of its word
numbers (0: no word), which puts every prefix before its continuations.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

from basketseq.llm.words import mixed

DEPTH = 3
BITS = 21
#: Words that one automaton can tell apart.
MAX_WORDS = (1 << BITS) - 2
_MASK = (1 << BITS) - 1


def code_of(columns: list[np.ndarray]) -> np.ndarray:
    """Codes of word numbers, given by place; missing places are no word."""
    code = np.zeros(len(columns[0]), dtype=np.int64)
    for place in range(DEPTH):
        code <<= BITS
        if place < len(columns):
            code |= columns[place]
    return code


def words_of(codes: np.ndarray) -> np.ndarray:
    """(n, DEPTH) word numbers of codes."""
    shifts = BITS * np.arange(DEPTH - 1, -1, -1)
    return (codes[:, None] >> shifts) & _MASK


def _places(first: np.ndarray, fan: np.ndarray) -> np.ndarray:
    """The places of all slices, one after the other."""
    return np.arange(fan.sum()) + np.repeat(first - (np.cumsum(fan) - fan), fan)


def _slice_hashes(pairs, first, fan, weights, salt: int) -> np.ndarray:
    """Hashes of (weight, slice of ``pairs``). A slice's labels differ, so that the order
    of its pairs need not count."""
    sums = np.zeros(len(pairs) + 1, dtype=np.uint64)
    np.cumsum(mixed(pairs.astype(np.uint64) + np.uint64(salt)), out=sums[1:])
    inside = sums[first + fan] - sums[first]
    return mixed(mixed(inside + fan.astype(np.uint64)) + weights.astype(np.uint64))


def _equal_states(pairs, first, fan, weights, leader) -> bool:
    """Whether each state equals its leader, transition by transition."""
    asked = np.flatnonzero(leader != np.arange(len(leader)))
    other = leader[asked]
    if (fan[asked] != fan[other]).any() or (weights[asked] != weights[other]).any():
        return False
    mine, theirs = _places(first[asked], fan[asked]), _places(first[other], fan[asked])
    return bool((pairs[mine] == pairs[theirs]).all())


class _Register:
    """States of several automata built so far, equal ones once; transitions are complete
    when a state is looked up. States without transitions come first, one per automaton
    and weight; so states of different automata have no target in common."""

    def __init__(self, counts: np.ndarray, groups: np.ndarray, n_groups: int):
        """``groups`` are the numbers of the automata that the counts belong to."""
        self.known = np.unique(np.append(counts, 0))
        keys = groups * len(self.known) + np.searchsorted(self.known, counts)
        self.keys = np.unique(np.append(keys, np.arange(n_groups) * len(self.known)))
        self.weights = self.known[self.keys % len(self.known)]
        # Of the states with transitions: weights, how many, and the (label, target) pairs.
        self.weight = np.zeros(0, dtype=np.int64)
        self.fan = np.zeros(0, dtype=np.int64)
        self.pairs = np.zeros(0, dtype=np.int64)
        self.group = self.keys // len(self.known)

    def terminals(self, weights: np.ndarray, groups: np.ndarray) -> np.ndarray:
        keys = groups * len(self.known) + np.searchsorted(self.known, weights)
        return np.searchsorted(self.keys, keys)

    def states(self, weights, groups, first, fan, labels, targets) -> np.ndarray:
        """The state of each node: its weight, and its slice of (labels, targets)."""
        found = self.terminals(weights, groups)
        inner = np.flatnonzero(fan)
        # Known states first, so that they lead the nodes equal to them.
        n_known = len(self.weight)
        pairs = np.concatenate([self.pairs, labels << 32 | targets])
        firsts = np.concatenate([np.cumsum(self.fan) - self.fan, first[inner] + len(self.pairs)])
        fans = np.concatenate([self.fan, fan[inner]])
        all_weights = np.concatenate([self.weight, weights[inner]])
        leader = self._leaders(pairs, firsts, fans, all_weights)
        fresh = np.flatnonzero(leader == np.arange(len(leader)))
        number = np.zeros(len(leader), dtype=np.int64)
        number[fresh] = np.arange(len(fresh)) + len(self.weights)
        found[inner] = number[leader[n_known:]]
        self.weight, self.fan = all_weights[fresh], fans[fresh]
        self.group = np.append(self.group, groups[inner[fresh[fresh >= n_known] - n_known]])
        self.pairs = pairs[_places(firsts[fresh], fans[fresh])]
        return found

    @staticmethod
    def _leaders(pairs, first, fan, weights) -> np.ndarray:
        """The first state equal to each one: by hashes, which are then verified."""
        salt = 0
        while True:
            hashes = _slice_hashes(pairs, first, fan, weights, salt)
            _, lead, member = np.unique(hashes, return_index=True, return_inverse=True)
            leader = lead[member]
            if _equal_states(pairs, first, fan, weights, leader):
                return leader
            salt += 1

    def automata(self, n_groups: int) -> list[tuple[np.ndarray, ...]]:
        """Of each automaton: weights, first transition of each state (and the end),
        labels, targets."""
        weight = np.concatenate([self.weights, self.weight])
        fan = np.concatenate([np.zeros(len(self.weights), dtype=np.int64), self.fan])
        # Together by automaton; the order within one stays.
        order = np.argsort(self.group, kind="stable")
        ends = np.searchsorted(self.group[order], np.arange(n_groups + 1))
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order)) - ends[self.group[order]]
        first = np.append(0, np.cumsum(fan[order]))
        pairs = self.pairs[_places((np.cumsum(fan) - fan)[order], fan[order])]
        weight, labels, targets = weight[order], pairs >> 32, number[pairs & 0xFFFFFFFF]
        found = []
        for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            own = first[begin : end + 1]
            among = slice(own[0], own[-1])
            found.append((weight[begin:end], own - own[0], labels[among], targets[among]))
        return found


class Transducer:
    """``words`` sorted; per state its weight and its slice of the transitions
    (word number, target). The start is the last state."""

    def __init__(self, words: list[bytes], codes: np.ndarray, counts: np.ndarray):
        """``codes`` sorted and distinct, over numbers from 1 into ``words``."""
        self._set(words, _built(codes, counts, np.zeros(len(codes), dtype=np.int64), 1)[0])

    def _set(self, words: list[bytes], arrays: tuple[np.ndarray, ...]) -> None:
        self.words = words
        self.weight, self.first, self.label, self.target = arrays

    @classmethod
    def of_arrays(cls, words: list[bytes], arrays: tuple[np.ndarray, ...]) -> Transducer:
        found = object.__new__(cls)
        found._set(words, arrays)
        return found

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """All counted sequences: codes, sorted, and counts."""
        codes, counts = _entries([self], [np.arange(len(self.words) + 1)])
        order = np.argsort(codes)
        return codes[order], counts[order]

    def packed(self) -> bytes:
        vocabulary = b"\n".join(self.words)
        parts = (self.weight, self.first, self.label, self.target)
        numbers = np.concatenate(parts).astype("<i8")
        head = struct.pack("<4q", len(self.words), len(vocabulary), len(self.weight), len(self.label))
        # Numbers byte by byte of the same weight: small ones leave runs of zeros.
        planes = numbers.view(np.uint8).reshape(-1, 8).T.tobytes()
        return zstandard.ZstdCompressor(level=1).compress(head + vocabulary + planes)

    @classmethod
    def unpacked(cls, data: bytes) -> Transducer:
        raw = zstandard.ZstdDecompressor().decompress(data)
        n_words, size, states, transitions = struct.unpack_from("<4q", raw)
        words = raw[32 : 32 + size].split(b"\n") if n_words else []
        planes = np.frombuffer(raw, dtype=np.uint8, offset=32 + size)
        numbers = np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()
        ends = np.cumsum([states, states + 1, transitions, transitions])
        bounds = [0, *ends.tolist()]
        return cls.of_arrays(words, tuple(numbers[i:j] for i, j in zip(bounds, bounds[1:])))

    def weights_of(self, sequences: list[tuple[bytes, ...]]) -> list[int]:
        """Composition with sequences: the weight at the end of each one's path, 0
        where there is none."""
        number = {word: i for i, word in enumerate(self.words, 1)}
        codes, counts = self.entries()
        asked = [[number.get(word, 0) for word in s] for s in sequences]
        known = [len(s) <= DEPTH and all(s) for s in asked]
        columns = [np.array([s[p] if p < len(s) else 0 for s in asked]) for p in range(DEPTH)]
        if not len(codes) or not asked:
            return [0] * len(asked)
        code = code_of(columns)
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        hit = (codes[at] == code) & np.array(known)
        return np.where(hit, counts[at], 0).tolist()


def _entries(
    automata: list[Transducer], renumber: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of all automata, one level at a time, their word numbers replaced."""

    def shifted(parts: list[np.ndarray], sizes: list[int]) -> np.ndarray:
        return np.concatenate(parts) + np.repeat(_before(sizes), [len(p) for p in parts])

    n_states = [len(one.weight) for one in automata]
    weight = np.concatenate([one.weight for one in automata])
    fan = np.concatenate([one.first[1:] - one.first[:-1] for one in automata])
    first = np.cumsum(fan) - fan
    target = shifted([one.target for one in automata], n_states)
    number = shifted([one.label for one in automata], [len(r) for r in renumber])
    label = np.concatenate(renumber)[number]
    states = np.cumsum(n_states) - 1
    prefix = np.zeros(len(automata), dtype=np.int64)
    codes, counts = [], []
    for depth in range(DEPTH):
        at = _places(first[states], fan[states])
        shift = BITS * (DEPTH - 1 - depth)
        prefix = np.repeat(prefix, fan[states]) | (label[at] << shift)
        states = target[at]
        counted = weight[states] > 0
        codes.append(prefix[counted])
        counts.append(weight[states][counted])
    return np.concatenate(codes), np.concatenate(counts)


def _before(sizes: list[int]) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _own_words(codes: np.ndarray, groups: np.ndarray, n_groups: int, n_words: int):
    """Codes over the words that each group uses; the words of all groups, and where
    those of a group end. Numbers keep their order, and so do the codes."""
    numbers = words_of(codes)
    is_word = numbers > 0
    keys = (groups[:, None] * (n_words + 1) + numbers)[is_word]
    used, place = np.unique(keys, return_inverse=True)
    ends = np.searchsorted(used, np.arange(n_groups + 1) * (n_words + 1))
    numbers[is_word] = place - ends[keys // (n_words + 1)] + 1
    return code_of(list(numbers.T)), used % (n_words + 1), ends


def _built(
    codes: np.ndarray, counts: np.ndarray, groups: np.ndarray, n_groups: int
) -> list[tuple[np.ndarray, ...]]:
    """The arrays of an automaton per group; all are built at once."""
    register = _Register(counts, groups, n_groups)
    # Nodes of the trees of sequences, per depth: the first of each node's sequences (a
    # prefix that is counted itself stands before its continuations), parent, weight.
    fresh_group = np.diff(groups, prepend=-1) > 0
    above = np.cumsum(fresh_group) - 1
    levels = [(np.flatnonzero(fresh_group), None, np.zeros(n_groups, dtype=np.int64))]
    for depth in range(1, DEPTH + 1):
        shift = BITS * (DEPTH - depth)
        prefixes = codes >> shift
        fresh = (prefixes & _MASK > 0) & (fresh_group | (np.diff(prefixes, prepend=-1) != 0))
        starts = np.flatnonzero(fresh)
        own = codes[starts] == prefixes[starts] << shift
        levels.append((starts, above[starts], np.where(own, counts[starts], 0)))
        above = np.cumsum(fresh) - 1
    states = register.terminals(levels[DEPTH][2], groups[levels[DEPTH][0]])
    for depth in range(DEPTH - 1, -1, -1):
        starts, _, weights = levels[depth]
        of_group = groups[starts] if depth else np.arange(n_groups)
        deeper, parent, _ = levels[depth + 1]
        # Nodes of one parent stand together.
        fan = np.bincount(parent, minlength=len(weights))
        labels = (codes[deeper] >> (BITS * (DEPTH - 1 - depth))) & _MASK
        states = register.states(weights, of_group, np.cumsum(fan) - fan, fan, labels, states)
    # A start equals no state below it, so it is the last one of its automaton.
    return register.automata(n_groups)


def of_groups(
    words: list[bytes], codes: np.ndarray, counts: np.ndarray, groups: np.ndarray
) -> list[Transducer]:
    """An automaton per group, over the words that its sequences use.

    Groups are numbered from 0 and stand together; codes, over numbers from 1 into
    ``words``, are distinct and sorted within each.
    """
    n_groups = int(groups[-1]) + 1 if len(groups) else 1
    codes, used, ends = _own_words(codes, groups, n_groups, len(words))
    names = [words[i - 1] for i in used.tolist()]
    return [
        Transducer.of_arrays(names[begin:end], arrays)
        for begin, end, arrays in zip(
            ends[:-1].tolist(), ends[1:].tolist(), _built(codes, counts, groups, n_groups), strict=True
        )
    ]


def of_entries(words: list[bytes], codes: np.ndarray, counts: np.ndarray) -> Transducer:
    """Over the words that the sequences use; ``codes`` sorted and distinct."""
    return of_groups(words, codes, counts, np.zeros(len(codes), dtype=np.int64))[0]


def union(automata: list[Transducer], least: int = 1) -> Transducer:
    """The sum of the automata's counts, without sequences counted less than ``least``."""
    words = sorted({word for one in automata for word in one.words})
    if len(words) > MAX_WORDS:
        raise ValueError(f"{len(words)} words in one range: use smaller ranges")
    number = {word: i for i, word in enumerate(words, 1)}
    renumber = [np.array([0, *map(number.__getitem__, one.words)]) for one in automata]
    all_codes, all_counts = _entries(automata, renumber)
    codes, place = np.unique(all_codes, return_inverse=True)
    counts = np.zeros(len(codes), dtype=np.int64)
    np.add.at(counts, place, all_counts)
    kept = counts >= least
    return of_entries(words, codes[kept], counts[kept])
