"""Weighted acyclic automata over labels: built from sorted paths, united with their weights summed, and looked up."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa

Path = tuple[str, ...]

#: Automata that are united at once.
FAN = 64

SCHEMA = "labels array<string>, arcs array<int>, label array<int>, target array<int>, weights array<bigint>"


@dataclass
class Automaton:
    """States are numbered so that arcs lead to smaller numbers; the last one is the start. Weight 0: not final."""

    weights: list[int]
    arcs: list[tuple[tuple[str, int], ...]]

    def columns(self) -> list[pa.Array]:
        """One row of SCHEMA: distinct labels, arcs per state, label and target of each arc, weight of each state."""
        labels = sorted({label for arcs in self.arcs for label, _ in arcs})
        place = {label: i for i, label in enumerate(labels)}
        flat = [(place[label], target) for arcs in self.arcs for label, target in arcs]
        return [
            pa.array([labels], pa.list_(pa.string())),
            pa.array([[len(arcs) for arcs in self.arcs]], pa.list_(pa.int32())),
            pa.array([[f[0] for f in flat]], pa.list_(pa.int32())),
            pa.array([[f[1] for f in flat]], pa.list_(pa.int32())),
            pa.array([self.weights], pa.list_(pa.int64())),
        ]

    @staticmethod
    def read(labels: list[str], arcs: list[int], label: list[int], target: list[int], weights: list[int]) -> Automaton:
        ends, flat = 0, [(labels[i], t) for i, t in zip(label, target, strict=True)]
        states = []
        for n in arcs:
            states.append(tuple(flat[ends : ends + n]))
            ends += n
        return Automaton(weights, states)

    def paths(self) -> Iterator[tuple[Path, int]]:
        """All paths with their weights, ascending."""
        return union([self])

    def weights_of(self, paths: Iterable[Path]) -> Iterator[int]:
        """The weight of each of some ascending paths, 0 if there is none: this automaton composed with theirs.

        The states along the common part with the path before are kept.
        """
        after: dict[int, dict[str, int]] = {}
        states, last = [len(self.weights) - 1], ()
        for path in paths:
            common = _common(last, path)
            del states[common + 1 :]
            for label in path[common:]:
                at = states[-1]
                if at is not None and at not in after:
                    after[at] = dict(self.arcs[at])
                states.append(None if at is None else after[at].get(label))
            last = path
            yield 0 if states[-1] is None else self.weights[states[-1]]


def _common(a: Path, b: Path) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def build(paths: Iterable[tuple[Path, int]]) -> Automaton:
    """The minimal automaton of ascending distinct paths with positive weights, built as they come.

    Only the states along the last path are open. When the next path leaves it, the states behind the common part
    can get no more arcs; each is frozen, and becomes an earlier state if one has the same weight and arcs.
    """
    frozen: dict[tuple, int] = {}
    open_states: list[list] = [[0, []]]
    last: Path = ()

    def freeze(depth: int) -> None:
        while len(open_states) > depth + 1:
            weight, arcs = open_states.pop()
            state = frozen.setdefault((weight, tuple(arcs)), len(frozen))
            open_states[-1][1].append((last[len(open_states) - 1], state))

    for path, weight in paths:
        common = _common(last, path)
        freeze(common)
        open_states.extend([0, []] for _ in path[common:])
        open_states[-1][0] = weight
        last = path
    freeze(0)
    weight, arcs = open_states[0]
    states = [*frozen, (weight, tuple(arcs))]
    return Automaton([s[0] for s in states], [s[1] for s in states])


def union(automata: list[Automaton]) -> Iterator[tuple[Path, int]]:
    """The paths of all automata, ascending, with their weights summed; all are walked at the same time."""

    def walk(at: list[tuple[Automaton, int]], path: Path) -> Iterator[tuple[Path, int]]:
        weight = sum(a.weights[s] for a, s in at)
        if weight:
            yield path, weight
        following: dict[str, list[tuple[Automaton, int]]] = {}
        for a, s in at:
            for label, target in a.arcs[s]:
                following.setdefault(label, []).append((a, target))
        for label in sorted(following):
            yield from walk(following[label], (*path, label))

    return walk([(a, len(a.weights) - 1) for a in automata], ())


class Sum:
    """The union of a stream of automata; FAN of a kind become one of the next kind, so each is walked a few times."""

    def __init__(self):
        self.kinds: list[list[Automaton]] = [[]]

    def add(self, automaton: Automaton, kind: int = 0) -> None:
        if kind == len(self.kinds):
            self.kinds.append([])
        self.kinds[kind].append(automaton)
        if len(self.kinds[kind]) == FAN:
            whole = build(union(self.kinds[kind]))
            self.kinds[kind] = []
            self.add(whole, kind + 1)

    def paths(self) -> Iterator[tuple[Path, int]]:
        return union([a for kind in self.kinds for a in kind])
