"""Small weighted finite-state transducers over token classes, and their composition.

Weights are anything that adds up: numbers to score, or vectors that count which
arcs a path took.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

ANY = None


class Transducer:
    """Deterministic: in a state, a symbol gives (next state, output symbol, weight). ANY stands for all symbols without an arc of their own and is passed through."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def step(self, state, symbol):
        arc = self.arcs.get((state, symbol))
        if arc is None:
            to, out, weight = self.arcs[(state, ANY)]
            arc = self.arcs[(state, symbol)] = (to, symbol if out is ANY else out, weight)
        return arc

    def __matmul__(self, after: Transducer) -> Transducer:
        return Composed(self, after)

    def run(self, symbols: Iterable) -> Iterator[tuple]:
        """Each output with the weight of the arc that gave it."""
        state = self.start
        for symbol in symbols:
            state, out, weight = self.step(state, symbol)
            yield out, weight


class Composed(Transducer):
    """One transducer's output fed to another, states paired as they are met; weights add."""

    def __init__(self, first: Transducer, second: Transducer):
        super().__init__((first.start, second.start), {})
        self.first, self.second = first, second

    def step(self, state, symbol):
        arc = self.arcs.get((state, symbol))
        if arc is None:
            a, middle, w1 = self.first.step(state[0], symbol)
            b, out, w2 = self.second.step(state[1], middle)
            arc = self.arcs[(state, symbol)] = ((a, b), out, w1 + w2)
        return arc
