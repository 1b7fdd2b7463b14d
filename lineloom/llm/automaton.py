"""An Aho-Corasick automaton whose states list what ends there, longest first."""

from __future__ import annotations

from collections import deque

_LEAF: dict = {}


class Automaton:
    """step[state] maps a character to the next state; where it has none, fallback[state] is tried; state 0 is the start."""

    def __init__(self, values: dict[str, object]):
        self.step: list[dict[str, int]] = [{}]
        own: list[object] = [None]
        for pattern, value in values.items():
            at = 0
            for c in pattern:
                nxt = self.step[at].get(c)
                if nxt is None:
                    if self.step[at] is _LEAF:
                        self.step[at] = {}
                    nxt = self.step[at][c] = len(self.step)
                    self.step.append(_LEAF)
                    own.append(None)
                at = nxt
            own[at] = value
        self.fallback = [0] * len(self.step)
        self.found: list[tuple] = [()] * len(self.step)
        self.found[0] = ()
        waiting = deque(self.step[0].values())
        for first in waiting:
            self.found[first] = () if own[first] is None else (own[first],)
        while waiting:
            state = waiting.popleft()
            for c, child in self.step[state].items():
                back = self.fallback[state]
                while back and c not in self.step[back]:
                    back = self.fallback[back]
                back = self.step[back].get(c, 0)
                self.fallback[child] = back
                self.found[child] = self.found[back] if own[child] is None else (own[child], *self.found[back])
                waiting.append(child)

    def states(self, text: str) -> list[int]:
        """The state behind each character."""
        step, fallback, state, out = self.step, self.fallback, 0, []
        for c in text:
            nxt = step[state].get(c)
            while nxt is None and state:
                state = fallback[state]
                nxt = step[state].get(c)
            state = nxt or 0
            out.append(state)
        return out
