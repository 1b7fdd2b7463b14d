"""Where lines end, in any encoding, for bytes that come in blocks and may begin within a line."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

from ..functions.encoding import decode

BOM = b"\xef\xbb\xbf"


@dataclass(frozen=True)
class Rule:
    """A line ends at \\n, which takes `unit` bytes; it is cut at `most` bytes. Within double quotes it ends only once `quoted` line ends have been passed."""

    encoding: str
    quoted: int
    most: int

    @property
    def wide(self) -> bool:
        return self.encoding.startswith("utf-16")

    @property
    def end(self) -> bytes:
        return (b"\0\n" if self.encoding == "utf-16be" else b"\n\0") if self.wide else b"\n"

    def text(self, raw: bytes, start: int) -> str:
        """What a line says, without its end and, at the start of a file, without a byte order mark."""
        cr = self.end.replace(b"\n", b"\r")
        if raw.endswith(self.end) and len(raw) % len(self.end) == 0:
            raw = raw[: -len(self.end)].removesuffix(cr)
        if start == 0:
            if self.wide:
                return decode(raw, self.encoding).removeprefix("﻿")
            raw = raw.removeprefix(BOM)
        return decode(raw, self.encoding)


#: What is known of the line that a stretch of bytes begins in: whether quotes are open, line ends passed in them, and the line's bytes before.
State = tuple[int, int, int]
FRESH: State = (0, 0, 0)


class Chain:
    """Line starts from a state on, by places counted from the first byte that is fed."""

    def __init__(self, rule: Rule, state: State = FRESH):
        self.rule = rule
        self.odd, self.passed, before = state
        self.start, self.raw, self.base = -before, b"", 0
        self.look = self.seen = before % 2 if rule.wide else 0

    def feed(self, block: bytes, last: bool = False) -> Iterator[tuple[int, int]]:
        """(start, end) of each line that ends; what is yielded can be read by `bytes` until the next one. `last`: no more bytes come."""
        rule = self.rule
        end, most, size = rule.end, rule.most, len(rule.end)
        keep = max(self.start, self.base)
        self.raw, self.base = self.raw[keep - self.base :] + block, keep
        whole = self.base + len(self.raw)
        while True:
            at = self.raw.find(end, self.look - self.base)
            if at >= 0:
                at += self.base
                if rule.wide and (at - self.start) % 2:
                    self.look = at + 1
                    continue
                stop = at + size
                if stop - self.start <= most:
                    if rule.quoted:
                        self.odd ^= self._quotes(self.seen, at) & 1
                        if self.odd and self.passed < rule.quoted:
                            self.passed += 1
                            self.look = self.seen = stop
                            continue
                    yield self.start, stop
                    self._begin(stop)
                    continue
            elif whole - self.start <= most:
                self.look = max(self.look, whole - size + 1)
                if last and whole > self.start:
                    yield self.start, whole
                    self._begin(whole)
                return
            # no end within `most` bytes
            stop = self.start + most
            yield self.start, stop
            self._begin(stop)

    def _begin(self, at: int) -> None:
        self.start = self.look = self.seen = at
        self.odd = self.passed = 0

    def _quotes(self, a: int, b: int) -> int:
        part = self.raw[a - self.base : b - self.base]
        if not self.rule.wide:
            return part.count(b'"')
        kind = ">u2" if self.rule.encoding == "utf-16be" else "<u2"
        return int((np.frombuffer(part[: len(part) // 2 * 2], kind) == ord('"')).sum())

    def bytes(self, a: int, b: int) -> bytes:
        """Of the bytes from a to b those that were fed."""
        return self.raw[max(0, a - self.base) : b - self.base]

    def state(self, whole: int) -> State:
        """The state behind `whole` bytes, all that were fed."""
        return (self.odd ^ (self._quotes(self.seen, whole) & 1) if self.rule.quoted and whole > self.seen else self.odd, self.passed, whole - self.start)


def cut(blocks: Iterable[bytes], rule: Rule) -> Iterator[tuple[str, int, int]]:
    """(text, offset, length with its end) of the lines of all blocks put together."""
    chain = Chain(rule)
    for block in blocks:
        for a, b in chain.feed(block):
            yield rule.text(chain.bytes(a, b), a), a, b - a
    for a, b in chain.feed(b"", last=True):
        yield rule.text(chain.bytes(a, b), a), a, b - a


def trials(rule: Rule) -> list[State]:
    """The states that a stretch behind an end mark may begin in, each with the fewest bytes before.

    Behind a mark a line goes on only if quotes are open, or in UTF-16 if the mark lay across two characters.
    """
    inside = [(1, k, 2) for k in range(1, rule.quoted + 1)]
    across = [(o, k, 1) for o in ((0, 1) if rule.quoted else (0,)) for k in range(rule.quoted + 1)] if rule.wide else []
    return [FRESH, *inside, *across]


def key(rule: Rule, state: State) -> State:
    """The trial that stands for a state."""
    odd, passed, before = state
    return FRESH if before == 0 else (odd, passed, 1 if rule.wide and before % 2 else 2)


@dataclass
class Trial:
    """How a stretch goes from one state.

    first: bytes of it that belong to the line it began in, or to none; starts: lines that start in it; moved: whether the line it
    began in ends in it. It holds for states whose bytes before, with first, are no more than a line may have.
    """

    first: int
    starts: int
    moved: bool
    state: State
    exact: bool = False


class Trials:
    """All trials of a stretch at once; those that meet go on as one."""

    def __init__(self, rule: Rule, exact: State | None = None):
        self.rule = rule
        begin = trials(rule) if exact is None else [exact]
        self.exact = exact is not None
        self.chains = {s: Chain(rule, s) for s in begin}
        self.first: dict[State, int | None] = dict.fromkeys(begin)
        self.starts = {s: int(s[2] == 0) for s in begin}
        #: a trial that has met another, and how many more starts it had
        self.met: dict[State, tuple[State, int]] = {}
        self.dead: set[State] = set()
        self.whole = 0

    def feed(self, block: bytes) -> None:
        if not block:
            return
        self.whole += len(block)
        for s, chain in list(self.chains.items()):
            for a, b in chain.feed(block):
                if self.first[s] is None:
                    if not self.exact and s[2] and b - a == self.rule.most and not chain.bytes(a, b).endswith(self.rule.end):
                        self.dead.add(s)  # cut, at a place that depends on the bytes before
                        break
                    self.first[s] = b
                self.starts[s] += 1
            if s in self.dead:
                del self.chains[s]
        seen: dict[tuple, State] = {}
        for s, chain in list(self.chains.items()):
            if chain.start < 0:
                continue
            at = (chain.start, chain.odd, chain.passed, chain.seen, chain.look)
            if at in seen:
                self.met[s] = (seen[at], self.starts[s] - self.starts[seen[at]])
                del self.chains[s]
            else:
                seen[at] = s

    def done(self) -> dict[State, Trial]:
        out = {}
        for s in self.first:
            if s in self.dead:
                continue
            lead, more = s, 0
            while lead in self.met:
                lead, extra = self.met[lead]
                more += extra
            chain = self.chains[lead]
            state = chain.state(self.whole)
            # a line that starts just behind the stretch isn't one of it
            n = self.starts[lead] + more - (chain.start == self.whole)
            out[s] = Trial(self.whole if self.first[s] is None else self.first[s], n, self.first[s] is not None or s[2] == 0, state, self.exact)
        return out


def after(rule: Rule, state: State, trial: Trial | None, size: int) -> State | None:
    """The state behind a stretch of `size` bytes that begins in a state; None if the trial doesn't hold for it."""
    if trial is None:
        return None
    if trial.exact or state[2] == 0:
        return trial.state
    if state[2] + trial.first > rule.most:
        return None
    return trial.state if trial.moved else (trial.state[0], trial.state[1], state[2] + size)
