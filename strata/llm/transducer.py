"""A minimal acyclic transducer over sorted words, which gives each word its lexicographic ordinal.

The automaton is built from the sorted words in one pass: the states of a word's tail become final as soon as the next
word leaves them, and a state equal to an earlier one (same acceptance, same arcs) is replaced by it, so prefixes and
suffixes are shared and the automaton is the smallest one.  Every arc carries the number of words that come before all
words that take it; the sum along a word's path is its ordinal.  Arcs are three sorted arrays, so many words walk the
automaton together, one byte a step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Transducer:
    key: np.ndarray         # of each arc 256 * state + byte, ascending
    target: np.ndarray      # the state that it leads to
    before: np.ndarray      # accepted words that come before those of this arc
    final: np.ndarray       # of each state: a word ends here
    start: int

    def after(self, prefix: bytes) -> tuple[int, int] | None:
        """The state that ``prefix`` leads to, and how many words come before all that begin with it; None if none does."""
        state, total = self.start, 0
        for byte in prefix:
            arc = int(np.searchsorted(self.key, 256 * state + byte))
            if arc == len(self.key) or self.key[arc] != 256 * state + byte:
                return None
            state, total = int(self.target[arc]), total + int(self.before[arc])
        return state, total

    def walk(self, buf: np.ndarray, begin: np.ndarray, length: np.ndarray, state: np.ndarray | None = None, total: np.ndarray | None = None) -> np.ndarray:
        """Ordinals of the words ``buf[begin:begin + length]``, each after what led to its ``state``; -1 for those that it does not hold."""
        out = np.full(len(begin), -1, np.int64)
        order = np.argsort(-length, kind="stable")          # those still under way are a prefix
        begin, length = begin[order], length[order]
        state = np.full(len(begin), self.start, np.int64) if state is None else state[order]
        total = np.zeros(len(begin), np.int64) if total is None else total[order]
        at, step = np.arange(len(begin)), 0
        while len(at):
            done = int(np.searchsorted(-length[at], -step, side="left"))        # the rest has step bytes or fewer
            over = at[done:]
            over = over[self.final[state[over]]]
            out[order[over]] = total[over]
            at = at[:done]
            if not len(at) or not len(self.key):
                break
            want = (state[at] << 8) + buf[begin[at] + step]
            arc = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            found = self.key[arc] == want
            at, arc = at[found], arc[found]
            state[at] = self.target[arc]
            total[at] += self.before[arc]
            step += 1
        return out

    def packed(self) -> bytes:
        head = np.array([len(self.key), len(self.final), self.start], "<i8")
        return b"".join([head.tobytes(), self.key.astype("<i8").tobytes(), self.target.astype("<i4").tobytes(), self.before.astype("<i4").tobytes(), np.packbits(self.final).tobytes()])

    @classmethod
    def unpacked(cls, raw: bytes) -> Transducer:
        n, states, start = (int(x) for x in np.frombuffer(raw, "<i8", 3))
        at = 24
        key, at = np.frombuffer(raw, "<i8", n, at), at + 8 * n
        target, at = np.frombuffer(raw, "<i4", n, at).astype(np.int64), at + 4 * n
        before, at = np.frombuffer(raw, "<i4", n, at).astype(np.int64), at + 4 * n
        final = np.unpackbits(np.frombuffer(raw, np.uint8, -1, at), count=states).astype(bool)
        return cls(key, target, before, final, start)


def build(words: list[bytes]) -> Transducer:
    """From distinct words in ascending order."""
    known: dict[tuple, int] = {}        # (final, arcs) -> state
    count: list[int] = []               # words accepted from a state on
    states: list[tuple] = []
    open_: list[list] = [[False, []]]   # of the states on the last word's path: [final, finished arcs]
    last = b""

    def close(down_to: int) -> None:
        for depth in range(len(open_) - 1, down_to, -1):
            final, arcs = open_.pop()
            open_[-1][1].append((last[depth - 1], settled(final, arcs)))

    def settled(final: bool, arcs: list) -> int:
        same = (final, tuple(arcs))
        state = known.get(same)
        if state is None:
            state = known[same] = len(states)
            states.append(same)
            count.append(final + sum(count[t] for _, t in arcs))
        return state

    for word in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        close(shared)
        open_ += [[False, []] for _ in range(len(word) - shared)]
        open_[-1][0] = True
        last = word
    close(0)
    start = settled(*open_[0])
    key, target, before = [], [], []
    for state, (final, arcs) in enumerate(states):
        seen = int(final)
        for byte, to in arcs:
            key.append(256 * state + byte)
            target.append(to)
            before.append(seen)
            seen += count[to]
    return Transducer(np.array(key, np.int64), np.array(target, np.int64), np.array(before, np.int64), np.array([f for f, _ in states], bool), start)
