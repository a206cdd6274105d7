"""Token ids of words, kept per Python worker.

Both tokenizers here cut at white space before anything else, so a text's ids
are its words' ids in order, and a word has to be encoded once per worker.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class WordCache:
    """``encode(words) -> (all ids, ids per word)`` behind a table of at most ``limit`` words (then it starts anew)."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 400_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each word."""
        new = list(set(words).difference(self.index))
        if new:
            if len(self.index) + len(new) > self.limit:
                self._clear()
                new = list(set(words))
            got, n = self.encode(new)
            self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(n) - n])
            self.length = np.concatenate([self.length, n])
            self.pool = np.concatenate([self.pool, got.astype(np.int32)])
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        return gathered(self.pool, self.start[at], self.length[at])


def gathered(pool: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``pool[start:start + n]`` one after the other, and their lengths."""
    into = np.cumsum(n) - n
    return pool[np.repeat(start - into, n) + np.arange(int(n.sum()))], n


def flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Id lists as all ids and lengths."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.concatenate([np.zeros(0, np.int32), *(np.asarray(x, np.int32) for x in lists)]), n
