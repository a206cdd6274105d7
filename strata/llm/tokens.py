"""Words of a chunk of texts as codes into the chunk's own sorted-out vocabulary.

A word is a maximal run of bytes of a given class, A-Z lower-cased.  All bytes above 0x7F belong to characters above
0x7F, so a class of bytes says the same of UTF-8 as a class of characters.  Words are told apart by their bytes
(Arrow's dictionary), never by a hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Letters A-Z, a-z and all characters above 0x7F.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
#: These and the digits.
LETTERS_AND_DIGITS = LETTERS.copy()
LETTERS_AND_DIGITS[48:58] = True


@dataclass
class Tokens:
    vocabulary: pa.LargeBinaryArray     # the distinct words
    code: np.ndarray        # of each word of the texts, in order: its place in the vocabulary
    doc: np.ndarray         # of each word of the texts: the text that it stands in
    n_docs: int

    @property
    def words(self) -> list[bytes]:
        return self.vocabulary.to_pylist()


def tokens(texts: list[bytes], wanted: np.ndarray) -> Tokens:
    """The words of ``texts``: runs of the bytes that ``wanted`` marks (space is not one of them), A-Z lower-cased."""
    buf = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    ok = wanted[buf]
    edge = np.flatnonzero(ok[1:] != ok[:-1]) + 1
    start, n = edge[0::2], edge[1::2] - edge[0::2]
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[buf[ok]])]).dictionary_encode()
    begin = np.cumsum([1, *(len(t) + 1 for t in texts)])[:-1]
    doc = np.searchsorted(begin, start, side="right") - 1
    return Tokens(found.dictionary, found.indices.to_numpy().astype(np.int64), doc, len(texts))
