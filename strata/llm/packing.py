"""Packing: order-preserving windows of a token stream, cut by dynamic programming.

The documents of a partition, in their order, are one stream of token ids.  A
window (sequence) holds at most ``size`` ids; the cuts between windows are
chosen among document ends, sentence ends and, inside a long sentence,
fixed steps, so that the sum of

    padding of each window + penalty of each cut (0 at a document's end)

is least.  best(j) = size - b(j) + penalty(j) + min over i with b(j) - b(i) <=
size of (best(i) + b(i)); the minimum over that sliding window comes from a
monotone queue, so the whole is linear in the number of possible cuts.

The stream is worked off in blocks of about ``block`` ids, and a block's last
window goes on into the next block, so memory is bounded by a block and the
longest single text.  The last window of a partition cannot be filled by
anything that follows: it is cut into power-of-two lengths, which are not padded.
No shuffle: each input partition packs its own documents.  sequence_id is the
partition's number times 2^40 plus a count; a retried task gives the same.

Defined cases: null or empty text has no ids but the end id; repeated rows and
null document ids are packed like others; a text of any length is cut as often
as needed; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from strata.llm.common import chunks, id_and_text
from strata.llm.wordcache import WordCache, flat, gathered

#: str.split() drops these, which are not white space in Unicode.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_NOT_WHITE = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")
_SPLIT = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]+)")


class WordTokenizer:
    """Ids of texts under a ``tokenizers`` file whose splitting drops white space, one distinct word at a time.

    Words are lower-cased first only where the file's own lower-casing gives the same (no sigma, already composed).
    A word of letters and trailing punctuation (no apostrophe) is the letters' ids and the punctuation's ids, since
    the file splits there.
    """

    def __init__(self, path: str, limit: int = 800_000):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        n = self.tokenizer.get_vocab_size()
        pieces = [self.tokenizer.id_to_token(i) or "" for i in range(n)]
        self.word_end = np.array([p.endswith("</w>") for p in pieces])
        self.sentence_end = np.array([bool(re.fullmatch(r".*[.!?。！？]", p.removesuffix("</w>"))) for p in pieces])
        self.cache = WordCache(self._encode, limit)
        self.parts = WordCache(self._encode_parts, limit // 2)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters with trailing punctuation are looked up as two parts; the rest is encoded as it is."""
        parts, count = [], []
        for w in words:
            m = _SPLIT.fullmatch(w)
            parts += m.groups() if m else (w,)
            count.append(2 if m else 1)
        ids, n = self.parts.ids(parts)
        return ids, np.add.reduceat(n, np.cumsum(count) - count)

    def _encode_parts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Plain lower-case words give one word-end id each, so many can be encoded as one text; others one by one."""
        plain = np.array([bool(_PLAIN.fullmatch(w)) for w in words])
        easy, hard = ([words[i] for i in np.flatnonzero(which).tolist()] for which in (plain, ~plain))
        runs, lengths = [], []
        for at in range(0, len(easy), 5000):
            ids = np.asarray(self.tokenizer.encode(" ".join(easy[at:at + 5000]), add_special_tokens=False).ids, np.int32)
            end = np.flatnonzero(self.word_end[ids]) + 1
            assert len(end) == len(easy[at:at + 5000])
            runs.append(ids)
            lengths.append(np.diff(end, prepend=0))
        ids, n = flat([e.ids for e in self.tokenizer.encode_batch_fast(hard, add_special_tokens=False)])
        pool, length = np.concatenate([*runs, ids]), np.concatenate([*lengths, n]).astype(np.int64)
        place = np.empty(len(words), np.int64)
        place[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(words))
        return gathered(pool, (np.cumsum(length) - length)[place], length[place])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        words, per = [], []
        for t in texts:
            lower = "Σ" not in t and unicodedata.is_normalized("NFC", t)
            # a special token's string is one only as it is written, so what may hold one is not lower-cased here
            special = "<|" in t
            if lower and not special:
                t = t.lower()
            w = t.split() if not _SEPARATORS.search(t) else _NOT_WHITE.findall(t)
            if lower and special:
                w = [x if "<|" in x else x.lower() for x in w]
            words += w
            per.append(len(w))
        ids, n = self.cache.ids(words)
        total = np.concatenate([[0], np.cumsum(n)])
        edge = np.concatenate([[0], np.cumsum(per)]).astype(np.int64)
        return ids, np.diff(total[edge])


@functools.cache
def _tokenizer(path: str, limit: int) -> WordTokenizer:
    return WordTokenizer(path, limit)


def best_cuts(at: np.ndarray, penalty: np.ndarray, size: int) -> list[int]:
    """Indices into ``at`` (possible cuts, rising, at[0] = 0, steps of at most ``size``) of the cheapest windows' ends."""
    b, pen = at.tolist(), penalty.tolist()
    gain, back = [0.0] * len(b), [0] * len(b)       # gain[i] = best(i) + b(i)
    queue: deque[int] = deque([0])
    for j in range(1, len(b)):
        low = b[j] - size
        while b[queue[0]] < low:
            queue.popleft()
        i = back[j] = queue[0]
        g = gain[j] = gain[i] + size + pen[j]
        while queue and gain[queue[-1]] >= g:
            queue.pop()
        queue.append(j)
    out, j = [], len(b) - 1
    while j:
        out.append(j)
        j = back[j]
    return out[::-1]


class Packer:
    """Collects documents' ids and gives out pieces (doc row, start, length, sequence, offset)."""

    def __init__(self, size: int, sentence_penalty: float, word_penalty: float, step: int):
        self.size, self.sentence, self.word, self.step = size, sentence_penalty, word_penalty, step
        self.ids, self.ends, self.docs, self.pending = [], [], [], 0
        self.sequence = 0

    def add(self, doc, ids: np.ndarray, sentence: np.ndarray, done: int = 0, total: int | None = None) -> None:
        """``done``: ids of the document that have been given out before."""
        self.ids.append(ids)
        self.ends.append(sentence)
        self.docs.append((doc, done, len(ids), len(ids) if total is None else total))
        self.pending += len(ids)

    def _points(self):
        ends = np.cumsum([d[2] for d in self.docs])
        at = np.concatenate([np.concatenate([[0], ends[:-1]])[i] + s for i, s in enumerate(self.ends)] + [ends])
        pen = np.concatenate([np.full(len(at) - len(ends), self.sentence), np.zeros(len(ends))])
        order = np.lexsort((pen, at))
        at, pen = at[order], pen[order]
        keep = np.concatenate([[True], at[1:] != at[:-1]])
        at, pen = np.concatenate([[0], at[keep]]), np.concatenate([[0.0], pen[keep]])
        far = np.flatnonzero(np.diff(at) > self.step)
        more = np.concatenate([np.arange(at[i] + self.step, at[i + 1], self.step) for i in far]) if len(far) else np.zeros(0, np.int64)
        at, pen = np.concatenate([at, more]).astype(np.int64), np.concatenate([pen, np.full(len(more), self.word)])
        order = np.argsort(at, kind="stable")
        return at[order], pen[order]

    def flush(self, last: bool):
        """Yield the pieces of the finished windows; unless ``last``, the last window stays for what follows."""
        if not self.pending:
            return
        at, pen = self._points()
        ends = at[best_cuts(at, pen, self.size)].tolist()
        if last:
            a = ends[-2] if len(ends) > 1 else 0
            rest, tail = ends.pop() - a, []
            while rest:
                a += 1 << (rest.bit_length() - 1)
                rest -= 1 << (rest.bit_length() - 1)
                tail.append(a)
            ends += tail
        else:
            ends.pop()
        stream = np.concatenate(self.ids)
        begin, w, a = 0, 0, 0
        old, kept = list(zip(self.docs, self.ends, strict=True)), (stream, self.pending)
        self.ids, self.ends, self.docs, self.pending = [], [], [], 0
        for (doc, done, n, total), sentence in old:
            at_doc, done_here = begin, 0
            while done_here < n and w < len(ends):
                take = min(begin + n, ends[w]) - (begin + done_here)
                x = begin + done_here
                yield doc, done + done_here, stream[x:x + take], total, self.sequence, x - a
                done_here += take
                if x + take == ends[w]:
                    a, w = ends[w], w + 1
                    self.sequence += 1
            if done_here < n:
                self.add(doc, stream[at_doc + done_here:at_doc + n], sentence[sentence > done_here] - done_here, done + done_here, total)
            begin += n
        del kept


_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_path: str, size: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
         sentence_penalty: float = 8, word_penalty: float = 48, block: int = 1 << 19, cache_words: int = 800_000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    ``sentence_penalty`` and ``word_penalty``: how many ids of padding it is worth to spare a cut at a sentence's end,
    or inside a sentence.  ``cache_words``: words whose ids a Python worker keeps, at some 200 bytes each; fewer cost time only.
    """
    def run(batches):
        t = _tokenizer(tokenizer_path, cache_words)
        p = Packer(size, sentence_penalty, word_penalty, max(1, size // 64))
        base = TaskContext.get().partitionId() << 40

        def out(pieces):
            rows = list(pieces)
            if rows:
                doc, start, ids, total, seq, off = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array(total, pa.int64()),
                     pa.array([base + s for s in seq], pa.int64()), pa.array(off, pa.int64())],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for ids, texts in chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                every, n = t.encode([x.decode("utf-8", "replace") for x in texts])
                stop = np.cumsum(n)
                for doc, a, b in zip(ids, (stop - n).tolist(), stop.tolist(), strict=True):
                    own = np.append(every[a:b], np.int32(end_id))
                    p.add(doc, own, np.flatnonzero(t.sentence_end[own[:-1]]) + 1)
                    if p.pending >= block:
                        yield from out(p.flush(False))
        yield from out(p.flush(True))

    return id_and_text(docs, id_col, text_col).mapInArrow(run, _SCHEMA)


def crc32(ids: bytes) -> int:
    """Checksum of a piece's ids, as Spark's crc32 gives it."""
    return zlib.crc32(ids)
