"""Substring dedup: words inside a window of ``width`` words that also starts earlier, found by FM-indexes per shard.

Method.
1. Every window of ``width`` consecutive words has a minimizer, the least of its ``k``-word shingles (rare before
   frequent, by a sketch of all texts' counts; then by hash).  Equal windows have equal minimizers.  Consecutive windows
   with the same minimizer form a segment of the text.  Documents are dealt into bundles; the minimizers alone are counted
   first, and the repeated ones go back to the bundles that hold them.
2. Segments with a repeated minimizer are dealt out by minimizer, so all occurrences of a window meet in one shard.
   Preferring rare shingles keeps a passage that very many documents share from drawing what stands around it into its
   shard; a segment that repeats inside a bundle is sent once.
3. A segment equal to an earlier one is covered by it.  The distinct rest of a shard, some hundred thousand words at a
   time with all segments of a minimizer together, becomes an FM-index: suffixes sorted to the depth of a window (ties
   in text order), the symbols before them in a wavelet matrix of packed bits with rank counts.  A symbol is a run of
   ``width / 4`` words, so a backward step moves that many words.
4. The shard's windows are streamed against the index: backward search from a window's last symbol, all windows
   together, dropping those whose interval holds no second suffix.  The number of symbols matched is its matching
   statistic; a window matched in full, whose interval's first suffix (the earliest in the corpus) is not itself, is reported.
5. Reported runs of windows are intervals of words; they meet their documents' bundles again, which lose them.

Order: by id (null first), then text hash for different texts under one id, then start.  Rows with equal id and
text are one document (and stand in one bundle) and get the same result.

Words are compared as bytes inside a shard.  Defined cases: a null or empty text has no words; a text of fewer words
than ``width`` loses nothing; any length of text works; an empty table gives an empty result; an input column named
like an output column is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.bundles import Bundles, once_per_bundle, repeated_keys
from strata.llm.common import chunks
from strata.llm.sketch import shingle_classes
from strata.llm.wordhash import U, hash_spans, mix, shingles, split_words

_SHARD_WORDS = 300_000


def minimizer_segments(texts: list[bytes], width: int, k: int, classes: np.ndarray):
    """(words, document, first word, words, minimizer) of the segments of a chunk."""
    w = split_words(texts, collapse=True)
    n = len(w.hash)
    if n < width:
        z = np.zeros(0, np.int64)
        return w, z, z, z, z
    h = shingles(w.hash, k)
    cls = classes[(h & U(len(classes) - 1)).astype(np.int64)].astype(U)
    key = (cls << U(58)) | (mix(h) >> U(6))
    span = width - k + 1
    at = np.lib.stride_tricks.sliding_window_view(key, span).argmin(axis=1) + np.arange(n - width + 1)
    doc = w.doc()
    whole = doc[:n - width + 1] == doc[width - 1:]
    start = np.flatnonzero(whole)
    if not len(start):
        z = np.zeros(0, np.int64)
        return w, z, z, z, z
    at = at[start]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(start) != 1)])
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(start)))
    begin = start[first]
    return w, doc[begin], begin, windows + width - 1, h[at[first]].view(np.int64)


def _gather(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the spans one after the other, and their offsets."""
    n = end - start
    off = np.concatenate([[0], np.cumsum(n)])
    return buf[np.repeat(start - off[:-1], n) + np.arange(off[-1])], off


def _binary(buf: np.ndarray, start: np.ndarray, end: np.ndarray, none: np.ndarray) -> pa.Array:
    """Spans as a binary array, null where ``none``."""
    data, off = _gather(buf, start, np.where(none, start, end))
    valid = np.packbits(~none, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(start), [pa.py_buffer(valid.tobytes()), pa.py_buffer(off.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


_SEGMENT = "m long, id long, h long, start int, n int, words binary"
_COVER = "id long, h long, start int, n int"


def _minimizers(width: int, k: int, classes: np.ndarray):
    """(m, 2 * bundle + 1 if it holds m more than once) of (bundle, text), once per chunk."""
    def run(batches):
        for batch in batches:
            bundle = batch.column(0).to_numpy().astype(np.int64)
            for rows, texts in chunks(list(range(batch.num_rows)), batch.column(1).to_pylist()):
                _, doc, _, _, m = minimizer_segments(texts, width, k, classes)
                if len(m):
                    yield once_per_bundle(m, bundle[rows][doc])
    return run


def _segments(text_col: str, width: int, k: int, classes: np.ndarray):
    """A bundle's segments with repeated minimizers; one that repeats an earlier one has null words: it is covered."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    schema = pa.schema(list(zip(["m", "id", "h", "start", "n", "words"], kinds, strict=True)))

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        known = np.sort(known.column("m").to_numpy())
        out = []
        if len(known) and docs.num_rows:
            docs = docs.select(["__id", "__h", text_col])
            docs = docs.take(pa.array(np.lexsort((docs.column(1).to_numpy(), docs.column(0).to_numpy()))))
            ids, hashes = docs.column(0).to_numpy(), docs.column(1).to_numpy()
            for rows, texts in chunks(list(range(docs.num_rows)), docs.column(2).to_pylist()):
                w, doc, begin, n, m = minimizer_segments(texts, width, k, classes)
                if not len(m):
                    continue
                ok = known[np.minimum(np.searchsorted(known, m), len(known) - 1)] == m
                if ok.any():
                    out.append(_marked(w, doc[ok], begin[ok], n[ok], m[ok], ids[rows], hashes[rows], schema))
        return pa.Table.from_batches(out, schema)
    return run


def _marked(w, doc, begin, n, m, ids, hashes, schema) -> pa.RecordBatch:
    a, b = w.start[begin], w.end[begin + n - 1]
    own, own_h = ids[doc], hashes[doc]
    start = begin - w.first[doc]
    _, first, back = np.unique(hash_spans(w.buf, a, b), return_index=True, return_inverse=True)
    first = first[back]
    again = np.flatnonzero(first != np.arange(len(first)))
    same = np.zeros(len(first), bool)
    if len(again):
        f = first[again]
        equal = (b - a)[again] == (b - a)[f]
        x, off = _gather(w.buf, a[again], np.where(equal, b[again], a[again]))
        y, _ = _gather(w.buf, a[f], np.where(equal, b[f], a[f]))
        wrong = np.concatenate([[0], np.cumsum(x != y)])
        same[again] = equal & (wrong[off[1:]] == wrong[off[:-1]])
    # the very same place (a repeated row) is no earlier place
    repeat = same & (own == own[first]) & (own_h == own_h[first]) & (start == start[first])
    m = np.where(same, mix(own_h.view(U) + start.astype(U)).view(np.int64), m)
    out = pa.RecordBatch.from_arrays([pa.array(m), pa.array(own), pa.array(own_h), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
                                      _binary(w.buf, a, b, same)], schema=schema)
    return out.filter(pa.array(~repeat)) if repeat.any() else out


class FmIndex:
    """FM-index over sequences of words, a symbol being ``stride`` words; answers queries of up to 4 symbols."""

    def __init__(self, words: np.ndarray, stride: int):
        """``words``: ids from 1, with a 0 after each sequence, also the last (so a query's symbols never reach the end)."""
        n = len(words)
        self.stride, self.n = stride, n

        def pair(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
            """Rank of a[i] followed by b[i + shift]."""
            tail = np.zeros(n, np.int64)
            tail[:max(0, n - shift)] = b[shift:] + 1
            return np.unique(a * (int(b.max()) + 2) + tail, return_inverse=True)[1].astype(np.int64)

        rank, have = words.astype(np.int64), 1
        one = rank
        while have < stride:
            step = min(have, stride - have)
            rank = pair(rank, rank if step == have else self._short(one, step, pair), have)
            have += step
        self.symbol = rank
        two = pair(rank, rank, stride)
        four = pair(two, two, 2 * stride)
        self.order = np.argsort(four, kind="stable")        # ties in text order
        before = np.full(n, int(rank.max()) + 1, np.int64)  # nothing before the first words
        before[stride:] = rank[:-stride] if n > stride else rank[:0]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(rank, minlength=int(rank.max()) + 2))])
        self._wavelet(before[self.order], int(before.max()))

    @staticmethod
    def _short(one: np.ndarray, step: int, pair) -> np.ndarray:
        """Rank of the ``step`` words from each position on."""
        out = one
        for j in range(1, step):
            out = pair(out, one, j)
        return out

    def _wavelet(self, seq: np.ndarray, top: int) -> None:
        self.levels = []
        n = len(seq)
        at = np.zeros(top + 1, np.int64)                    # where each symbol's run begins, level by level
        for bit in range(max(1, top.bit_length()) - 1, -1, -1):
            ones = ((seq >> bit) & 1).astype(bool)
            packed = np.packbits(np.concatenate([ones, np.zeros(64 - n % 64, bool)]), bitorder="little").view(np.uint64)
            count = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            zeros = n - int(ones.sum())
            self.levels.append((bit, packed, count, zeros))
            at = self._step(at, (np.arange(top + 1) >> bit) & 1, packed, count, zeros)
            seq = np.concatenate([seq[~ones], seq[ones]])
        self.begin = at

    @staticmethod
    def _step(pos, one, packed, count, zeros):
        word = pos >> 6
        r = count[word] + np.bitwise_count(packed[word] & ((U(1) << (pos & 63).astype(U)) - U(1))).astype(np.int64)
        return np.where(one, zeros + r, pos - r)

    def rank(self, symbol: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol among the first ``pos`` of the transformed text."""
        for bit, packed, count, zeros in self.levels:
            pos = self._step(pos, (symbol >> bit) & 1, packed, count, zeros)
        return pos - self.begin[symbol]

    def repeated(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows (by position) of 4 symbols that occur twice or more, and each one's earliest position.

        Backward search; a window leaves as soon as its interval holds one suffix: its matching statistic is too small.
        """
        s = self.stride
        symbol = self.symbol[window + 3 * s]
        low, high = self.first[symbol], self.first[symbol + 1]
        for back in (2, 1, 0):
            more = high - low > 1
            window, low, high = window[more], low[more], high[more]
            symbol = self.symbol[window + back * s]
            both = self.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low, high = self.first[symbol] + both[:len(symbol)], self.first[symbol] + both[len(symbol):]
        more = high - low > 1
        return window[more], self.order[low[more]]


def _index_shard(rows: list[tuple], width: int) -> list[tuple]:
    """Covered intervals among distinct segments (id, h, start, n, words), sorted within each minimizer."""
    number: dict[bytes, int] = {}
    ids, at, begin = [], 0, []
    for r in rows:
        ids += [number.setdefault(x, len(number) + 1) for x in r[4].split(b" ")]
        ids.append(0)
        begin.append(at)
        at = len(ids)
    words = np.array(ids, np.int64)
    index = FmIndex(words, width // 4)
    begin, n = np.array(begin), np.array([r[3] for r in rows])
    count = n - width + 1
    off = np.cumsum(count) - count
    window = np.repeat(begin - off, count) + np.arange(int(count.sum()))
    seg = np.repeat(np.arange(len(rows)), count)
    hit, first = index.repeated(window)
    of, of_first = seg[np.searchsorted(window, hit)], seg[np.searchsorted(window, first)]
    key = np.array([(r[0], r[1], r[2]) for r in rows], np.int64)
    place, other = key[of], key[of_first]
    place[:, 2] += hit - begin[of]
    other[:, 2] += first - begin[of_first]
    hit, of, place = (x[(place != other).any(axis=1)] for x in (hit, of, place))
    if not len(hit):
        return []
    new = np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(of) != 0)])
    run = np.flatnonzero(new)
    length = np.diff(np.append(run, len(hit))) + width - 1
    return [(*p, n) for p, n in zip(place[run].tolist(), length.tolist(), strict=True)]


def _shards(width: int):
    """Covers from segments that come sorted by minimizer and place."""
    def out(rows: list[tuple]):
        if rows:
            i, h, s, n = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(h, pa.int64()), pa.array(s, pa.int32()), pa.array(n, pa.int32())],
                                             names=["id", "h", "start", "n"])

    def run(batches):
        covers: list[tuple] = []
        shard: list[tuple] = []
        size = 0
        rest = None

        def work(table: pa.Table):
            nonlocal shard, size
            m = table.column(0).to_numpy()
            edge = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
            n = np.diff(np.append(edge, len(m)))
            keep = np.repeat(n > 1, n)
            lone = table.column(5).is_null().to_numpy() & ~keep
            covers.extend(zip(*(table.column(c).filter(pa.array(lone)).to_pylist() for c in range(1, 5)), strict=True))
            if not keep.any():
                return
            table = table.filter(pa.array(keep))
            own, group, seen = None, [], {}
            for mm, *place, words in zip(*(table.column(c).to_pylist() for c in range(6)), strict=True):
                if mm != own:
                    if len(group) > 1:
                        shard += group
                        size += sum(g[3] for g in group)
                    if size > _SHARD_WORDS:
                        covers.extend(_index_shard(shard, width))
                        shard, size = [], 0
                    own, group, seen = mm, [], {}
                place = tuple(place)
                if words is None:
                    covers.append(place)
                elif words not in seen:
                    seen[words] = place[:3]
                    group.append((*place, words))
                elif seen[words] != place[:3]:
                    covers.append(place)
            if len(group) > 1:
                shard += group
                size += sum(g[3] for g in group)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            m = table.column(0).to_numpy()
            last = int(np.searchsorted(m, m[-1])) if len(m) else 0   # the last minimizer may go on
            rest = table.slice(last)
            if last:
                work(table.slice(0, last))
            if len(covers) > 50_000:
                yield from out(covers)
                covers.clear()
        if rest is not None and rest.num_rows:
            work(rest)
        if shard:
            covers.extend(_index_shard(shard, width))
        yield from out(covers)
    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 20, k: int = 4,
                    words_col: str = "n_words", removed_col: str = "n_removed", separator: str = " ") -> DataFrame:
    """``docs`` without the covered words: the text is the remaining words joined by ``separator``; two counts are added."""
    if width % 4:
        raise ValueError("width must be a multiple of 4")
    b = Bundles(docs, id_col, text_col, [words_col, removed_col])
    classes = shingle_classes(b.texts(), k, False)
    known = repeated_keys(b.texts().mapInArrow(_minimizers(width, k, classes), "m long, v long"))
    segments = b.with_keys(known, _segments(b.text_col, width, k, classes), _SEGMENT)
    covers = segments.repartition("m").sortWithinPartitions("m", "id", "h", "start").mapInArrow(_shards(width), _COVER)

    def cut(text: str | None, places: set) -> tuple[str | None, int, int]:
        words = (text or "").encode("utf-8", "surrogatepass").split()       # bytes: white space is 0x20 and 0x09-0x0D
        total = len(words)
        if places:
            keep = np.ones(total, bool)
            for start, n in places:
                keep[start:start + n] = False
            words = [w for w, ok in zip(words, keep.tolist(), strict=True) if ok]
        kept = None if text is None else separator.encode().join(words).decode("utf-8", "surrogatepass")
        return kept, total, total - len(words)

    return b.rewritten(covers, ["start", "n"], cut, [words_col, removed_col])
