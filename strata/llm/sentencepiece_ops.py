"""SentencePiece encoding and decoding with a batched numpy Viterbi.

The model file's pieces and scores are read; the segmentation is that of its
kind, BPE with byte fallback.  Instead of merging, the lattice of all pieces is
searched: a path is feasible where every two neighbouring pieces are stable,
that is, merging their joined text gives just these two.  For BPE the last piece
of every prefix is then unique, so for each end position one backpointer (the
longest feasible last piece) is the whole Viterbi state.

A text is first cut wherever two neighbouring characters stand side by side in no
piece; nothing can merge across such a place.  These words are taken by equal
length and advance together, one end position after the other: the hashes of all
substrings that end there probe the sorted array of piece keys, the stability of
the new pair is looked up, and the maximum over the piece's length is stored as
backpointer.  Each word is encoded once per worker (a bounded table).

Stability is decided for many pairs at once by undoing merges along the seam,
the later first: before a merge of rank r, the two symbols at the seam must not
have had a merge of their own that comes earlier (a lower rank; at equal ranks
the one further left).  Pairs of runs of the space mark, whose pieces share one
score, are merged outright.

A character that no piece covers becomes its UTF-8 bytes' pieces.  Decoding puts
the pieces' bytes together, reads the space mark as a space and takes off the
one put in front.  decode(encode(text)) is the text, for the identity normalisation
that the model must have; only the space mark itself (U+2581) comes back as a
space, as it does from the library.

Defined cases: null text gives null ids, empty text an empty list; null ids
give null text; a word of any length works (its positions are worked off one
by one); repeated rows, ties and null ids of rows are kept as they are; an empty
table gives an empty result; an input column named like the output is replaced.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from strata.llm.common import others
from strata.llm.wordcache import WordCache, flat
from strata.llm.wordhash import U, _powers, mix

SPACE = "▁"
_NONE = -1          # no piece
_START = -2         # before the first piece
_CHAR0 = 1 << 32    # an uncovered character is _CHAR0 + its code point
_SLOTS = 1 << 20    # of the table of known pairs


class PieceModel:
    def __init__(self, path: str, limit: int = 250_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, kind = proto.normalizer_spec, pb.ModelProto.SentencePiece
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or proto.trainer_spec.model_type != pb.TrainerSpec.BPE:
            raise ValueError("a BPE model without text normalisation is needed")
        self.dummy_prefix = norm.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        self.score = {p.piece: p.score for p in proto.pieces if p.type == kind.NORMAL}
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kind.NORMAL}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kind.BYTE}
        self.unknown = next((i for i, p in enumerate(proto.pieces) if p.type == kind.UNKNOWN), 0)
        self.longest = max(map(len, self.id))
        self.raw = [bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE else p.piece.replace(SPACE, " ").encode() if p.type == kind.NORMAL
                    else " ⁇ ".encode() if p.type == kind.UNKNOWN else b"" for p in proto.pieces]
        self._merge_trees()
        self._neighbours()
        keys = self._finish(self.sums[list(self.id.values())], self.lengths[list(self.id.values())])
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(list(self.id.values()), np.int64)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.pair_key, self.pair_ok = np.full(_SLOTS, -1, np.int64), np.zeros(_SLOTS, bool)
        self.cache = WordCache(lambda words: flat(self.encode_words(words)), limit)

    def _merge_trees(self) -> None:
        """Of each symbol (pieces, then characters of pieces that are none themselves): rank, last merge, hash sum, length, whether merging makes it."""
        names = self.pieces + sorted({c for p in self.id for c in p} - set(self.id))
        number = {p: i for i, p in enumerate(names) if p in self.id or i >= len(self.pieces)}
        ranks = {x: i for i, x in enumerate(sorted(set(self.score.values()), reverse=True))}
        n = len(names)
        self.rank, self.left, self.right = np.full(n, -1, np.int64), np.arange(n), np.arange(n)
        self.sums, self.lengths, self.made = np.zeros(n, U), np.ones(n, np.int64), np.zeros(n, bool)
        for p, i in number.items():
            self.sums[i] = self._sums(np.array([ord(c) for c in p], np.uint32))[-1]
            self.lengths[i] = len(p)
            if len(p) > 1:
                self.rank[i] = ranks[self.score[p]]
            last: list[tuple[str, str]] = []
            self.made[i] = self.merged(p, last) == [p]
            if last and self.made[i]:
                self.left[i], self.right[i] = number[last[-1][0]], number[last[-1][1]]
        self.tied = ranks.get(min(self.score.values()))     # the score that several pieces share, if any does

    def _neighbours(self) -> None:
        """Which characters stand side by side inside some piece."""
        chars = sorted({c for p in self.id for c in p})
        self.char = np.zeros(0x110000, np.int32)
        self.char[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.beside = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in self.id:
            c = self.char[[ord(x) for x in p]]
            self.beside[c[:-1], c[1:]] = True

    # -- piece keys -------------------------------------------------------
    @staticmethod
    def _sums(code: np.ndarray) -> np.ndarray:
        """Prefix sums of code points times powers, along the last axis, with a zero in front."""
        up, _ = _powers(code.shape[-1] + 1)
        out = np.zeros((*code.shape[:-1], code.shape[-1] + 1), U)
        np.cumsum(mix(code.astype(U)) * up[:-1], axis=-1, out=out[..., 1:], dtype=U)
        return out

    @staticmethod
    def _finish(total: np.ndarray, length) -> np.ndarray:
        return mix(total + np.asarray(length, U) * U(0xE7037ED1A0B428DB))

    def probe(self, key: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ids[at], _NONE)

    # -- stability of pairs -------------------------------------------------
    def merged(self, text: str, log: list | None = None) -> list[str]:
        """BPE of a short text: the best-scored neighbours are merged first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = max((self.score.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best[0] == -np.inf:
                break
            i = -best[1]
            if log is not None:
                log.append((parts[i], parts[i + 1]))
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _seams(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether nothing merges across the seam of a and b (two symbols that merging makes)."""
        ok = np.ones(len(a), bool)
        rows = np.arange(len(a))
        for i in np.flatnonzero((self.rank[a] == self.tied) | (self.rank[b] == self.tied)).tolist():
            want = [self.pieces[a[i]], self.pieces[b[i]]]
            ok[i] = self.merged("".join(want)) == want
            a[i] = b[i] = 0
        rows = rows[(a != 0) | (b != 0)]
        a, b = a[rows], b[rows]
        up, _ = _powers(self.longest + 1)
        bound = np.full(len(rows), np.iinfo(np.int64).max)
        while len(rows):
            both = self.probe(self._finish(self.sums[a] + self.sums[b] * up[self.lengths[a]], self.lengths[a] + self.lengths[b]))
            merge = np.where(both == _NONE, np.iinfo(np.int64).max, self.rank[both])
            bad = merge < bound
            ok[rows[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            in_a = ra > rb
            go = ~bad & (in_a | (rb >= 0))
            bound = np.where(in_a, ra, rb + 1)[go]
            a, b = np.where(in_a, self.right[a], a)[go], np.where(in_a, b, self.left[b])[go]
            rows = rows[go]
        return ok

    def stable(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether merging the text of (before, piece) gives these two (or, at the start, this one)."""
        out = np.ones(len(piece), bool)
        known = piece < _CHAR0
        out[known] = self.made[piece[known]]
        pairs = np.flatnonzero(out & known & (before >= 0) & (before < _CHAR0))
        if len(pairs):
            key = before[pairs] * len(self.rank) + piece[pairs]
            slot = (mix(key.view(U)) & U(_SLOTS - 1)).astype(np.int64)
            got = self.pair_ok[slot]
            new = np.flatnonzero(self.pair_key[slot] != key)
            if len(new):
                fresh, back = np.unique(key[new], return_inverse=True)
                ok = self._seams(fresh // len(self.rank), fresh % len(self.rank))
                got[new] = ok[back]
                at = (mix(fresh.view(U)) & U(_SLOTS - 1)).astype(np.int64)
                self.pair_key[at], self.pair_ok[at] = fresh, ok
                clash = self.pair_key[at] != fresh      # of two in one slot the last stays, with its own answer
                self.pair_ok[at[~clash]] = ok[~clash]
            out[pairs] = got
        return out

    # -- encoding -----------------------------------------------------------
    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(words)
        length = np.array([len(w) for w in words])
        for n in np.unique(length).tolist():
            rows = np.flatnonzero(length == n)
            step = max(1, 500_000 // max(n, 1))
            for a in range(0, len(rows), step):
                part = rows[a:a + step]
                for i, ids in zip(part.tolist(), self._viterbi([words[i] for i in part], n), strict=True):
                    out[i] = ids
        return out

    def _viterbi(self, words: list[str], n: int) -> list[np.ndarray]:
        if not n:
            return [np.zeros(0, np.int32) for _ in words]
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n)
        total = self._sums(code)
        _, down = _powers(n + 1)
        last = np.full((n + 1, len(words)), _START, np.int64)
        back = np.zeros((n + 1, len(words)), np.int32)
        for end in range(1, n + 1):
            for size in range(1, min(end, self.longest) + 1):
                piece = self.probe(self._finish((total[:, end] - total[:, end - size]) * down[end - size], size))
                if size == 1:
                    piece = np.where(piece == _NONE, _CHAR0 + code[:, end - 1].astype(np.int64), piece)
                some = np.flatnonzero(piece != _NONE)
                if not len(some):
                    continue
                fits = some[self.stable(last[end - size, some], piece[some])]
                back[end, fits] = size                    # sizes rise, so the longest stays
                last[end, fits] = piece[fits]
        out: list[list[int]] = [[] for _ in words]
        at = np.full(len(words), n)
        rows = np.arange(len(words))
        while len(rows):
            piece = last[at[rows], rows]
            for r, p in zip(rows.tolist(), piece.tolist(), strict=True):
                if p >= _CHAR0:
                    raw = chr(p - _CHAR0).encode("utf-8", "surrogatepass")
                    out[r] += [self.byte[b] for b in reversed(raw)] if self.byte else [self.unknown]
                else:
                    out[r].append(p)
            at[rows] -= back[at[rows], rows]
            rows = rows[at[rows] > 0]
        return [np.array(x[::-1], np.int32) for x in out]

    def words(self, texts: list[str]) -> tuple[list[str], list[int]]:
        """All words of the texts, and how many each text has."""
        marked = [((" " + t) if self.dummy_prefix and t else t).replace(" ", SPACE) for t in texts]
        every = "".join(marked)
        if not every:
            return [], [0] * len(texts)
        char = self.char[np.frombuffer(every.encode("utf-32-le", "surrogatepass"), np.uint32)]
        cut = np.ones(len(every) + 1, bool)
        cut[1:-1] = ~self.beside[char[:-1], char[1:]]
        edge = np.cumsum([0, *map(len, marked)])
        cut[edge] = True
        at = np.flatnonzero(cut)
        words = [every[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return words, np.diff(np.searchsorted(at, edge)).tolist()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        words, per = self.words(texts)
        ids, n = self.cache.ids(words)
        edge = np.concatenate([[0], np.cumsum(n)])[np.cumsum([0, *per])]
        return [ids[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]

    def decode(self, ids) -> str:
        text = b"".join([self.raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


@functools.cache
def _model(path: str) -> PieceModel:
    return PieceModel(path)


def _runs(texts: list, limit: int = 1 << 20):
    """Slices of a batch of about ``limit`` bytes."""
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t is not None else 0
        if size > limit:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def _lists(ids: list) -> pa.Array:
    """Id arrays (or None) as a list column."""
    some = [x for x in ids if x is not None]
    offsets = np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in ids])]).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.int32), *some])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array([x is None for x in ids], pa.bool_()))


def with_pieces(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``docs`` with the piece ids of each text, and with ``decoded_col`` also the text that is read back from the ids.

    Works on about a megabyte of text at a time, whatever the batches' size.
    """
    made = [StructField(ids_col, ArrayType(IntegerType()))] + ([StructField(decoded_col, StringType())] if decoded_col else [])
    rest = others(docs, [f.name for f in made])
    name = next(c for c in docs.columns if c.lower() == text_col.lower())
    source = docs.select(*(F.col(f"`{c}`") for c in rest), F.col(f"`{name}`").cast("binary").alias("__text"))
    schema = StructType([f for f in docs.schema.fields if f.name in rest] + made)

    def run(batches):
        m = _model(model_path)
        for batch in batches:
            at = batch.schema.get_field_index("__text")
            raw = batch.column(at).to_pylist()
            for a, b in _runs(raw):
                got = iter(m.encode([t.decode("utf-8", "replace") for t in raw[a:b] if t is not None]))
                ids = [None if t is None else next(got) for t in raw[a:b]]
                part = batch.slice(a, b - a)
                columns = [part.column(i) for i in range(at)] + [_lists(ids)]
                if decoded_col is not None:
                    columns.append(pa.array([None if x is None else m.decode(x.tolist()) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
    return source.mapInArrow(run, schema)


def decode_pieces(ids: Column, model_path: str) -> Column:
    """Text of a column of piece ids."""
    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        m = _model(model_path)
        return pd.Series([None if x is None else m.decode(x.tolist()) for x in column], dtype=object)
    return text(ids)
