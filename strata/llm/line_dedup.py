"""Line dedup: repeated multi-line chunks between content-defined cuts.

A text is cut into chunks of whole lines behind every line at which a rolling hash over the last ``window`` line hashes
is divisible by ``divisor``, so the cuts depend on the lines around them and not on how many lines stand before: a
passage that has moved is cut at the same places.  A chunk has at least two lines: a one-line chunk joins the next one (the
text's last joins the one before).  A chunk that is not all white space and that another document, or an earlier place of
the same one, also holds is removed; its first occurrence (smallest id, then text hash, then line) stays.

A passage rarely begins and ends at a cut.  So a matched chunk grows: the lines before it, back to the chunk before, and
those behind it, up to the end of the next chunk, are compared byte by byte with the lines around the first occurrence, and as many as
agree go, too.  A removed line always stands at an earlier place of the corpus, at the same distance, so the first
occurrence of a line never goes.

Documents are dealt into bundles.  The hashes of chunks alone are counted first, and the repeated ones go back to the
bundles that hold them.  A bundle sends the first place of each such chunk, with its bytes and the lines around it; where
these meet, the first of all is chosen for each content (bytes decide, not hashes) and goes back to every bundle that
asked.  There each place is compared with it and cut.  So a chunk that very many documents share sends two rows per bundle,
and its places are compared where the texts are.

Rows with equal id and equal text are one document and get the same result.

Defined cases: null text stays null and empty text stays empty, with 0 lines removed; a null id is smallest; a text of
one line is one chunk of one line and loses nothing; very long texts are cut like others, one document being the least
that a task holds; ties follow the order of places; an empty table gives an empty result; an input column named like an
output column is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from strata.llm.bundles import Bundles, once_per_bundle, repeated_keys
from strata.llm.common import chunks
from strata.llm.wordhash import U, hash_spans, mix

_BREAK = 10


def line_chunks(texts: list[bytes], window: int, divisor: int):
    """(buf, start and end byte of every line, document, first and last line of every chunk); lines count through all texts."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    end = np.flatnonzero(buf == _BREAK)
    start = np.concatenate([[0], end[:-1] + 1])
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(start, at)                      # of each text its first line
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    h = hash_spans(buf, start, end)
    roll = h.copy()
    for j in range(1, window):
        before = np.concatenate([np.zeros(min(j, len(h)), U), h[:-j]])[:len(h)]
        before[np.arange(len(h)) - first[doc] < j] = 0      # of this text only
        roll = mix(roll * U(0x9FB21C651E98DF25) + before)
    cut = mix(roll) % U(divisor) == 0
    cut[first[1:] - 1] = True                               # a text ends with its last line
    begins, lasts, begin = [], [], 0
    ends = set((first[1:] - 1).tolist())
    for last in np.flatnonzero(cut).tolist():
        if last in ends:
            if last == begin and begins and doc[begins[-1]] == doc[last]:
                lasts[-1] = last                            # one line is left: it joins the chunk before
            else:
                begins.append(begin)
                lasts.append(last)
            begin = last + 1
        elif last > begin:                                  # a one-line chunk joins the next
            begins.append(begin)
            lasts.append(last)
            begin = last + 1
    begins, lasts = np.array(begins, np.int64), np.array(lasts, np.int64)
    return buf, start, end, doc[begins], begins, lasts, first


def _removable(buf: np.ndarray, start: np.ndarray, end: np.ndarray, begin: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places of the chunks of several lines that are not all white space."""
    dark = np.concatenate([[0], np.cumsum(~np.isin(buf, [9, 10, 11, 12, 13, 32]))])
    return np.flatnonzero((last > begin) & (dark[end[last]] > dark[start[begin]]))


def _hashes(window: int, divisor: int):
    """(chunk, 2 * bundle + 1 if it holds the chunk more than once) of (bundle, text)."""
    def run(batches):
        for batch in batches:
            bundle = batch.column(0).to_numpy().astype(np.int64)
            for rows, texts in chunks(list(range(batch.num_rows)), batch.column(1).to_pylist()):
                buf, start, end, doc, begin, last, _ = line_chunks(texts, window, divisor)
                some = _removable(buf, start, end, begin, last)
                if len(some):
                    yield once_per_bundle(hash_spans(buf, start[begin[some]], end[last[some]]).view(np.int64), bundle[rows][doc[some]])
    return run


_FIRST = "chunk long, id long, h long, line int, bytes binary, before binary, behind binary"


def _matched(docs: pa.Table, known: np.ndarray, text_col: str, window: int, divisor: int):
    """(row, first line in its text, lines, hash, bytes, lines before, lines behind) of the chunks whose hash is in the sorted ``known``, by document and line."""
    if not len(known) or not docs.num_rows:
        return
    order = np.lexsort((docs.column("__h").to_numpy(), docs.column("__id").to_numpy()))
    for rows, texts in chunks(order.tolist(), docs.column(text_col).take(pa.array(order)).to_pylist()):
        buf, start, end, doc, begin, last, first = line_chunks(texts, window, divisor)
        some = _removable(buf, start, end, begin, last)
        h = hash_spans(buf, start[begin[some]], end[last[some]]).view(np.int64)
        hit = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
        for i, own in zip(some[hit].tolist(), h[hit].tolist(), strict=True):
            a, b, d = begin[i], last[i], doc[i]
            before = buf[start[begin[i - 1]]:start[a]].tobytes() if i and doc[i - 1] == d else b""       # each line with its break
            behind = buf[end[b]:end[last[i + 1]]].tobytes() if i + 1 < len(doc) and doc[i + 1] == d else b""
            yield rows[d], int(a - first[d]), int(b - a + 1), own, buf[start[a]:end[b]].tobytes(), before, behind


def _firsts(text_col: str, window: int, divisor: int):
    """A bundle's first place of each content of a chunk with a repeated hash."""
    schema = pa.schema([("chunk", pa.int64()), ("id", pa.int64()), ("h", pa.int64()), ("line", pa.int32()), ("bytes", pa.binary()), ("before", pa.binary()), ("behind", pa.binary()), ("b", pa.int64())])

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        ids, hashes, bundle = docs.column("__id").to_pylist(), docs.column("__h").to_pylist(), docs.column("__b").to_pylist()
        seen: set[bytes] = set()
        out = []
        for row, line, _, h, data, before, behind in _matched(docs, np.sort(known.column("m").to_numpy()), text_col, window, divisor):
            if data not in seen:
                seen.add(data)
                out.append((h, ids[row], hashes[row], line, data, before, behind, bundle[row]))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 8, schema, strict=True)], schema=schema)
    return run


def _first_of_all(batches):
    """Each bundle's row with the first place of its content instead of its own, from rows sorted by chunk and place; a content of one row is left out if it is alone there."""
    own, seen = None, {}
    for batch in batches:
        out = []
        for chunk, *place, data, before, behind, b in zip(*(batch.column(c).to_pylist() for c in range(8)), strict=True):
            if chunk != own:
                own, seen = chunk, {}
            out.append((chunk, *seen.setdefault(data, (*place, data, before, behind)), b))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 8, batch.schema, strict=True)], schema=batch.schema)


def _common_tail(a: bytes, b: bytes) -> int:
    """Lines at the end of ``a`` and ``b``, each line with its break, that are equal."""
    n = 0
    for x, y in zip(reversed(a.split(b"\n")[:-1]), reversed(b.split(b"\n")[:-1]), strict=False):
        if x != y:
            break
        n += 1
    return n


def _common_head(a: bytes, b: bytes) -> int:
    """Lines at the begin of ``a`` and ``b``, each line after its break, that are equal."""
    n = 0
    for x, y in zip(a.split(b"\n")[1:], b.split(b"\n")[1:], strict=False):
        if x != y:
            break
        n += 1
    return n


def _cut(rest: list[str], text_col: str, removed_col: str, window: int, divisor: int):
    """A bundle's documents without the chunks, and the lines around them, that stand at an earlier place."""
    def run(docs: pa.Table, firsts: pa.Table) -> pa.Table:
        first = {data: ((i, h, line), before, behind) for i, h, line, data, before, behind in
                 zip(*(firsts.column(c).to_pylist() for c in ("id", "h", "line", "bytes", "before", "behind")), strict=True)}
        ids, hashes = docs.column("__id").to_pylist(), docs.column("__h").to_pylist()
        gone: dict[int, list[tuple[int, int]]] = {}
        for row, line, n, _, data, before, behind in _matched(docs, np.unique(firsts.column("chunk").to_numpy()), text_col, window, divisor):
            place, head, tail = first.get(data, (None, b"", b""))
            if place is not None and place != (ids[row], hashes[row], line):
                up = _common_tail(before, head)
                gone.setdefault(row, []).append((line - up, line + n + _common_head(behind, tail)))
        texts, removed = docs.column(text_col).to_pylist(), [0] * docs.num_rows
        for row, spans in gone.items():
            lines = texts[row].split(b"\n")
            keep = [True] * len(lines)
            for a, b in spans:
                keep[a:b] = [False] * (b - a)
            texts[row], removed[row] = b"\n".join([x for x, ok in zip(lines, keep, strict=True) if ok]), keep.count(False)
        kept = [pa.array(texts, pa.binary()) if c == text_col else docs.column(c) for c in rest]
        return pa.Table.from_arrays([*kept, pa.array(removed, pa.int64())], names=[*rest, removed_col])
    return run


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 1, divisor: int = 2,
               removed_col: str = "lines_removed") -> DataFrame:
    """``docs`` without repeated chunks and what continues them: the text replaced, the number of removed lines added."""
    bundles = Bundles(docs, id_col, text_col, [removed_col])
    name = bundles.text_col
    known = repeated_keys(bundles.texts().mapInArrow(_hashes(window, divisor), "m long, v long"))
    # texts travel as bytes: the lines are cut and compared as such
    base = bundles.base.withColumn(name, F.col(f"`{name}`").cast("binary"))
    found = base.groupBy("__b").cogroup(known.groupBy("b")).applyInArrow(_firsts(name, window, divisor), _FIRST + ", b long")
    firsts = found.repartition("chunk").sortWithinPartitions("chunk", "id", "h", "line").mapInArrow(_first_of_all, _FIRST + ", b long")
    schema = StructType([StructField(f.name, BinaryType()) if f.name == name else f for f in bundles.base.schema.fields if f.name in bundles.rest] + [StructField(removed_col, LongType())])
    out = base.groupBy("__b").cogroup(firsts.groupBy("b")).applyInArrow(_cut(bundles.rest, name, removed_col, window, divisor), schema)
    return out.withColumn(name, F.col(f"`{name}`").cast("string"))
