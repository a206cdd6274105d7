"""Source divergence audit: how each source's words differ from those of the other sources and of its language.

Terms are runs of letters (A-Z, a-z, any character above 0x7F), A-Z lower-cased.  A language keeps the V terms that at
least ``min_docs`` of its documents hold.  In a group, a language's source or the whole language, a kept term with n of
the N occurrences of kept terms has the share ``p = 1 + floor(10**9 (n + 2) / (N + 2 V))``, also with n = 0; two shares
diverge by ``floor((p - q)**2 / (p + q))``.  All of it is whole-number arithmetic.

Method.
1. Documents per term: a chunk's words are coded by their bytes, counted once a document, added up by a shuffle.
2. The kept terms, each behind its language and a zero byte, are sorted as one table; ranges and their sizes give each
   its ordinal.  Every run of ``part_terms`` becomes a part of the vocabulary: a minimal acyclic transducer.
3. Recounting: a task sorts the words of a chunk, cuts them where parts begin (the parts' first terms, one in
   ``part_terms``, are all that the driver holds), and sends one line of words and counts for each source and part.  The
   lines stream past their part's transducer, which turns each word into its ordinal or drops it.  A part meets its
   lines in several streams (``__salt``), each a merge that holds one transducer and one batch.
4. Counts by source and ordinal are dealt into blocks of ``_BLOCK`` ordinals; a block is a small matrix of sources and
   terms that adds to every pair of sources and names its own ``top`` terms for every source.  Ordinals break ties,
   as they stand for the order of the terms.

The size of a block is that of the sources of one language; the result has a row for every two of these anyway.
Occurrences stay exact up to 9 * 10**15 kept words in a language.

Result: lang, source, part, item, value, rank.  Part ``pair``: item is each other source of the language, value the sum
over all kept terms.  Part ``term``: item is a kept term that the group holds with a greater share than its language,
value its divergence, ``top`` ranks.  Ranks are from 1, by value descending, then item by its UTF-8 bytes.

Defined cases: null texts, languages and sources count as empty; a group without terms has its pairs (0 if the language
keeps no term); a language with one source has no pairs; repeated rows are documents of their own; very long texts are
read whole; an empty table gives an empty result; other input columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, chunks
from strata.llm.ranks import ranked
from strata.llm.tokens import LETTERS, tokens
from strata.llm.transducer import Transducer, build

_CHUNK = 4 << 20
_BLOCK = 1024
_END = b"\0"        # between a language and a term; no term holds it


def _groups(batch: pa.RecordBatch, columns: list[int]) -> tuple[np.ndarray, list[tuple]]:
    """Of each row the number of its values in ``columns``, and these values."""
    known: dict[tuple, int] = {}
    of = [known.setdefault(v, len(known)) for v in zip(*(batch.column(c).to_pylist() for c in columns), strict=True)]
    return np.array(of, np.int64), list(known)


def _document_counts(batches):
    """(lang, term, documents that hold it) of each chunk, from (lang, source, text)."""
    for batch in batches:
        of, langs = _groups(batch, [0])
        names = pa.array([v for v, in langs], pa.string())
        for rows, texts in chunks(list(range(batch.num_rows)), batch.column(2).to_pylist(), _CHUNK):
            t = tokens(texts, LETTERS)
            n = max(1, len(t.vocabulary))
            once = np.unique(t.doc * n + t.code)
            held, docs = np.unique(of[rows][once // n] * n + once % n, return_counts=True)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(held // n)), t.vocabulary.take(pa.array(held % n)).cast(pa.binary()), pa.array(docs)], names=["lang", "term", "docs"])


def _part(rows: pa.Table) -> pa.Table:
    """(part, its first key, the ordinal before it, transducer) of one part's keys."""
    keys = sorted(rows.column("key").to_pylist())
    return pa.table({"part": pa.array([rows.column("part")[0].as_py()], pa.int64()), "first": pa.array([keys[0]], pa.binary()),
                     "base": pa.array([pc.min(rows.column("ordinal")).as_py()], pa.int64()), "machine": pa.array([build(keys).packed()], pa.binary())})


def _lines(firsts: list[bytes]):
    """(part, lang, source, words that may be in the part, their counts) of each chunk; ``firsts`` are the parts' first keys."""
    def cut(words: list[bytes], prefix: bytes):
        """(part, begin, end) of sorted words of one language."""
        part, at = max(0, bisect_right(firsts, prefix) - 1), 0
        while at < len(words):
            behind = firsts[part + 1] if part + 1 < len(firsts) else b""
            end = bisect_left(words, behind[len(prefix):], at) if behind.startswith(prefix) else len(words)
            if end > at:
                yield part, at, end
            part, at = part + 1, end

    def run(batches):
        for batch in batches:
            of, groups = _groups(batch, [0, 1])
            for rows, texts in chunks(list(range(batch.num_rows)), batch.column(2).to_pylist(), _CHUNK):
                t = tokens(texts, LETTERS)
                n = max(1, len(t.vocabulary))
                order = pc.array_sort_indices(t.vocabulary)
                words = t.vocabulary.take(order).to_pylist()
                rank = np.empty(len(words), np.int64)
                rank[order.to_numpy()] = np.arange(len(words))
                held, count = np.unique(of[rows][t.doc] * n + rank[t.code], return_counts=True)
                begin = np.flatnonzero(np.diff(held // n, prepend=-1))
                out = []
                for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(held)], strict=True):
                    lang, source = groups[held[a] // n]
                    own = [words[i] for i in (held[a:b] % n).tolist()]
                    out += [(part, lang, source, b"\n".join(own[x:y]), count[a + x:a + y]) for part, x, y in cut(own, lang.encode() + _END)]
                if out:
                    part, lang, source, line, counts = zip(*out, strict=True)
                    ends = np.cumsum([0, *map(len, counts)])
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(line, pa.binary()),
                                                      pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(counts), pa.int64()))],
                                                     names=["part", "lang", "source", "line", "counts"])
    return run


def _recounted(batches):
    """(lang, source, ordinal, n), from rows (part, salt, base, machine, lang, source, line, counts) in which a part's machine comes before its lines."""
    machine, base, ways = None, 0, {}

    def of_lines(rows: pa.RecordBatch):
        lang, lines = rows.column("lang").to_pylist(), rows.column("line").to_pylist()
        counts = rows.column("counts")
        size = pc.list_value_length(counts).to_numpy().astype(np.int64)
        for x in set(lang).difference(ways):
            ways[x] = machine.after(x.encode() + _END)
        buf = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
        end = np.flatnonzero(buf == 10)
        begin = np.concatenate([[0], end[:-1] + 1])
        state = np.repeat(np.array([(ways[x] or (0, 0))[0] for x in lang], np.int64), size)
        total = np.repeat(np.array([(ways[x] or (0, 0))[1] for x in lang], np.int64), size)
        known = np.repeat(np.array([ways[x] is not None for x in lang], bool), size)
        ordinal = np.where(known, machine.walk(buf, begin, end - begin, state, total), -1)
        held = np.flatnonzero(ordinal >= 0)
        row = pa.array(np.repeat(np.arange(len(lang)), size)[held])
        return pa.RecordBatch.from_arrays([rows.column("lang").take(row), rows.column("source").take(row), pa.array(base + ordinal[held]), counts.flatten().take(pa.array(held))],
                                          names=["lang", "source", "ordinal", "n"])

    for batch in batches:
        is_part = np.array(batch.column("machine").is_valid())
        at = 0
        for stop in [*np.flatnonzero(is_part).tolist(), batch.num_rows]:
            if stop > at:
                yield of_lines(batch.slice(at, stop - at))
            if stop < batch.num_rows:
                machine, base, ways = Transducer.unpacked(batch.column("machine")[stop].as_py()), batch.column("base")[stop].as_py(), {}
            at = stop + 1


def shares(count: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """``1 + floor(10**9 (count + 2) / whole)``, by long division in steps of 1000; count + 2 <= whole < 9.2 * 10**15."""
    rest, out = count + 2, np.zeros_like(count)
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return 1 + out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _block(top: int):
    """What a block adds to each pair of sources, and its own best terms of each source."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("other", pa.string()), ("ordinal", pa.int64()), ("value", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        head = rows.filter(pc.is_null(rows.column("ordinal")))
        rows = rows.filter(pc.is_valid(rows.column("ordinal")))
        lang, sources = head.column("lang")[0].as_py(), head.column("source").to_pylist()
        whole, all_ = head.column("n").to_numpy().astype(np.int64), head.column("whole")[0].as_py()
        place = {s: i for i, s in enumerate(sources)}
        terms, term = np.unique(rows.column("ordinal").to_numpy(), return_inverse=True)
        n = np.zeros((len(sources), len(terms)), np.int64)
        n[[place[s] for s in rows.column("source").to_pylist()], term] = rows.column("n").to_numpy()
        p, q = shares(n, whole[:, None]), shares(n.sum(axis=0), all_)
        out: list[tuple] = []
        for i, s in enumerate(sources):
            more = np.flatnonzero((n[i] > 0) & (p[i] > q))
            value = divergence(p[i, more], q[more])
            best = np.lexsort((terms[more], -value))[:top]
            out += [(lang, s, None, int(terms[more[j]]), int(value[j])) for j in best]
            out += [(lang, s, o, None, v) for o, v in zip(sources[i + 1:], divergence(p[i], p[i + 1:]).sum(axis=1).tolist(), strict=True)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 5, schema, strict=True)], schema=schema)
    return run


def kept_terms(texts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, key, ordinal from 0) of the terms that at least ``min_docs`` documents of the language hold, in the order of their keys."""
    found = texts.mapInArrow(_document_counts, "lang string, term binary, docs long").groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    key = F.concat(F.col("lang").cast("binary"), F.lit(_END), "term")
    return ranked(found.select("lang", "term", key.alias("key")), [F.col("key")], "ordinal").withColumn("ordinal", F.col("ordinal") - 1)


def recount(texts: DataFrame, kept: DataFrame, part_terms: int) -> DataFrame:
    """(lang, source, ordinal, n) of the kept terms, counted by streaming the texts' words through the transducers."""
    by_part = kept.withColumn("part", F.floor(F.col("ordinal") / part_terms))
    parts = checkpoint(by_part.select("part", "key", "ordinal").groupBy("part").applyInArrow(_part, "part long, first binary, base long, machine binary"))
    firsts = [r["first"] for r in parts.select("part", "first").orderBy("part").collect()]
    if not firsts:
        return texts.sparkSession.createDataFrame([], "lang string, source string, ordinal long, n long")
    salts = 1 + 2 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")) // len(firsts)
    machines = parts.select("part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt"), "base", "machine", F.lit(None).cast("string").alias("lang"),
                            F.lit(None).cast("string").alias("source"), F.lit(None).cast("binary").alias("line"), F.lit(None).cast("array<long>").alias("counts"))
    lines = texts.mapInArrow(_lines(firsts), "part long, lang string, source string, line binary, counts array<long>")
    lines = lines.select("part", F.pmod(F.spark_partition_id(), F.lit(salts)).alias("__salt"), F.lit(None).cast("long").alias("base"), F.lit(None).cast("binary").alias("machine"),
                         "lang", "source", "line", "counts")
    streams = machines.unionByName(lines).repartition("part", "__salt").sortWithinPartitions("part", "__salt", F.col("machine").isNull())
    return streams.mapInArrow(_recounted, "lang string, source string, ordinal long, n long").groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 10, top: int = 10,
                      part_terms: int = 16_384) -> DataFrame:
    """lang, source, part, item, value, rank; see above."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("")).alias("lang"), F.coalesce(F.col(f"`{source_col}`"), F.lit("")).alias("source"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))
    kept = checkpoint(kept_terms(texts, min_docs))
    counts = checkpoint(recount(texts, kept, part_terms))

    groups = texts.select("lang", "source").distinct()
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("v"))
    sums = groups.join(own, ["lang", "source"], "left").join(vocabulary, "lang", "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
    all_ = sums.groupBy("lang").agg((F.sum("n") + 2 * F.first("v")).alias("whole"))
    sums = checkpoint(sums.join(all_, "lang").select("lang", "source", (F.col("n") + 2 * F.col("v")).alias("n"), "whole"))

    rows = counts.withColumn("block", F.floor(F.col("ordinal") / _BLOCK))
    heads = rows.select("lang", "block").distinct().join(sums, "lang").select("lang", "block", "source", F.lit(None).cast("long").alias("ordinal"), "n", "whole")
    rows = rows.select("lang", "block", "source", "ordinal", "n", F.lit(None).cast("long").alias("whole")).unionByName(heads)
    found = checkpoint(rows.groupBy("lang", "block").applyInArrow(_block(top), "lang string, source string, other string, ordinal long, value long"))

    half = found.where("other is not null").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    both = half.unionByName(half.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))
    pairs = sums.select("lang", "source").join(sums.select("lang", F.col("source").alias("other")), "lang").where("source <> other").join(both, ["lang", "source", "other"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    best = found.where("other is null").withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal"))).where(F.col("rank") <= top)
    named = best.join(kept.select("ordinal", F.col("term").cast("string").alias("item")), "ordinal")
    return pairs.unionByName(named.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
