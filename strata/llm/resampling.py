"""Importance resampling towards a target: array-scored weights, then a distributed quickselect.

A text's features are its runs of 1 to ``max_n`` consecutive words, joined by one space, repeats counted; a feature's
bucket is the unsigned crc32 of its UTF-8 bytes modulo ``buckets``.  With s of S features of the documents and t of T
features of the target in a bucket, its gain is ``floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))``, and a
text's weight is the sum of its features' gains: an array of ``buckets`` whole numbers, read once per distinct word of
a chunk and added up by document.  All texts are counted and all are scored.

A document's score is its weight and a Gumbel variate from its id, ``floor(-1000 ln(-ln((h + 0.5) / 2**32)))`` with h
the first 32 bits of sha256(``<seed>:<id>``).  The ``floor(percent N / 100)`` highest of the N documents with at least
``min_words`` words are drawn, which samples without replacement in proportion to exp(weight / 1000).

Quickselect.  The order is a composite key: score descending, then id (null first), then a hash of the text.  A round
takes some random keys that are still in question as pivots, and one aggregate counts exactly, for each, the keys
before it and those equal to it; that narrows the open interval around the k-th key, and ends once a pivot is the k-th
key itself (few open keys are all pivots).  Only the winners are sorted: dealt out by ranges of the key, ranked by
their place in their range and the sizes of the ranges before.

Bounds: the driver gets two arrays of ``buckets`` counts, the pivots of a round and the number of winners in each range.  Scores
(five numbers a row) are written to the checkpoint folder once, texts are not.

Defined cases: null and empty texts have no feature, weight 0 and a score, but are drawn only if ``min_words`` is 0; a
null id hashes as the text ``<seed>:``; rows equal in id and text have equal keys and a rank each, and if there is room for some
of them only, any of them are drawn; ties follow the composite key; very long texts are cut nowhere (a text is a chunk of its own);
an empty target leaves the gains of the documents' own rarity; an empty table gives an empty result; input columns
other than the id are not returned by ``resample``; ``drawn`` returns all columns of the drawn rows.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, id_and_text, over_texts
from strata.llm.ranks import ranked
from strata.llm.tokens import LETTERS_AND_DIGITS, Tokens, tokens

#: Pivot keys of a round.
_PIVOTS = 24
_KEY = ("down", "no_id", "id", "h")     # ascending; down is the score's negative, no_id 0 for a null id


def _features(t: Tokens, max_n: int, buckets: int):
    """(bucket, document) of each feature, as arrays, one pair for each number of words."""
    words = t.words
    crc = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    place, doc = t.code, t.doc
    yield crc[place] % buckets, doc
    for n in range(2, max_n + 1):
        same = t.doc[n - 1:] == t.doc[:len(t.doc) - n + 1]
        # a run is a run of one word less and the next word
        runs, place = np.unique(np.stack([place[:-1][same], t.code[n - 1:][same]]), axis=1, return_inverse=True)
        crc = np.array([zlib.crc32(b" " + words[w], int(crc[before])) for before, w in runs.T.tolist()], np.int64)
        at = np.flatnonzero(same)
        yield crc[place] % buckets, t.doc[at]
        whole = np.zeros(len(same), np.int64)
        whole[at] = place
        place = whole


def bucket_counts(texts: DataFrame, max_n: int, buckets: int) -> np.ndarray:
    """Features in each bucket, of all texts; (id, text) comes in.  A partition sends one array."""
    def count(batches):
        total = np.zeros(buckets, np.int64)

        def add(_, part):
            for b, _ in _features(tokens(part, LETTERS_AND_DIGITS), max_n, buckets):
                total[:] += np.bincount(b, minlength=buckets)
        for _ in over_texts(add)(batches):
            pass
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, from its features in the documents and in the target."""
    k = len(documents)
    s_all, t_all = int(documents.sum()) + k, int(target.sum()) + k
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(documents.tolist(), target.tolist(), strict=True)], np.int64)


def variate(seed: str, doc_id: int | None) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scores(gain: np.ndarray, max_n: int, seed: str):
    def run(rows, texts):
        t = tokens(texts, LETTERS_AND_DIGITS)
        n_words = np.bincount(t.doc, minlength=t.n_docs)
        n, weight = np.zeros(t.n_docs, np.int64), np.zeros(t.n_docs, np.int64)
        for b, doc in _features(t, max_n, len(gain)):
            n += np.bincount(doc, minlength=t.n_docs)
            np.add.at(weight, doc, gain[b])
        score = weight + np.array([variate(seed, r["id"]) for r in rows], np.int64)
        return pa.RecordBatch.from_arrays([pa.array([r["id"] for r in rows], pa.int64()), pa.array([r["h"] for r in rows], pa.int64()), *map(pa.array, (n_words, n, weight, score))],
                                          names=["id", "h", "n_words", "n_features", "weight", "score"])
    return over_texts(run)


def _before(at: tuple, equal: bool = False) -> Column:
    """The key comes before ``at`` (or is equal to it)."""
    out = F.lit(equal)
    for name, v in reversed(list(zip(_KEY, at, strict=True))):
        out = (F.col(name) < v) | ((F.col(name) == v) & out)
    return out


def kth_key(keys: DataFrame, k: int) -> tuple:
    """The ``k``-th (from 1) of at least ``k`` keys, the columns ``_KEY``; each round counts all of them exactly."""
    low: tuple | None = None        # the k-th key comes after low and before high
    high: tuple | None = None
    turn = 0
    while True:
        open_ = keys if low is None else keys.where(~_before(low, equal=True))
        open_ = open_ if high is None else open_.where(_before(high))
        pivots = sorted({tuple(r) for r in open_.select(*_KEY).orderBy(F.xxhash64(*_KEY, F.lit(turn))).limit(_PIVOTS).collect()})
        counted = keys.agg(*(F.count_if(_before(p, equal=e)).alias(f"c{i}{int(e)}") for i, p in enumerate(pivots) for e in (False, True))).first()
        for i, p in enumerate(pivots):
            less, upto = counted[f"c{i}0"], counted[f"c{i}1"]
            if less < k <= upto:
                return p
            if upto >= k:
                high = p
                break
            low = p
        turn += 1


def scored(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
           max_n: int = 1, buckets: int = 10_000, seed: str = "2024") -> DataFrame:
    """id, h (a hash of the text), n_words, n_features, weight, score of each row."""
    texts = id_and_text(docs, id_col, text_col)
    own = bucket_counts(texts, max_n, buckets)
    wanted = bucket_counts(target.select(F.lit(0).cast("long").alias("id"), F.coalesce(F.col(f"`{target_col}`"), F.lit("")).cast("binary").alias("text")), max_n, buckets)
    rows = texts.select(F.struct("id", F.xxhash64("text").alias("h")).alias("row"), "text")
    return rows.mapInArrow(_scores(gains(own, wanted), max_n, seed), "id long, h long, n_words long, n_features long, weight long, score long")


def _selected(docs: DataFrame, target: DataFrame, id_col: str, text_col: str, percent: int, min_words: int, **how) -> DataFrame:
    """The scored rows with rank (null: not drawn)."""
    undrawn = F.lit(None).cast("long")
    rows = checkpoint(scored(docs, target, id_col, text_col, **how))
    rows = rows.select(F.col("id").alias("own"), F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNotNull().cast("int").alias("no_id"), "h", "n_features", "weight", "score",
                       (-F.col("score")).alias("down"), (F.col("n_words") >= min_words).alias("long_enough"))
    keys = rows.where("long_enough")
    k = keys.count() * percent // 100
    if not k:
        return rows.withColumn("rank", undrawn)
    won = F.col("long_enough") & _before(kth_key(keys, k), equal=True)
    # of rows equal to the last key only as many as there is room for
    drawn_ = ranked(rows.where(won), [F.col(c) for c in _KEY]).withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return drawn_.unionByName(rows.where(~won).withColumn("rank", undrawn))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 10, min_words: int = 20, **how) -> DataFrame:
    """One row per row of ``docs``: id_col, n_features, weight, score, rank (1, 2, 3 ... of the drawn, else null)."""
    return _selected(docs, target, id_col, text_col, percent, min_words, **how).select(F.col("own").alias(id_col), "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 10, min_words: int = 20, **how) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns (rows equal in id and text come together)."""
    won = _selected(docs, target, id_col, text_col, percent, min_words, **how).where("rank is not null").select("own", "h").distinct()
    h = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"))
    rows = docs.withColumns({"__own": F.col(f"`{id_col}`").cast("long"), "__h": h})
    return rows.join(won, rows["__own"].eqNullSafe(won["own"]) & (rows["__h"] == won["h"]), "left_semi").drop("__own", "__h")
