"""Approximate nearest neighbours by inner product: a hash-prefix forest.

Rows are dealt by a hash of their id into shards of about ``shard_rows``, and a
shard's rows by length into at most 16 bands.  A shard's forest has ``trees``
sorted arrays of long hash strings, each band a stretch of its own in every
array: bit i of a string is the side of a random hyperplane that the vector lies
on.  A query descends in every tree and band to its longest matching prefix and
then all trees ascend together, one bit at a time, adding the rows of their wider
prefix ranges, until ``candidates`` different rows are found.  Candidates are
scored on the original vectors in double precision.

For inner products of vectors of unequal length, the strings are taken of
(x / M, sqrt(1 - |x|^2 / M^2)) with M the largest norm of the band, and of
(q / |q|, 0): the angle between these falls as the inner product rises, and as a
band is narrow, the last coordinate, which tells nothing of the query, is small.
The bands ascend by the inner product that they can still hold: with the least
product asked for falling, a band goes up one bit where prefixes of its length
would find a row of that product, at the angle that this is in the band, with a
probability below ``_SURE``.  So a band of short vectors is entered late.

The queries are a stated set (by default ids divisible by 20) and meet every
shard in blocks; a shard's index is the only thing a task keeps, and each block
returns at most ``k`` rows a query and shard.  Recall against brute force grows
with ``candidates`` and ``trees``; the tests measure it.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components, and a row without an id, takes no part, neither as a query nor as a
candidate; only vectors of one dimension meet; rows with the query's id are
its own and no candidates; repeated rows of other ids are candidates each;
fewer than ``k`` candidates are all returned; equal scores go to the smaller id; an empty table gives an empty
result; other input columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.vectors import matrix, usable

_BITS = 32
_BLOCK = 512
#: Probability with which one of the trees' prefixes is to match at the angle of the product asked for.
_SURE = 0.9
#: A band ends below this part of its largest norm, but has a sixteenth of the shard's rows at least.
_NARROW = 0.8
_BANDS = 16


def bands(norm: np.ndarray) -> np.ndarray:
    """First row of each band, and the number of rows; ``norm`` falls."""
    edge, least = [0], -(-len(norm) // _BANDS)
    while edge[-1] < len(norm):
        at = edge[-1]
        end = max(int(np.searchsorted(-norm, -_NARROW * norm[at], "right")), at + least)
        edge.append(end if len(norm) - end >= least else len(norm))
    return np.array(edge)


class Forest:
    """The index of one shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, trees: int, seed: int):
        norm = np.linalg.norm(x, axis=1)
        down = np.lexsort((ids, -norm))
        self.ids, self.x, norm = ids[down], x[down], norm[down]
        edge = bands(norm)
        sizes, longest = np.diff(edge), norm[edge[:-1]]
        m = np.repeat(np.where(longest > 0, longest, 1), sizes)
        part = np.minimum(norm / m, 1)
        self.planes = np.random.default_rng(seed).standard_normal((trees, x.shape[1] + 1, _BITS))
        self.band = np.arange(len(sizes), dtype=np.uint64) << np.uint64(_BITS)
        strings = self._strings(np.column_stack([self.x / m[:, None], np.sqrt(1 - part * part)])) | np.repeat(self.band, sizes)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.strings = np.take_along_axis(strings, self.order, axis=1)
        # a band goes up to each length of prefix (32 when it is entered) where the product falls below this
        rare = 1 - (1 - _SURE) ** (1 / trees)
        below = longest[:, None] * np.append(np.cos(np.pi * (1 - rare ** (1 / np.arange(1, _BITS + 1)))), 1.0)
        self.moved, length = np.unravel_index(np.argsort(-below, axis=None, kind="stable"), below.shape)
        steps = np.full((len(length) + 1, len(sizes)), _BITS + 1)
        steps[np.arange(1, len(length) + 1), self.moved] = length
        self.steps = np.minimum.accumulate(steps, axis=0)[1:]   # of each step every band's length, 33 before it is entered

    def _strings(self, x: np.ndarray) -> np.ndarray:
        weight = np.uint64(1) << np.arange(_BITS - 1, -1, -1, dtype=np.uint64)
        return np.stack([((x @ p > 0) * weight).sum(axis=1, dtype=np.uint64) for p in self.planes])

    def candidates(self, queries: np.ndarray, most: int):
        """For each query the rows found, as a boolean array."""
        s = self._strings(np.column_stack([queries / np.linalg.norm(queries, axis=1, keepdims=True), np.zeros(len(queries))]))
        trees, n = self.strings.shape
        need, order = min(most, n), self.order.ravel()
        low, size = [], []                                  # by length: tree, query, band
        for length in range(_BITS + 1):                     # prefix ranges, down to the length at which they hold too few
            mask = np.uint64(((1 << length) - 1) << (_BITS - length))
            rest = np.uint64((1 << (_BITS - length)) - 1)
            lo = np.stack([np.searchsorted(self.strings[t], (s[t] & mask)[:, None] | self.band, "left") for t in range(trees)])
            hi = np.stack([np.searchsorted(self.strings[t], (s[t] | rest)[:, None] | self.band, "right") for t in range(trees)])
            low.append(lo + n * np.arange(trees)[:, None, None])
            size.append(hi - lo)
            if (size[-1].sum(axis=(0, 2)) < need).all():
                break
        sizes = np.stack([k.sum(axis=0) for k in size], axis=2)
        every = np.arange(len(self.band))
        for q in range(len(queries)):
            few = np.flatnonzero(sizes[q].sum(axis=0) < need)
            deep = int(few[0]) if len(few) else len(size) - 1   # longer prefixes are not told apart
            at = np.where(self.steps > _BITS, deep + 1, np.minimum(self.steps, deep))
            held = np.append(sizes[q, :, :deep + 1], np.zeros((len(every), 1), np.int64), axis=1)
            # the first step whose ranges could hold enough; those of the steps before are inside them
            step = int(np.argmax(held[every, at].sum(axis=1) >= need))
            found, wider = np.zeros(n, bool), np.flatnonzero(at[step] <= deep)
            while True:
                for length in np.unique(at[step, wider]).tolist():
                    b = wider[at[step, wider] == length]
                    k = size[length][:, q, b].ravel()
                    end = np.cumsum(k)
                    found[order[np.arange(end[-1]) + np.repeat(low[length][:, q, b].ravel() - end + k, k)]] = True
                if step == len(at) - 1 or np.count_nonzero(found) >= need:
                    break
                step += 1
                b = self.moved[step]
                wider = self.moved[step:step + 1] if at[step, b] != at[step - 1, b] else wider[:0]
            yield found

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, most: int):
        """(query id, row id, score) of each query's best among its candidates."""
        for i, q, found in zip(ids.tolist(), queries, self.candidates(queries, most), strict=True):
            rows = np.flatnonzero(found & (self.ids != i))
            score = self.x[rows] @ q
            if len(rows) > k:
                cut = np.partition(score, len(score) - k)[len(score) - k]
                rows, score = rows[score >= cut], score[score >= cut]
            best = np.lexsort((self.ids[rows], -score))[:k]
            yield i, self.ids[rows[best]], score[best]


def _search(k: int, trees: int, most: int, seed: int):
    """Input sorted by shard, rows of the index before blocks of queries."""
    def run(batches):
        own, index, held = None, None, []
        for batch in batches:
            shard = batch.column(0).to_numpy()
            query = batch.column(1).to_numpy(zero_copy_only=False)
            edge = [0, *(np.flatnonzero((shard[1:] != shard[:-1]) | (query[1:] != query[:-1])) + 1).tolist(), batch.num_rows]
            for a, b in zip(edge, edge[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if shard[a] != own:
                    own, index, held = shard[a], None, []
                if not query[a]:
                    held.append((part.column(2).to_numpy(), matrix(part.column(3))))
                    continue
                if index is None and held:
                    index = Forest(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), trees, seed)
                    held = []
                if index is None:
                    continue
                for at in range(0, part.num_rows, _BLOCK):
                    some = part.slice(at, _BLOCK)
                    found = list(index.search(some.column(2).to_numpy(), matrix(some.column(3)), k, most))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]), pa.int64()),
                        pa.array(np.concatenate([f[1] for f in found]), pa.int64()), pa.array(np.concatenate([f[2] for f in found]), pa.float64())],
                        names=["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, queries: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            trees: int = 32, candidates: int = 4000, shard_rows: int = 8192, seed: int = 11) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best found for each query row (``queries``: a condition)."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x"),
                       F.coalesce(F.col(id_col) % 20 == 0 if queries is None else queries, F.lit(False)).alias("q"))
    v = v.where(F.col("id").isNotNull() & usable(F.col("x"))).withColumn("dim", F.size("x"))
    sizes = v.groupBy("dim").agg(F.count("*").alias("n")).collect()     # one row per dimension
    out = None
    for r in sizes:
        shards = -(-r["n"] // shard_rows)
        own = v.where(F.col("dim") == r["dim"])
        rows = own.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("query"), "id", "x")
        asked = own.where("q").dropDuplicates(["id"]).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("query"), "id", "x")
        both = rows.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "query", "id")
        found = both.mapInArrow(_search(k, trees, candidates, seed), "query_id long, vec_id long, score double")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
