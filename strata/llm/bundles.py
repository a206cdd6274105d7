"""Documents dealt into bundles, so that what is found about them elsewhere can come back to their texts.

A bundle is a part of the corpus by a hash of id and text: some bundles per shuffle partition, and as many more as keep it
at a few megabytes of input.  Both visits to the texts, the one
that takes out what repeats and the one that rewrites them, read the same exchange of the documents, so the texts are
shuffled once.  Keys are counted without texts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.llm.common import others

#: Stands for a null id, which is smallest.
LEAST = -(1 << 63)
_PER_PARTITION = 16
#: Input bytes (as stored) to a bundle at most on average, as a bundle is held in memory.
_BUNDLE_BYTES = 16 << 20


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files and tables that ``df`` reads, from the plan's own statistics: no job.  Leaves of unknown size count nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(n for n in sizes if n < 1 << 60)


def once_per_bundle(key: np.ndarray, bundle: np.ndarray) -> pa.RecordBatch:
    """(m, 2 * bundle + 1 if it holds m more than once)."""
    order = np.lexsort((bundle, key))
    key, bundle = key[order], bundle[order]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (bundle[1:] != bundle[:-1])]))
    many = np.diff(np.append(first, len(key))) > 1
    return pa.RecordBatch.from_arrays([pa.array(key[first]), pa.array(2 * bundle[first] + many)], names=["m", "v"])


def _repeated(batches):
    """(b, m) of keys that occur more than once, from rows sorted by m; a key's rows are at most one per bundle and chunk."""
    rest = np.zeros((2, 0), np.int64)

    def some(m, v):
        first = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
        n = np.diff(np.append(first, len(m)))
        keep = np.repeat((n > 1) | (v[first] % 2 == 1), n)      # a lone row says by itself whether its bundle holds m twice
        pairs = np.unique(np.stack([v[keep] // 2, m[keep]]), axis=1) if keep.any() else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["b", "m"])

    for batch in batches:
        both = np.concatenate([rest, np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])], axis=1)
        if not both.shape[1]:
            continue
        last = int(np.searchsorted(both[0], both[0, -1]))
        rest = both[:, last:]
        if last:
            yield some(*both[:, :last])
    if rest.shape[1]:
        yield some(*rest)


def repeated_keys(rows: DataFrame) -> DataFrame:
    """(b, m): the bundles of every key m that occurs more than once, from the rows of ``once_per_bundle``."""
    return rows.repartition("m").sortWithinPartitions("m").mapInArrow(_repeated, "b long, m long")


class Bundles:
    """``docs`` with bundle numbers; ``added`` names columns that the operator adds (clashing ones are dropped)."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, added: list[str]):
        self.rest = others(docs, added)
        self.text_col = next(c for c in self.rest if c.lower() == text_col.lower())
        self.bundles = max(_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-stored_bytes(docs) // _BUNDLE_BYTES))
        own, h = F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)), F.xxhash64(F.col(text_col))
        self.base = docs.select(*(F.col(f"`{c}`") for c in self.rest), own.alias("__id"), h.alias("__h"), self.bundle(own, h))

    def bundle(self, own: Column, h: Column) -> Column:
        return F.pmod(F.xxhash64(own, h), F.lit(self.bundles)).alias("__b")

    def texts(self) -> DataFrame:
        """(bundle, text as bytes), in the input's partitions."""
        return self.base.select("__b", F.coalesce(F.col(f"`{self.text_col}`"), F.lit("")).cast("binary").alias("text"))

    def with_keys(self, keys: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        """``fn(documents, keys)`` per bundle; ``keys`` as ``repeated_keys`` gives them."""
        return self.base.groupBy("__b").cogroup(keys.groupBy("b")).applyInArrow(fn, schema)

    def rewritten(self, places: DataFrame, columns: list[str], cut: Callable, counts: list[str]) -> DataFrame:
        """The documents with ``cut(text, set of places) -> (text, *counts)``; ``places`` has id, h and ``columns``."""
        rest, name = self.rest, self.text_col
        schema = StructType([f for f in self.base.schema.fields if f.name in rest] + [StructField(c, LongType()) for c in counts])
        places = places.select("id", "h", *columns, self.bundle(F.col("id"), F.col("h")))

        def run(docs: pa.Table, found: pa.Table) -> pa.Table:
            of: dict[tuple[int, int], set] = {}
            for i, h, *place in zip(*(found.column(c).to_pylist() for c in ("id", "h", *columns)), strict=True):
                of.setdefault((i, h), set()).add(tuple(place))
            rows = [cut(t, of.get((i, h), set())) for i, h, t in zip(*(docs.column(c).to_pylist() for c in ("__id", "__h", name)), strict=True)]
            made = list(zip(*rows, strict=True)) if rows else [[]] * (1 + len(counts))
            kept = [pa.array(made[0], docs.schema.field(name).type) if c == name else docs.column(c) for c in rest]
            return pa.Table.from_arrays([*kept, *(pa.array(m, pa.int64()) for m in made[1:])], names=[*rest, *counts])

        return self.base.groupBy("__b").cogroup(places.groupBy("__b")).applyInArrow(run, schema)
