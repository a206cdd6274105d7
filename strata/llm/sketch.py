"""How often word shingles occur in a corpus, in a table of fixed size.

Counts go to ``2 ** bits`` cells by hash, so a cell's count is at least that of
each of its shingles.  Operators use the counts only to prefer rare shingles
over frequent ones; no result depends on them, so collisions cost time only.
Every text is counted.  Each input partition sends one table, in blocks, which
are added block by block; the driver gets the one total (8 bytes a cell).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import chunks
from strata.llm.wordhash import U, shingles, split_words

_BLOCK = 1 << 14


def _packed(counts: np.ndarray) -> bytes:
    """In the smallest unsigned type that holds them, after a byte that says its size."""
    small = counts.astype(np.min_scalar_type(int(counts.max())))
    return bytes([small.itemsize]) + small.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _batch(totals: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array([_packed(v) for v in totals.values()], pa.binary())],
                                      names=["block", "counts"])


def shingle_classes(texts: DataFrame, k: int, lower: bool, bits: int = 20) -> np.ndarray:
    """A byte per cell: 0 for cells whose count chance explains (mean and four times its root), then one more per doubling of the excess.

    ``texts`` has the columns id and text (binary).
    """
    cells = 1 << bits

    def count(batches):
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for _, part in chunks([None] * batch.num_rows, batch.column(1).to_pylist()):
                w = split_words(part, lower=lower)
                at = (shingles(w.hash, k) & U(cells - 1)).astype(np.int64)
                total += np.bincount(at, minlength=cells)   # shingles across two texts are counted too: harmless
        step = min(_BLOCK, cells)
        if total.any():
            yield _batch({i: total[i * step:(i + 1) * step] for i in range(cells // step)})

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = _unpacked(c)
                totals[i] = totals[i] + part if i in totals else part
        if totals:
            yield _batch(totals)

    rows = texts.mapInArrow(count, "block long, counts binary").repartition(16, "block").mapInArrow(add, "block long, counts binary").collect()
    if not rows:
        return np.zeros(cells, np.uint8)
    total = np.concatenate([_unpacked(r["counts"]) for r in sorted(rows, key=lambda r: r["block"])])
    mean = total.mean()
    return np.floor(np.log2(1 + np.maximum(0, total - mean) / (4 * np.sqrt(mean) + 1))).astype(np.uint8)
