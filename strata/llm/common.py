"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strata

#: ASCII white space, as SQL regular expressions and the word splitters use it.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of text that a Python task turns into numpy arrays at a time (a longer text makes a chunk of its own).
CHUNK_BYTES = 1 << 20


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def others(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The columns of ``df`` that clash with none of ``names`` (case-insensitively, as Spark resolves names)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless they find it on their path as the driver does."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(strata.__file__)))
    if os.getcwd() == root or root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(spark.sparkContext, "_strata_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="strata-"), "strata.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "strata")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    spark.sparkContext.addPyFile(path)
    spark.sparkContext._strata_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``; a local session without one gets its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not re.match(r"local(\[|$)", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


#: Shuffle files go as soon as the query that made them has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint(df: DataFrame, *done: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and go on from the copy: lineage ends there, a lost executor costs nothing.

    ``done`` are earlier copies that nothing needs once this one is written; they are deleted.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/copy-{uuid.uuid4()}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._copy = path
    discard(*done)
    return out


#: Parquet bytes of a copy up to which it is broadcast; beyond, joins with it are shuffled.
_SMALL = 4 << 20


def is_small(copy: DataFrame) -> bool:
    """Whether what ``checkpoint`` wrote for this frame takes at most ``_SMALL`` bytes, as measured on its files."""
    spark = copy.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(copy._copy)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength() <= _SMALL


def gathered(copy: DataFrame) -> DataFrame:
    """A copy that ``is_small`` as one partition, so that steps on it alone need no exchange; a larger one as it is."""
    if not is_small(copy):
        return copy
    out = copy.coalesce(1)
    out._copy = copy._copy
    return out


def together(df: DataFrame, *copies: DataFrame) -> DataFrame:
    """``df``, made of nothing but these copies, in one partition if each of them is small."""
    return df.coalesce(1) if all(is_small(c) for c in copies) else df


def discard(*copies: DataFrame) -> None:
    """Delete what ``checkpoint`` wrote for these frames; other frames are left alone."""
    for df in copies:
        path = getattr(df, "_copy", None)
        if path:
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
            df._copy = None


def chunks(ids: list, texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Split a batch into runs of about ``limit`` bytes of UTF-8; a null text counts as empty."""
    part_ids, part, size = [], [], 0
    for i, t in zip(ids, texts, strict=True):
        b = t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass")
        if part and size + len(b) > limit:
            yield part_ids, part
            part_ids, part, size = [], [], 0
        part_ids.append(i)
        part.append(b)
        size += len(b)
    if part:
        yield part_ids, part


def over_texts(fn: Callable[[list, list[bytes]], pa.RecordBatch | None]) -> Callable:
    """A ``mapInArrow`` function from ``fn(ids, texts)``; the input has the columns id and text (as binary), in this order."""
    def run(batches):
        for batch in batches:
            for ids, texts in chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out = fn(ids, texts)
                if out is not None and out.num_rows:
                    yield out
    return run


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text as UTF-8 bytes); null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("id"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
