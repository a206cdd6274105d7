"""Publication with Spark's own writers: append, overwrite, and dynamic overwrite of the partitions that change.

A keyed table is a Parquet folder partitioned by a hash bucket of its key.  A merge reads only the buckets that hold a
changed key (the filter on the partition column prunes the scan) and overwrites only those: Spark stages the new files
and replaces the partitions when the job commits, so a lost executor or a failed job changes nothing.  A job that is
killed during the commit can leave some buckets new and some old; as the merges are idempotent, running it again ends well.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path`` (any file system that Spark reads)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType | str, keyed: bool = False) -> None:
    """A10: an empty table with the given schema, unless there is one; a ``keyed`` one has the bucket that merges need."""
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(f"{path.rstrip('/')}/{BUCKET}=0" if keyed else path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """The whole table anew; its schema may change.  ``df`` must not read ``path``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path, partitionBy=list(partition_by) or None)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Only new files are written."""
    df.write.mode("append").parquet(path, partitionBy=list(partition_by) or None)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Only the partitions present in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def with_bucket(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def merge_table(changes: DataFrame, path: str, key: Sequence[str], buckets: int,
                merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> None:
    """Apply ``merge(state, changes)`` to the buckets that ``changes`` touches, and to no other.

    ``merge`` keeps the keys that it does not change (as ``apply_scd1`` and ``apply_scd2`` do).  The list of
    touched buckets is at most ``buckets`` numbers.
    """
    spark = changes.sparkSession
    touched = [r[0] for r in with_bucket(changes, key, buckets).select(BUCKET).distinct().collect()]
    if not touched:
        return
    state = None
    if exists(spark, path):
        stored = spark.read.parquet(path)
        if BUCKET not in stored.columns:
            raise ValueError(f"{path} is not a keyed table: make it with ensure_table(..., keyed=True) or let the first merge make it")
        state = stored.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    write_partitioned(with_bucket(merge(state, changes), key, buckets), path, [BUCKET])


def rebuild_table(state: DataFrame, path: str, key: Sequence[str], buckets: int) -> None:
    """A keyed table anew, every bucket of it: what ``state`` lacks is gone.  ``state`` must not read ``path``."""
    replace_table(with_bucket(state, key, buckets), path, [BUCKET])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a keyed table, without the bucket."""
    return spark.read.parquet(path).drop(BUCKET)
