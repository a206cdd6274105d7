"""Layout and maintenance at user level: compaction, clustering, partition and column statistics."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def compact(df: DataFrame, target_files: int) -> DataFrame:
    """Fewer, larger files; rows unchanged (``coalesce`` avoids a shuffle)."""
    return df.coalesce(target_files)


def _listing(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of a folder's data files: a directory listing, nothing is opened."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return sorted((s.getPath().toString(), s.getLen()) for s in found if s.isFile() and not s.getPath().getName().startswith(("_", ".")))


def bins(sizes: Sequence[tuple[str, int]], target: int) -> list[list[str]]:
    """First fit, largest first: groups of at least two small files that together hold at most ``target`` bytes; others are left alone."""
    out: list[tuple[int, list[str]]] = []
    for path, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        if size > target // 2:
            continue
        i = next((i for i, (n, _) in enumerate(out) if n + size <= target), None)
        if i is None:
            out.append((size, [path]))
        else:
            out[i] = (out[i][0] + size, [*out[i][1], path])
    return [paths for _, paths in out if len(paths) > 1]


def digest(df: DataFrame) -> Row:
    """Rows, and two order-free sums of row hashes: equal for equal multisets of rows."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    wide = h.cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(wide).alias("sum"), F.sum((h % 1_000_003) * (h % 999_983)).alias("mixed")).first()


def compact_folder(spark: SparkSession, folder: str, target: int) -> dict:
    """The small files of a Parquet folder packed into files of about ``target`` bytes; large ones are not touched.

    One job rewrites all groups, each in a task of its own.  The copies are compared with their sources by ``digest`` before any
    file is moved in or deleted; a difference leaves the folder as it was.  The driver holds the file listing.  Readers
    between the move and the delete see rows twice, so do it when nobody reads, as with any rewrite without a table log.
    """
    groups = bins(_listing(spark, folder), target)
    run = {"files_before": len(_listing(spark, folder)), "rewritten": sum(map(len, groups)), "written": 0}
    if not groups:
        return run | {"files_after": run["files_before"]}
    small = [p for g in groups for p in g]
    old = spark.read.parquet(*small)
    group_of = spark.createDataFrame([(p.rpartition("/")[2], i) for i, g in enumerate(groups) for p in g], "_name string, _group int")
    named = old.withColumn("_name", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    staging = f"{folder.rstrip('/')}/_compact-{uuid.uuid4()}"
    cut = named.join(group_of, "_name").drop("_name").repartitionByRange(len(groups), "_group")
    cut.drop("_group").write.option("maxRecordsPerFile", 0).parquet(staging)
    new = spark.read.schema(old.schema).parquet(staging)
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    path = spark._jvm.org.apache.hadoop.fs.Path
    if digest(old) != digest(new):
        fs.delete(path(staging), True)
        raise RuntimeError(f"the rewritten files of {folder} differ from their sources; nothing was changed")
    made = [p for p, _ in _listing(spark, staging)]
    for p in made:
        fs.rename(path(p), path(folder))
    for p in small:
        fs.delete(path(p), False)
    fs.delete(path(staging), True)
    return run | {"written": len(made), "files_after": len(_listing(spark, folder))}


def cluster(df: DataFrame, columns: Sequence[str], partitions: int) -> DataFrame:
    """R2: range-cluster by the filter columns and sort inside partitions (min/max pruning)."""
    return df.repartitionByRange(partitions, *columns).sortWithinPartitions(*columns)


def partition_stats(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Per candidate column — distinct values, rows per value (min / max) and skew ratio."""
    out = None
    for c in candidates:
        per = df.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        row = per.agg(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("distinct_values"),
                      F.min("_n").alias("min_rows"), F.max("_n").alias("max_rows"), F.sum("_n").alias("rows"))
        row = row.withColumn("skew", F.col("max_rows").cast("double") /
                             (F.col("rows").cast("double") / F.col("distinct_values").cast("double")))
        out = row if out is None else out.unionByName(row)
    return out


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One-pass statistics per column: non-null count, distinct, min, max (as text)."""
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}__nn"), F.count_distinct(c).alias(f"{c}__nd"),
                 F.min(c).cast("string").alias(f"{c}__min"), F.max(c).cast("string").alias(f"{c}__max")]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    items = ", ".join(f"'{c}', `{c}__nn`, `{c}__nd`, `{c}__min`, `{c}__max`" for c in columns)
    return wide.selectExpr("_rows AS rows", f"stack({len(columns)}, {items}) AS (column_name, non_null, distinct_values, min_value, max_value)")


def sketch_stats(df: DataFrame, candidates: Sequence[str], error: float = 0.02) -> DataFrame:
    """One pass over ``df`` for all candidate columns, with sketches of fixed size that merge across tasks.

    Per column: rows, non_null, distinct (HyperLogLog, relative standard error ``error``), top_value and top_rows (a sketch of
    the most frequent values, exact up to its size), skew (rows of the top value against the mean rows of a value).
    """
    aggs = []
    for c in candidates:
        v = F.col(f"`{c}`")
        aggs += [F.count(v).alias(f"{c}__nn"), F.approx_count_distinct(v, error).alias(f"{c}__nd"),
                 F.get(F.expr(f"approx_top_k(CAST(`{c}` AS STRING), 1, 10000)"), F.lit(0)).alias(f"{c}__top")]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__nn").alias("non_null"), F.col(f"{c}__nd").alias("distinct_values"),
                                        F.col(f"{c}__top.item").alias("top_value"), F.col(f"{c}__top.count").alias("top_rows")) for c in candidates)))
    out = wide.select(F.col("_rows").alias("rows"), each.alias("s")).select("s.column_name", "rows", "s.non_null", "s.distinct_values", "s.top_value", "s.top_rows")
    return out.withColumn("skew", F.col("top_rows") * F.col("distinct_values") / F.when(F.col("non_null") > 0, F.col("non_null")))


def split_wide(df: DataFrame, key: Sequence[str], wide_columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Vertical split — narrow table and a key + wide-text table."""
    narrow = df.drop(*wide_columns)
    wide = df.select(*key, *wide_columns)
    return narrow, wide
