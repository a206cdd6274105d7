"""Landing of headerless snapshot / changelog CSV folders described by a manifest.

One scan reads every new folder of a table: the folder timestamp becomes a
column (``folder_ts``) derived from the file path, so folder pruning is a
filter and ordering by folder is ordinary data, not a driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the folder name format of the export.
FOLDER_TS_PATTERN = r"(\d{4}-\d{2}-\d{2})T(\d{2})-(\d{2})-(\d{2})"
FOLDER_KINDS = ("Snapshot", "Changelog")


def folder_ts(path: Column) -> Column:
    """A5: ISO timestamp parsed from a ``.../<yyyy-MM-ddTHH-mm-ss>/...`` path; NULL if absent."""
    raw = F.regexp_extract(path, FOLDER_TS_PATTERN, 0)
    iso = F.regexp_replace(raw, FOLDER_TS_PATTERN, "$1 $2:$3:$4")
    return F.when(raw != "", F.to_timestamp(iso, "yyyy-MM-dd HH:mm:ss"))


def source_path(base: str, table: str, kind: str, environment: str | None = None) -> str:
    """A4: ``<base>[/<environment>]/<table>/<kind>`` glob root of a table's folders."""
    root = base.rstrip("/")
    if environment:
        root = f"{root}/{environment}"
    return f"{root}/{table}/{kind}"


CORRUPT = "_corrupt_record"


def _typed(c: Column, kind: T.DataType) -> Column:
    """A field's text in its type; NULL if it is not one.  A time of day is that time on 1970-01-01."""
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.when(c.rlike(r"^\s*\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*$"), F.concat(F.lit("1970-01-01 "), F.trim(c))).otherwise(c)
    return c.try_cast(kind)


def read_positional_csv(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType,
                        with_folder: bool = True) -> DataFrame:
    """A3: headerless CSV → typed frame by position.

    All values are read as strings (no inference), quote-escaped, multi-line,
    UTF-8; each position is renamed to its manifest column and converted with
    ``try_cast`` (a bad number becomes NULL, counted by ``safe_cast``).  Rows
    with fewer fields than the manifest get NULLs.  A row with a value beyond
    the manifest's last field carries its text in ``_corrupt_record`` (NULL on
    all other rows); ``split_corrupt`` sends it to quarantine.  An empty list
    of folders gives an empty frame with the full schema.

    Quoted line breaks make a file unsplittable, so one task reads one file:
    keep export files to what a task can read (the export writes parts of some
    hundred MB at most).
    """
    n = len(schema.fields)
    raw_schema = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(n + 1)]
                              + [T.StructField("_raw", T.StringType(), True)])
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)]))
    raw = (spark.read.schema(raw_schema)
           .option("header", False).option("quote", '"').option("escape", '"').option("multiLine", True)
           .option("encoding", "UTF-8").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_raw")
           .csv(paths))
    cols = [_typed(F.col(f"_c{i}"), f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    # the reader marks short rows as well; only a value past the last field is surplus
    text = F.coalesce("_raw", F.concat_ws(",", *[F.coalesce(f"_c{i}", F.lit("")) for i in range(n + 1)]))
    cols.append(F.when(F.col(f"_c{n}").isNotNull(), text).alias(CORRUPT))
    if with_folder:
        cols.append(folder_ts(F.col("_metadata.file_path")).alias("folder_ts"))
        cols.append(F.col("_metadata.file_path").alias("source_file"))
    return raw.select(*cols)


def new_folders(folders: DataFrame, cursor_ts: Column | None, force: bool = False) -> DataFrame:
    """Folders whose timestamp is after the cursor (all when no cursor or forced)."""
    if force or cursor_ts is None:
        return folders
    return folders.filter(F.col("folder_ts") > cursor_ts)


def require_version(df: DataFrame, version: str) -> DataFrame:
    """One row — version column present, rows, rows without a version, ok flag."""
    if version not in df.columns:
        return df.agg(F.lit(False).alias("has_column"), F.count(F.lit(1)).alias("rows"),
                      F.count(F.lit(1)).alias("null_versions")).withColumn("ok", F.lit(False))
    return (df.agg(F.lit(True).alias("has_column"), F.count(F.lit(1)).alias("rows"),
                   F.count_if(F.col(version).isNull()).alias("null_versions"))
            .withColumn("ok", F.col("null_versions") == 0))


def incremental_scan(df: DataFrame, column: str, watermark: Column) -> DataFrame:
    """Rows above the watermark (predicate on the stored column, pushed to the scan)."""
    return df.filter(F.col(column) > watermark)


def attachment_metadata(df: DataFrame, keep: Sequence[str], size: str) -> DataFrame:
    """Metadata columns only; the body is never read (its stored size is reported instead)."""
    return df.select(*keep, F.col(size).alias("body_chars"))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, corrupt) — corrupt rows hold values beyond the manifest's fields; short rows are good."""
    bad = F.col(CORRUPT).isNotNull()
    return df.filter(~bad).drop(CORRUPT), df.filter(bad)


def flatten_envelope(df: DataFrame, column: str, payload_schema: str) -> DataFrame:
    """Parse a JSON envelope column and lift its fields to top-level columns."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.from_json(column, payload_schema).alias("_payload")).select(*others, "_payload.*")


def with_lineage(df: DataFrame, batch_id: str, extract_time: Column, payload: Sequence[str]) -> DataFrame:
    """Raw technical columns: source file, file time, extract / ingestion ids, record hash."""
    from strata.functions.keys import row_hash
    return df.select("*",
                     F.col("_metadata.file_path").alias("_source_file"),
                     F.col("_metadata.file_modification_time").alias("_source_file_time"),
                     extract_time.alias("_extract_time"),
                     F.lit(batch_id).alias("_batch_id"),
                     row_hash(*payload).alias("_record_hash"))


def choose_mode(df: DataFrame, table: str, required: Sequence[str]) -> DataFrame:
    """Incremental only when every required column exists and is populated, else full."""
    present = [c for c in required if c in df.columns]
    missing = [c for c in required if c not in df.columns]
    aggs = [F.count(F.lit(1)).alias("rows")] + [F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in present]
    out = df.agg(*aggs)
    populated = F.lit(len(missing) == 0)
    for c in present:
        populated = populated & (F.col(f"_n_{c}") == 0)
    return out.select(F.lit(table).alias("table_name"), "rows",
                      F.when(populated, "incremental").otherwise("full").alias("load_mode"),
                      F.lit(",".join(missing)).alias("missing_columns"))


def select_columns(df: DataFrame, whitelist: Sequence[str], key: Sequence[str], system: Sequence[str]) -> DataFrame:
    """B1: key + whitelist + system columns, applied after positional mapping."""
    keep, seen = [], set()
    for c in [*key, *whitelist, *system]:
        if c in df.columns and c.lower() not in seen:
            keep.append(c)
            seen.add(c.lower())
    return df.select(*keep)


def register_raw(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Register an existing columnar location as a raw table (temp view) and return it."""
    df = spark.read.format(fmt).load(path)
    df.createOrReplaceTempView(name)
    return df
