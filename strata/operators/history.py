"""History-table operators: current view, per-key listing, point-in-time reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.changes import CURRENT, END, START


def current(history: DataFrame) -> DataFrame:
    """Rows flagged current."""
    return history.filter(F.col(CURRENT))


def of_key(history: DataFrame, key: str, value) -> DataFrame:
    """The history of one key, oldest first."""
    return history.filter(F.col(key) == F.lit(value)).orderBy(START)


def sequence_versions(history: DataFrame, key, col: str = "version_seq") -> DataFrame:
    """Number the versions of each key in start order."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(F.col(START).asc(), F.col("_version").asc())
    return history.withColumn(col, F.row_number().over(w))


def as_of(history: DataFrame, at: Column, start: str = START, end: str = END) -> DataFrame:
    """Versions valid at ``at`` (half-open intervals)."""
    return history.filter((F.col(start) <= at) & (F.col(end).isNull() | (at < F.col(end))))


def append_events(table: DataFrame, batch: DataFrame, event_key) -> DataFrame:
    """K2: append a batch, skipping events already present (duplicate delivery protection).

    Duplicates inside the batch collapse too (one row per event key).
    """
    keys = [event_key] if isinstance(event_key, str) else list(event_key)
    from strata.operators import windows
    fresh = windows.latest(batch, keys, [F.col(c).desc_nulls_last() for c in batch.columns if c not in keys])
    return table.unionByName(fresh.join(table.select(*keys), keys, "left_anti"))
