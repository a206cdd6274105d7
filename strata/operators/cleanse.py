"""Table-level Silver cleansing operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.changes import delete_flag


def active_records(df: DataFrame, deleted: str, null_is_active: bool = True) -> DataFrame:
    """Live rows.  ``null_is_active=False`` reproduces ``flag = 0`` (NULL rows dropped)."""
    if null_is_active:
        return df.filter(~delete_flag(deleted))
    s = F.lower(F.trim(F.col(deleted).cast("string")))
    return df.filter(s.isin("false", "0", "no", "n", "f"))


def from_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """``(silver column, raw table, raw column, rule)`` rows → one projection of SQL rules."""
    return df.select(*[F.expr(rule).alias(name) for name, _, _, rule in mapping])


def mapping_table(spark, mapping: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """The mapping as a table (lineage)."""
    return spark.createDataFrame(list(mapping), "silver_column string, raw_table string, raw_column string, rule string")
