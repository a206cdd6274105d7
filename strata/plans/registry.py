"""Registry of named queries: Spark plan + independent SQL statement.

``QUERIES[name](spark, data_dir)`` returns the lazy Spark DataFrame;
``ORACLE[name]`` is the DuckDB statement of the same result (omitted for
operators that SQL cannot state, which are checked by pytest instead).
Decimal outputs are returned as DOUBLE by both sides so results compare
independently of each engine's decimal precision rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from strata.sources.fixtures import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def finalize(df: DataFrame) -> DataFrame:
    """Present decimal columns as double (values are exact decimals up to here)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(name: str, oracle: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``."""
    def deco(fn):
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            return finalize(fn(Tables(spark, data_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from strata.plans import catalog  # noqa: F401
