"""Access to the parquet tables of a data folder (one file/dir per table)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """Lazy ``name -> DataFrame`` view over ``<root>/<name>.parquet``.

    Reading is lazy: nothing is scanned until an action, and Catalyst prunes
    the columns and pushes the filters of whatever query uses the frame.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}
        self._made: dict[str, object] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]

    def once(self, name: str, make: Callable[[], object]):
        """What ``make`` returns, made once for this view (for steps that run a job of their own)."""
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]
