"""Mart-building operators: ratio of sums, top-N, semi-additive roll-up,
roll-ups, ageing buckets, and a measure dictionary that blocks illegal sums."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, scale: int | None = None, factor: float = 1.0) -> Column:
    """Non-additive measure as a ratio of sums: ``sum(a)/sum(b)``, NULL when the denominator is 0."""
    r = num.cast("double") / F.when(den != 0, den).cast("double") * F.lit(factor)
    return F.round(r, scale) if scale is not None else r


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """Top-N by a total order (callers append the key as the tie-break)."""
    return df.orderBy(*order).limit(n)


def semi_additive(df: DataFrame, key: Sequence[str], period: Column, ts: Sequence[str], balance: str,
                  by: Sequence[str] = ()) -> DataFrame:
    """Last balance per key and period (by ``ts``, several columns for a total order), then summed over keys per period."""
    last = (df.withColumn("_period", period)
            .groupBy(*key, *by, "_period").agg(F.max_by(balance, F.struct(*ts)).alias("_last")))
    return last.groupBy(*by, "_period").agg(F.sum("_last").alias("balance")).withColumnRenamed("_period", "period")


def aging_bucket(days_past_due: Column) -> Column:
    """Fixed ageing buckets on days past due."""
    return (F.when(days_past_due <= 0, "current")
            .when(days_past_due <= 30, "1-30")
            .when(days_past_due <= 60, "31-60")
            .when(days_past_due <= 90, "61-90")
            .otherwise("90+"))


@dataclass
class Measure:
    name: str
    kind: str                       # additive | semi | non
    required_keys: tuple[str, ...] = ()
    time_key: str | None = None     # semi-additive: not summable across this key


@dataclass
class Measures:
    """Measure dictionary consulted before aggregating."""
    measures: dict[str, Measure] = field(default_factory=dict)

    def add(self, m: Measure) -> "Measures":
        self.measures[m.name] = m
        return self

    def check(self, by: Sequence[str], names: Sequence[str]) -> None:
        for n in names:
            m = self.measures[n]
            if m.kind == "non":
                raise ValueError(f"{n} is non-additive; aggregate its components and take the ratio")
            if m.kind == "semi" and m.time_key and m.time_key not in by:
                raise ValueError(f"{n} is semi-additive over {m.time_key}; group by it or take the period's last value")
            missing = [k for k in m.required_keys if k not in by]
            if missing:
                raise ValueError(f"{n} must be grouped by {missing}")

    def sum(self, df: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
        self.check(by, names)
        return df.groupBy(*by).agg(*[F.sum(n).alias(n) for n in names])
