"""Snapshot-grain operators: periodic balance, accumulating milestones, factless facts,
reversal pairing and restatement scope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.sources import sinks


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def _day(d: str | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


def daily_balance(movements: DataFrame, key, ts: str, amount: str, first: str | Column, last: str | Column) -> DataFrame:
    """K4: end-of-day balance per key for every day in ``[first, last]``.

    Movements are pre-aggregated to one row per key and day (partial +
    final aggregate) before anything else, so the running-sum window sees at
    most one row per key and day, whatever the raw volume of a hot key.
    The opening balance is the sum of movements before ``first``.  The bounds are dates or columns without rows of their
    own (literals, scalar subqueries); NULL bounds, as of an empty feed, give no rows.
    """
    keys = _cols(key)
    d0, d1 = _day(first), _day(last)
    day = F.to_date(F.col(ts))
    daily = (movements.withColumn("_day", day)
             .withColumn("_bucket", F.when(F.col("_day") < d0, F.date_sub(d0, 1)).otherwise(F.col("_day")))
             .filter(F.col("_bucket") <= d1)
             .groupBy(*keys, "_bucket").agg(F.sum(amount).alias("_amt")))
    spine = (daily.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
             .select(*keys, F.explode(F.sequence(F.date_sub(d0, 1), d1)).alias("_bucket")))
    w = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    out = (spine.join(daily, keys + ["_bucket"], "left")
           .withColumn("movement", F.coalesce(F.col("_amt"), F.lit(0).cast(daily.schema["_amt"].dataType)))
           .withColumn("balance", F.sum("movement").over(w)))
    return (out.filter(F.col("_bucket") >= d0)
            .select(*keys, F.col("_bucket").alias("balance_date"), "movement", "balance"))


def restate(balance: DataFrame, late: DataFrame, key, ts: str, amount: str, first: str | Column, last: str | Column) -> DataFrame:
    """K9: a daily balance (of ``daily_balance`` over [first, last]) with late movements worked in.

    A late movement changes its day's movement and the balance of that day and all later ones of its key; a key that the
    table did not have gets all its days.  Movements before ``first`` only change balances, those after ``last`` nothing.
    The late rows are summed by key and day first; keys without late rows pass through.
    """
    keys = _cols(key)
    more = daily_balance(late, keys, ts, amount, first, last)
    more = more.select(*keys, "balance_date", F.col("movement").alias("_movement"), F.col("balance").alias("_balance"))
    both = balance.join(more, [*keys, "balance_date"], "full_outer")
    kind = {c: balance.schema[c].dataType for c in ("movement", "balance")}
    return both.select(*keys, "balance_date", *((F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"_{c}"), F.lit(0))).cast(kind[c]).alias(c) for c in ("movement", "balance")))


def restate_table(spark: SparkSession, path: str, late: DataFrame, key, ts: str, amount: str, first: str, last: str) -> list[str]:
    """K9: ``restate`` on a table partitioned by balance_date; only the days that change are read and overwritten, and returned.

    These are the days from the first late one on, or all if a late key is new to the table (every day has all its keys,
    so the last day alone tells).
    """
    keys = _cols(key)
    late = late.filter(F.to_date(ts) <= F.lit(last).cast("date"))
    table = spark.read.parquet(path)
    known = table.filter(F.col("balance_date") == F.lit(last).cast("date")).select(*keys)
    start = late.agg(F.min(F.to_date(ts))).first()[0]
    if start is None:
        return []
    start = max(str(start), first) if late.join(known, keys, "left_anti").isEmpty() else first
    changed = restate(table.filter(F.col("balance_date") >= F.lit(start).cast("date")), late, keys, ts, amount, start, last)
    sinks.write_partitioned(changed, path, ["balance_date"])
    return [str(r[0]) for r in spark.sql(f"SELECT explode(sequence(DATE '{start}', DATE '{last}'))").collect()]


def accumulating(events: DataFrame, key, ts: str, milestone: str, order: Sequence[str]) -> DataFrame:
    """K5: first time each milestone was reached per process instance, plus step durations (days)."""
    keys = _cols(key)
    aggs = [F.min(F.when(F.col(milestone) == m, F.col(ts))).alias(f"first_{m}") for m in order]
    out = events.groupBy(*keys).agg(*aggs)
    for a, b in zip(order, order[1:]):
        out = out.withColumn(f"days_{a}_to_{b}", F.datediff(F.col(f"first_{b}"), F.col(f"first_{a}")))
    return out


def factless(events: DataFrame, dims: Sequence[str]) -> DataFrame:
    """K6: the distinct combination set; the row count is the measure."""
    return events.groupBy(*dims).agg(F.count(F.lit(1)).alias("occurrences"))


def signed(amount: Column, is_credit: Column) -> Column:
    """K8: credit notes and reversals carry a negative sign."""
    return F.when(is_credit, -F.abs(amount)).otherwise(amount)


def restate_scope(late_rows: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """K9: partitions touched by late rows (to rebuild with a dynamic overwrite)."""
    return late_rows.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("late_rows"))
