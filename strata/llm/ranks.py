"""Ranks of a whole table without one task that sees it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpoint


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their rank from 1: dealt out by ranges and sorted there, a row's rank is its place in its range after the rows of the ranges before.

    The places are written to the checkpoint folder, so they stay as they are; the driver gets one number for each range.
    """
    placed = checkpoint(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id()))
    part = F.shiftright("__place", 33)      # the id holds the partition above its lower 33 bits
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    first, starts = 0, []
    for p, n in sizes:
        starts.append((p, first))
        first += n
    before = rows.sparkSession.createDataFrame(starts, "__part long, __first long")
    return (placed.withColumn("__part", part).join(F.broadcast(before), "__part")     # one row for each range
            .withColumn(name, F.col("__first") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("__part", "__first", "__place"))
