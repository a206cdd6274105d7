"""One pass from rows to their dispositions: rows, rejects and the quality event log of a run.

Every row is judged once, in the scan that writes it.  The counts come from an ``Observation`` on that write, so nothing
is read again to count it, and one write partitioned by disposition holds accepted and held rows.  A streaming query
does the same in ``foreachBatch``, with its epoch as the log's epoch, so batch and stream write the same log rows.  A run
and epoch that is repeated replaces its own rows and log entries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.sources import sinks

DISPOSITION = "disposition"
LOG = "run_id string, epoch long, kind string, name string, severity string, failed long, passed long"


def split_write(df: DataFrame, rules: Sequence[Q.Rule], path: str, log: str, run_id: str, epoch: int = 0) -> dict[str, int]:
    """Write ``df`` to ``path`` by run, epoch and disposition, with the rules that each row fails, and the run's counts to ``log``.

    Returns the rows of each disposition (also 0).  Log rows: one for each rule (failed, passed) and one for each
    disposition (its rows as ``failed`` if it is held back, else as ``passed``).
    """
    names = list(dict.fromkeys(["PASS", *Q.DISPOSITION.values()]))
    judged = df.withColumn("failed_rules", Q.failed_rules(rules)).withColumn(DISPOSITION, Q._disp(Q.severity_of(rules)))
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *(F.count_if(F.array_contains("failed_rules", r.name)).alias(f"r_{r.name}") for r in rules),
              *(F.count_if(F.col(DISPOSITION) == n).alias(f"d_{n}") for n in names)]
    out = judged.observe(seen, *counts).withColumn("_run", F.lit(run_id)).withColumn("_epoch", F.lit(epoch).cast("long"))
    sinks.write_partitioned(out, path, ["_run", "_epoch", DISPOSITION])
    got = seen.get
    held = {Q.DISPOSITION[Q.SEVERITY[s]] for s in Q.SEVERITY if Q.SEVERITY[s] > Q.SEVERITY["warn"]}
    rows = [(run_id, epoch, "rule", r.name, r.severity, got[f"r_{r.name}"], got["rows"] - got[f"r_{r.name}"]) for r in rules]
    rows += [(run_id, epoch, "disposition", n, None, got[f"d_{n}"] * (n in held), got[f"d_{n}"] * (n not in held)) for n in names]
    entries = df.sparkSession.createDataFrame(rows, LOG)
    sinks.write_partitioned(entries.coalesce(1), log, ["run_id", "epoch"])
    return {n: got[f"d_{n}"] for n in names}


def split_stream(rules: Sequence[Q.Rule], path: str, log: str, run_id: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body that does ``split_write`` for each epoch; a replayed epoch replaces what it wrote."""
    def run(batch: DataFrame, epoch: int) -> None:
        split_write(batch, rules, path, log, run_id, epoch)
    return run


def read_split(spark: SparkSession, path: str, held: bool | None = None) -> DataFrame:
    """All written rows, or only those held back (``held``) or let through; a filter on the partition, so the others are not read."""
    df = spark.read.parquet(path).drop("_run", "_epoch")
    if held is None:
        return df
    back = F.col(DISPOSITION).isin(*{Q.DISPOSITION[c] for c in Q.DISPOSITION if c > Q.SEVERITY["warn"]})
    return df.filter(back if held else ~back)
