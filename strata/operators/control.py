"""Run control as table operators: cursors, stuck-run recovery, classification,
priority planning, batches, dashboards and run outcomes.

Cursor / run tables are ordinary DataFrames updated by keyed upserts; 'now'
is always a parameter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Run statuses and the priority of each class per planning mode.
STATUSES = ("SUCCESS", "FAILED", "RUNNING", "NEVER_RUN")
PRIORITY = {
    "resume": {"failed": 1, "never_run": 2, "stale": 3},        # fresh tables are skipped
    "full": {"never_run": 1, "failed": 2, "stale": 3, "fresh": 4},
    "failed_only": {"failed": 1},
}


RESET_NOTE = "reset by operator while RUNNING"


def upsert(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keyed upsert of a small control table (new rows win; of new rows with one key any one)."""
    rows = rows.dropDuplicates(list(key))
    return table.join(rows.select(*key), list(key), "left_anti").unionByName(rows, allowMissingColumns=True)


def mark_running(cursor: DataFrame, tables: DataFrame, now: Column) -> DataFrame:
    """Set RUNNING for the given tables; committed positions are kept (V2)."""
    t = tables.select("table_name").withColumn("_hit", F.lit(True))
    j = cursor.join(t, "table_name", "left")
    return j.select(*[F.when(F.col("_hit"), F.lit("RUNNING")).otherwise(F.col("status")).alias("status")
                      if c == "status" else
                      (F.when(F.col("_hit"), now).otherwise(F.col("last_run_ts")).alias("last_run_ts")
                       if c == "last_run_ts" else F.col(c)) for c in cursor.columns])


def recover_stuck(cursor: DataFrame, now: Column, hours: int) -> DataFrame:
    """RUNNING rows older than ``hours`` become FAILED with a note."""
    stuck = (F.col("status") == "RUNNING") & (F.col("last_run_ts") < now - F.expr(f"INTERVAL {hours} HOURS"))
    return (cursor.withColumn("error_message", F.when(stuck, F.lit(f"recovered: RUNNING for more than {hours}h"))
                              .otherwise(F.col("error_message")))
            .withColumn("status", F.when(stuck, F.lit("FAILED")).otherwise(F.col("status"))))


def reset_running(cursor: DataFrame) -> DataFrame:
    """Every RUNNING row back to FAILED immediately, with a note."""
    running = F.col("status") == "RUNNING"
    return (cursor.withColumn("error_message", F.when(running, F.lit(RESET_NOTE)).otherwise(F.col("error_message")))
            .withColumn("status", F.when(running, "FAILED").otherwise(F.col("status"))))


def classify(scope: DataFrame, cursor: DataFrame, now: Column, stale_hours: int) -> DataFrame:
    """Failed / never_run / stale / fresh per table in scope; RUNNING (a run that was cut off) and unknown statuses count as failed."""
    j = scope.select("table_name").join(cursor, "table_name", "left")
    cls = (F.when(F.col("status").isNull() | (F.col("status") == "NEVER_RUN"), "never_run")
           .when(F.col("status") == "SUCCESS",
                 F.when(F.col("last_run_ts") < now - F.expr(f"INTERVAL {stale_hours} HOURS"), "stale").otherwise("fresh"))
           .otherwise("failed"))
    return j.withColumn("class", cls)


def plan(classified: DataFrame, mode: str) -> DataFrame:
    """Priority order for a planning mode (``failed_only`` keeps failed tables only)."""
    pr = PRIORITY[mode]
    rank = F.lit(None).cast("int")
    for k, v in pr.items():
        rank = F.when(F.col("class") == k, F.lit(v)).otherwise(rank)
    return classified.withColumn("priority", rank).filter(F.col("priority").isNotNull())


def plan_batches(planned: DataFrame, batch_size: int) -> DataFrame:
    """ordinal and batch number over the ordered work list (progress ``[n/m]``).

    Rows are numbered inside (priority, day of the last run) and moved up by the count of what stands before, so only
    one row per priority and day, not one per table, is ordered in a single task.
    """
    p = planned.withColumn("_day", F.to_date("last_run_ts"))
    ahead = Window.orderBy(F.col("priority").asc(), F.col("_day").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    groups = p.groupBy("priority", "_day").agg(F.count(F.lit(1)).alias("_n"))
    groups = groups.select(F.col("priority").alias("_p"), F.col("_day").alias("_d"), F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    own = Window.partitionBy("priority", "_day").orderBy(F.col("last_run_ts").asc_nulls_first(), F.col("table_name").asc())
    out = p.withColumn("_k", F.row_number().over(own)).join(groups, F.col("priority").eqNullSafe(F.col("_p")) & F.col("_day").eqNullSafe(F.col("_d")))
    out = out.withColumn("ordinal", F.col("_ahead") + F.col("_k")).drop("_day", "_k", "_p", "_d", "_ahead")
    return out.withColumn("batch", F.ceil(F.col("ordinal") / F.lit(batch_size)).cast("int"))


def status_counts(cursor: DataFrame) -> DataFrame:
    """E5: tables per status."""
    return cursor.groupBy("status").agg(F.count(F.lit(1)).alias("tables"))


def failed_recent(cursor: DataFrame, n: int = 20) -> DataFrame:
    """Most recent failures."""
    return (cursor.filter(F.col("status") == "FAILED")
            .orderBy(F.col("last_run_ts").desc(), F.col("table_name").asc()).limit(n))


def last_run(runs: DataFrame) -> DataFrame:
    """latest run as one row (``max_by`` — no sort of the run log); none of an empty log."""
    cols = [c for c in runs.columns]
    return runs.agg(F.max_by(F.struct(*cols), F.struct("run_started", "run_id")).alias("r")).filter("r IS NOT NULL").select("r.*")


def run_outcome(per_table: DataFrame) -> DataFrame:
    """Per run, counts and SUCCESS / PARTIAL / FAILED outcome."""
    g = per_table.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("tables_processed"),
        F.count_if(F.col("status") == "SUCCESS").alias("tables_succeeded"),
        F.count_if(F.col("status") != "SUCCESS").alias("tables_failed"),
        F.min("started").alias("run_started"), F.max("finished").alias("run_finished"))
    outcome = (F.when(F.col("tables_failed") == 0, "SUCCESS")
               .when(F.col("tables_succeeded") == 0, "FAILED").otherwise("PARTIAL"))
    return g.withColumn("status", outcome).withColumn(
        "duration_seconds", (F.unix_timestamp("run_finished") - F.unix_timestamp("run_started")).cast("bigint"))


def preview(planned: DataFrame, in_scope: DataFrame, batch_size: int, seconds_per_table: int, shown: int = 10) -> DataFrame:
    """What a run would do, as one row: tables to process and to skip, batches, estimated seconds, the first tables in order.

    ``planned`` has ordinal and table_name (``plan_batches``).  The list is ``shown`` names; everything else is a count.
    """
    first = planned.filter(F.col("ordinal") <= shown).agg(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "table_name"))), lambda x: x["table_name"]).alias("first_tables"))
    n = planned.agg(F.count(F.lit(1)).alias("would_process"))
    scope = in_scope.agg(F.count(F.lit(1)).alias("in_scope"))
    process = n.scalar()
    return first.select(process.alias("would_process"), (scope.scalar() - process).alias("would_skip"), F.ceil(process / batch_size).cast("int").alias("batches"),
                        (process * seconds_per_table).alias("estimated_seconds"), "first_tables")


def run_log(per_table: DataFrame, in_scope: DataFrame, mode: str, force: bool = False, notes: str | None = None) -> DataFrame:
    """One row per run as it is appended to the run history: outcome and duration (``run_outcome``), tables in scope, processed and skipped, rows, mode."""
    rows = per_table.groupBy(F.col("run_id").alias("_run")).agg(F.sum("rows").alias("total_rows"))
    out = run_outcome(per_table).join(rows, F.col("run_id") == F.col("_run")).drop("_run")
    scope = in_scope.agg(F.count(F.lit(1))).scalar()
    return (out.withColumn("tables_in_scope", scope).withColumn("tables_skipped", scope - F.col("tables_processed"))
            .withColumn("run_mode", F.lit(mode)).withColumn("force_full", F.lit(force)).withColumn("notes", F.lit(notes).cast("string")))


def layer_watermarks(cursor: DataFrame, layers: DataFrame) -> DataFrame:
    """Per layer and table the position read from the cursor rows of that layer; a layer that never ran has NULLs.

    ``layers``: (layer, table_name) that should be there; ``cursor`` has layer beside its own columns.
    """
    last = cursor.groupBy(F.col("layer").alias("_layer"), F.col("table_name").alias("_table")).agg(F.max_by(F.struct("last_versionnumber", "last_run_ts", "status"), F.struct("last_versionnumber", "last_run_ts")).alias("_c"))
    out = layers.join(last, (F.col("layer") == F.col("_layer")) & (F.col("table_name") == F.col("_table")), "left")
    return out.select("layer", "table_name", "_c.last_versionnumber", "_c.last_run_ts", F.coalesce("_c.status", F.lit("NEVER_RUN")).alias("status"))


def listing(cursor: DataFrame, now: Column, stuck_hours: int) -> DataFrame:
    """Every table with its state, the hours since its last run, whether it is stuck, and an error text that is never blank for a failure."""
    stuck = (F.col("status") == "RUNNING") & (F.col("last_run_ts") < now - F.expr(f"INTERVAL {stuck_hours} HOURS"))
    error = F.when(F.col("status") == "FAILED", F.when(F.trim("error_message") != "", F.col("error_message")).otherwise("no message"))
    hours = F.floor((F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.col("last_run_ts").cast("timestamp"))) / 3600)
    return cursor.select("table_name", "status", "last_run_ts", hours.alias("hours_since"), F.coalesce(stuck, F.lit(False)).alias("is_stuck"), error.alias("error"))


def scope_tables(requested: DataFrame, available: DataFrame) -> DataFrame:
    """H5: requested tables with whether each is available."""
    a = available.select("table_name").distinct().withColumn("available", F.lit(True))
    return requested.select("table_name").join(a, "table_name", "left").withColumn(
        "available", F.coalesce(F.col("available"), F.lit(False)))


def reset_table(cursor: DataFrame, table: str) -> DataFrame:
    """Drop one table's cursor so its next run is a first run."""
    return cursor.filter(F.col("table_name") != F.lit(table))
