"""Named queries of run control (2.N), ingest (2.A) and layout (2.R) over fixture-derived tables.

The fixture has no run log, so the cursor table is derived from the events
feed: each user stream is a source table (``tbl_<user_id>``), its last event
is the last run (time, version) and the event type stands for the outcome.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import control as CT, layout as LY
from strata.plans import feeds as FD
from strata.plans.oracle import cte, sql
from strata.plans.registry import query
from strata.sources import ingest

# Fixed values of the fixture run log.
NOW = "2024-01-31 00:00:00"
STUCK_HOURS = 6
STALE_HOURS = 48
BATCH_SIZE = 50
SECONDS_PER_TABLE = 5
OUTCOME_OF_EVENT = {"purchase": "SUCCESS", "click": "SUCCESS", "error": "FAILED", "view": "RUNNING",
                    "signup": "NEVER_RUN"}


def cursor(t):
    """Cursor table: one row per source table (user stream) from its latest event."""
    ev = t.events
    last = ev.groupBy("user_id").agg(F.max_by(F.struct("event_type", "ts", "event_id"), "event_id").alias("l"),
                                     F.count(F.lit(1)).alias("row_count"))
    from strata.functions.columns import decode
    return last.select(
        F.concat(F.lit("tbl_"), F.col("user_id").cast("string")).alias("table_name"),
        F.col("l.event_id").alias("last_versionnumber"),
        F.col("l.ts").alias("last_run_ts"), "row_count",
        decode(F.col("l.event_type"), OUTCOME_OF_EVENT, "FAILED").alias("status"),
        F.lit(None).cast("string").alias("error_message"))


cte("cur", """SELECT 'tbl_' || CAST(user_id AS VARCHAR) AS table_name, arg_max(event_id, event_id) AS last_versionnumber,
  arg_max(ts, event_id) AS last_run_ts, count(*) AS row_count,
  CASE arg_max(event_type, event_id) WHEN 'purchase' THEN 'SUCCESS' WHEN 'click' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED'
    WHEN 'view' THEN 'RUNNING' WHEN 'signup' THEN 'NEVER_RUN' ELSE 'FAILED' END AS status,
  CAST(NULL AS VARCHAR) AS error_message
FROM events GROUP BY user_id""")
cte("cls", f"""SELECT c.*, CASE WHEN c.status IS NULL OR c.status = 'NEVER_RUN' THEN 'never_run'
  WHEN c.status = 'SUCCESS' THEN CASE WHEN c.last_run_ts < TIMESTAMP '{NOW}' - INTERVAL {STALE_HOURS} HOUR THEN 'stale' ELSE 'fresh' END
  ELSE 'failed' END AS class FROM cur c""", "cur")
cte("planned", f"""SELECT *, row_number() OVER (ORDER BY priority, last_run_ts ASC NULLS FIRST, table_name) AS ordinal
FROM (SELECT *, CASE class WHEN 'failed' THEN 1 WHEN 'never_run' THEN 2 WHEN 'stale' THEN 3 WHEN 'fresh' THEN 4 END AS priority
      FROM cls WHERE class <> 'fresh') x""", "cls")


def _classified(t):
    c = cursor(t)
    return CT.classify(c.select("table_name"), c, F.lit(NOW).cast("timestamp_ntz"), STALE_HOURS)


@query("recover_stuck", sql(f"""SELECT table_name, last_versionnumber, last_run_ts, row_count,
  CASE WHEN status = 'RUNNING' AND last_run_ts < TIMESTAMP '{NOW}' - INTERVAL {STUCK_HOURS} HOUR THEN 'FAILED' ELSE status END AS status,
  CASE WHEN status = 'RUNNING' AND last_run_ts < TIMESTAMP '{NOW}' - INTERVAL {STUCK_HOURS} HOUR
    THEN 'recovered: RUNNING for more than {STUCK_HOURS}h' ELSE error_message END AS error_message FROM cur""", "cur"))
def recover_stuck(t):
    """RUNNING older than the limit becomes FAILED with a note."""
    return CT.recover_stuck(cursor(t), F.lit(NOW).cast("timestamp_ntz"), STUCK_HOURS)


@query("reset_running", sql("""SELECT table_name, last_versionnumber, last_run_ts, row_count,
  CASE WHEN status = 'RUNNING' THEN 'FAILED' ELSE status END AS status,
  CASE WHEN status = 'RUNNING' THEN 'reset by operator while RUNNING' ELSE error_message END AS error_message FROM cur""", "cur"))
def reset_running(t):
    """Reset every RUNNING table."""
    return CT.reset_running(cursor(t))


@query("classify_tables", sql("SELECT * FROM cls", "cls"))
def classify_tables(t):
    """Failed / never_run / stale / fresh per table."""
    return _classified(t)


@query("plan_resume", sql("SELECT * EXCLUDE (ordinal) FROM planned", "planned"))
def plan_resume(t):
    """Priority order for the resume mode."""
    return CT.plan(_classified(t), "resume")


@query("plan_failed_only", sql("SELECT *, 1 AS priority FROM cls WHERE class = 'failed'", "cls"))
def plan_failed_only(t):
    """Failed tables only, those found RUNNING among them."""
    return CT.plan(_classified(t), "failed_only")


@query("watermark_listing", sql("""SELECT table_name, status, last_versionnumber, last_run_ts,
  date_diff('second', last_run_ts, TIMESTAMP '%s') / 3600 AS hours_behind FROM cur""" % NOW, "cur").replace("/ 3600", "// 3600"))
def watermark_listing(t):
    """Position and age of every table's watermark."""
    now = F.lit(NOW).cast("timestamp_ntz").cast("timestamp")
    behind = F.floor((F.unix_timestamp(now) - F.unix_timestamp(F.col("last_run_ts").cast("timestamp"))) / 3600)
    return cursor(t).select("table_name", "status", "last_versionnumber", "last_run_ts", behind.alias("hours_behind"))


@query("plan_batches", sql(f"""SELECT *, CAST(ceil(ordinal / {BATCH_SIZE}) AS INTEGER) AS batch FROM planned""", "planned"))
def plan_batches(t):
    """ordinal and batch number of the ordered work list."""
    return CT.plan_batches(CT.plan(_classified(t), "resume"), BATCH_SIZE)


@query("preview_plan", sql(f"""SELECT class, count(*) AS tables, count(DISTINCT CAST(ceil(ordinal / {BATCH_SIZE}) AS INTEGER)) AS batches,
  min(ordinal) AS first_ordinal FROM planned GROUP BY class""", "planned"))
def preview_plan(t):
    """Dry-run plan summary per class (tables, batches, first position)."""
    p = CT.plan_batches(CT.plan(_classified(t), "resume"), BATCH_SIZE)
    return p.groupBy("class").agg(F.count(F.lit(1)).alias("tables"), F.count_distinct("batch").alias("batches"),
                                  F.min("ordinal").alias("first_ordinal"))


@query("dry_run", sql(f"""SELECT (SELECT count(*) FROM planned) AS would_process, (SELECT count(*) FROM cur) - (SELECT count(*) FROM planned) AS would_skip,
  CAST(ceil((SELECT count(*) FROM planned) / {BATCH_SIZE}) AS INTEGER) AS batches, (SELECT count(*) FROM planned) * {SECONDS_PER_TABLE} AS estimated_seconds,
  (SELECT list(table_name ORDER BY ordinal) FROM planned WHERE ordinal <= 10) AS first_tables""", "planned"))
def dry_run(t):
    """The execution plan as one row, with its first ten tables and an estimate."""
    return CT.preview(CT.plan_batches(CT.plan(_classified(t), "resume"), BATCH_SIZE), cursor(t), BATCH_SIZE, SECONDS_PER_TABLE)


_LAYERS = ("raw", "silver", "gold")


@query("layer_watermarks", sql("""SELECT l.layer, c.table_name, CASE WHEN last_versionnumber % 3 >= l.k THEN last_versionnumber - l.k END AS last_versionnumber,
  CASE WHEN last_versionnumber % 3 >= l.k THEN last_run_ts END AS last_run_ts, CASE WHEN last_versionnumber % 3 >= l.k THEN status ELSE 'NEVER_RUN' END AS status
FROM cur c, (VALUES ('raw', 0), ('silver', 1), ('gold', 2)) l(layer, k)""", "cur"))
def layer_watermarks(t):
    """One position per layer and table; later layers lag behind and some have not run."""
    c = cursor(t).select("table_name", "last_versionnumber", "last_run_ts", "status")
    k = F.explode(F.array(*(F.struct(F.lit(n).alias("layer"), F.lit(i).alias("k")) for i, n in enumerate(_LAYERS))))
    every = c.select("*", k.alias("l")).select("l.layer", "l.k", "table_name", "last_versionnumber", "last_run_ts", "status")
    ran = every.filter("last_versionnumber % 3 >= k").withColumn("last_versionnumber", F.col("last_versionnumber") - F.col("k"))
    earlier = ran.withColumn("last_versionnumber", F.col("last_versionnumber") - 10).withColumn("status", F.lit("FAILED"))
    return CT.layer_watermarks(ran.unionByName(earlier), every.select("layer", "table_name"))


@query("control_listing", sql(f"""SELECT table_name, status, last_run_ts,
  (CAST(floor(epoch(TIMESTAMP '{NOW}')) AS BIGINT) - CAST(floor(epoch(last_run_ts)) AS BIGINT)) // 3600 AS hours_since,
  status = 'RUNNING' AND last_run_ts < TIMESTAMP '{NOW}' - INTERVAL {STUCK_HOURS} HOUR AS is_stuck,
  CASE WHEN status = 'FAILED' THEN CASE WHEN last_versionnumber % 2 = 0 THEN 'code ' || last_versionnumber ELSE 'no message' END END AS error FROM cur""", "cur"))
def control_listing(t):
    """Every table's state; failures without a message, or with a blank one, say so."""
    c = cursor(t)
    message = F.when(F.col("last_versionnumber") % 2 == 0, F.concat(F.lit("code "), F.col("last_versionnumber").cast("string"))).when(F.col("last_versionnumber") % 3 == 0, F.lit("  "))
    return CT.listing(c.withColumn("error_message", message), F.lit(NOW).cast("timestamp_ntz"), STUCK_HOURS)


@query("status_counts", sql("SELECT status, count(*) AS tables FROM cur GROUP BY status", "cur"))
def status_counts(t):
    """E5: tables per status."""
    return CT.status_counts(cursor(t))


@query("failed_recent", sql("""SELECT * FROM cur WHERE status = 'FAILED' ORDER BY last_run_ts DESC, table_name LIMIT 20""", "cur"))
def failed_recent(t):
    """The 20 most recent failures."""
    return CT.failed_recent(cursor(t), 20)


@query("dashboard", sql(f"""SELECT status, count(*) AS tables, max(last_run_ts) AS last_run,
  count(*) FILTER (WHERE status = 'RUNNING' AND last_run_ts < TIMESTAMP '{NOW}' - INTERVAL {STUCK_HOURS} HOUR) AS stuck
FROM cur GROUP BY status""", "cur"))
def dashboard(t):
    """Status dashboard — counts, latest run and stuck runs per status."""
    c = cursor(t)
    stuck = (F.col("status") == "RUNNING") & (F.col("last_run_ts") < F.lit(NOW).cast("timestamp_ntz")
                                              - F.expr(f"INTERVAL {STUCK_HOURS} HOURS"))
    return c.groupBy("status").agg(F.count(F.lit(1)).alias("tables"), F.max("last_run_ts").alias("last_run"),
                                   F.count_if(stuck).alias("stuck"))


cte("runs", """SELECT CAST(ts AS DATE) AS run_id, 'tbl_' || CAST(user_id AS VARCHAR) AS table_name,
  CASE WHEN arg_max(event_type, event_id) = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  count(*) AS rows, min(ts) AS started, max(ts) AS finished FROM events GROUP BY 1, 2""")


def run_tables(t):
    ev = t.events.withColumn("run_id", F.to_date("ts"))
    g = ev.groupBy("run_id", "user_id").agg(F.max_by("event_type", "event_id").alias("last_type"),
                                            F.count(F.lit(1)).alias("rows"), F.min("ts").alias("started"), F.max("ts").alias("finished"))
    return g.select("run_id", "rows", F.concat(F.lit("tbl_"), F.col("user_id").cast("string")).alias("table_name"),
                    F.when(F.col("last_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
                    "started", "finished")


@query("run_outcome", sql("""SELECT run_id, count(*) AS tables_processed, count(*) FILTER (WHERE status = 'SUCCESS') AS tables_succeeded,
  count(*) FILTER (WHERE status <> 'SUCCESS') AS tables_failed, min(started) AS run_started, max(finished) AS run_finished,
  CASE WHEN count(*) FILTER (WHERE status <> 'SUCCESS') = 0 THEN 'SUCCESS'
       WHEN count(*) FILTER (WHERE status = 'SUCCESS') = 0 THEN 'FAILED' ELSE 'PARTIAL' END AS status,
  CAST(floor(epoch(max(finished))) AS BIGINT) - CAST(floor(epoch(min(started))) AS BIGINT) AS duration_seconds
FROM runs GROUP BY run_id""", "runs"))
def run_outcome(t):
    """Run log rows with SUCCESS / PARTIAL / FAILED outcome (one run per day)."""
    return CT.run_outcome(run_tables(t))


@query("run_log", sql("""SELECT run_id, count(*) AS tables_processed, count(*) FILTER (WHERE status = 'SUCCESS') AS tables_succeeded,
  count(*) FILTER (WHERE status <> 'SUCCESS') AS tables_failed, min(started) AS run_started, max(finished) AS run_finished,
  CASE WHEN count(*) FILTER (WHERE status <> 'SUCCESS') = 0 THEN 'SUCCESS'
       WHEN count(*) FILTER (WHERE status = 'SUCCESS') = 0 THEN 'FAILED' ELSE 'PARTIAL' END AS status,
  CAST(floor(epoch(max(finished))) AS BIGINT) - CAST(floor(epoch(min(started))) AS BIGINT) AS duration_seconds, CAST(sum(rows) AS BIGINT) AS total_rows,
  (SELECT count(*) FROM cur) AS tables_in_scope, (SELECT count(*) FROM cur) - count(*) AS tables_skipped, 'resume' AS run_mode, false AS force_full, 'batches of 50' AS notes
FROM runs GROUP BY run_id""", "runs", "cur"))
def run_log(t):
    """The run history's rows: outcome, duration, tables in scope, processed and skipped, rows and mode."""
    return CT.run_log(run_tables(t), cursor(t), "resume", notes=f"batches of {BATCH_SIZE}")


@query("last_run", sql("""SELECT * FROM (SELECT run_id, min(started) AS run_started, count(*) AS tables_processed FROM runs GROUP BY 1)
ORDER BY run_started DESC, run_id DESC LIMIT 1""", "runs"))
def last_run(t):
    """the latest run."""
    r = run_tables(t).groupBy("run_id").agg(F.min("started").alias("run_started"),
                                            F.count(F.lit(1)).alias("tables_processed"))
    return CT.last_run(r)


@query("scope_tables", sql("""SELECT r.table_name, c.table_name IS NOT NULL AS available
FROM (SELECT 'tbl_' || CAST(user_id + 100 AS VARCHAR) AS table_name FROM events GROUP BY user_id) r
LEFT JOIN (SELECT DISTINCT table_name FROM cur) c ON r.table_name = c.table_name""", "cur"))
def scope_tables(t):
    """H5: requested ∩ available tables; missing ones reported (requested = ids shifted by 100)."""
    req = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).select(
        F.concat(F.lit("tbl_"), (F.col("user_id") + 100).cast("string")).alias("table_name"))
    return CT.scope_tables(req, cursor(t))


@query("folder_ts", """SELECT event_id, date_trunc('second', ts) AS ts_second,
  strptime(regexp_extract('/landing/events/Changelog/' || strftime(ts, '%Y-%m-%dT%H-%M-%S') || '/part-0.csv',
    '(\\d{4}-\\d{2}-\\d{2})T(\\d{2})-(\\d{2})-(\\d{2})', 0), '%Y-%m-%dT%H-%M-%S') AS folder_ts FROM events""")
def folder_ts(t):
    """A5: folder timestamp parsed back from folder paths written per event second."""
    path = F.concat(F.lit("/landing/events/Changelog/"), F.date_format("ts", "yyyy-MM-dd'T'HH-mm-ss"),
                    F.lit("/part-0.csv"))
    return t.events.select("event_id", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts_second"),
                           ingest.folder_ts(path).cast("timestamp_ntz").alias("folder_ts"))


@query("folders_after_cursor", f"""SELECT DISTINCT date_trunc('hour', ts) AS folder_ts FROM events
WHERE date_trunc('hour', ts) > TIMESTAMP '{FD.CUT}'""")
def folders_after_cursor(t):
    """Hourly change folders after the cursor position."""
    f = t.events.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("folder_ts")).distinct()
    return ingest.new_folders(f, F.lit(FD.CUT).cast("timestamp_ntz"))


@query("incremental_scan", f"SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def incremental_scan(t):
    """Raw rows above the watermark (pushed to the parquet scan)."""
    return ingest.incremental_scan(t.events, "ts", F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))


@query("document_metadata", "SELECT doc_id, lang, source, n_chars AS body_chars FROM documents")
def document_metadata(t):
    """Attachment metadata only — the body is never selected."""
    return ingest.attachment_metadata(t.documents, ["doc_id", "lang", "source"], "n_chars")


@query("flatten_envelope", "SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def flatten_envelope(t):
    """JSON envelope lifted to columns."""
    return ingest.flatten_envelope(t.events, "props", "k int")


@query("load_mode", """SELECT 'events' AS table_name, count(*) AS rows,
  CASE WHEN count(*) FILTER (WHERE event_id IS NULL OR ts IS NULL OR event_type IS NULL) = 0 THEN 'incremental' ELSE 'full' END AS load_mode,
  '' AS missing_columns FROM events
UNION ALL SELECT 'orders', count(*), 'full', 'versionnumber' FROM orders""")
def load_mode(t):
    """Incremental only when version / watermark / delete columns exist and are populated."""
    return (ingest.choose_mode(t.events, "events", ["event_id", "ts", "event_type"])
            .unionByName(ingest.choose_mode(t.orders, "orders", ["o_orderkey", "versionnumber"])))


@query("partition_stats", """SELECT 'o_orderstatus' AS column_name, count(*) AS distinct_values, min(n) AS min_rows,
  max(n) AS max_rows, sum(n) AS rows, CAST(max(n) AS DOUBLE) / (CAST(sum(n) AS DOUBLE) / CAST(count(*) AS DOUBLE)) AS skew
FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) a
UNION ALL SELECT 'o_orderpriority', count(*), min(n), max(n), sum(n),
  CAST(max(n) AS DOUBLE) / (CAST(sum(n) AS DOUBLE) / CAST(count(*) AS DOUBLE))
FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) b
UNION ALL SELECT 'o_custkey', count(*), min(n), max(n), sum(n),
  CAST(max(n) AS DOUBLE) / (CAST(sum(n) AS DOUBLE) / CAST(count(*) AS DOUBLE))
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) c""")
def partition_stats(t):
    """Cardinality and skew of partition-column candidates."""
    return LY.partition_stats(t.orders, ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query("column_stats", """SELECT (SELECT count(*) FROM orders) AS rows, column_name, non_null, distinct_values, min_value, max_value FROM (
  SELECT 'o_orderstatus' AS column_name, count(o_orderstatus) AS non_null, count(DISTINCT o_orderstatus) AS distinct_values,
    min(o_orderstatus) AS min_value, max(o_orderstatus) AS max_value FROM orders
  UNION ALL SELECT 'o_orderpriority', count(o_orderpriority), count(DISTINCT o_orderpriority), min(o_orderpriority),
    max(o_orderpriority) FROM orders) s""")
def column_stats(t):
    """One-pass column statistics."""
    return LY.column_stats(t.orders, ["o_orderstatus", "o_orderpriority"])


@query("split_wide", "SELECT doc_id, lang, source, n_chars FROM documents")
def split_wide(t):
    """Wide text split off; the narrow part keeps key + small columns."""
    narrow, _ = LY.split_wide(t.documents, ["doc_id"], ["text"])
    return narrow
