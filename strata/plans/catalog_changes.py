"""Named queries of the change-application operators (C1–C22) over the events feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import changes as CH
from strata.plans import feeds as FD
from strata.plans import silver as S
from strata.plans.oracle import LINE_ORDER_SQL, cte, sql
from strata.plans.registry import query
from strata.operators import windows

K, P = FD.KEY, FD.PAYLOAD
LIVE_COLS = [K, *P, CH.VERSION, CH.EFFECTIVE]
HIST_COLS = [K, *P, CH.VERSION, CH.START, CH.END, CH.CURRENT]

cte("ev", f"""SELECT user_id, event_type, value, event_id AS _version, ts AS _effective,
  coalesce(event_type = 'error', false) AS _deleted FROM events""")
cte("ev1", f"SELECT * FROM ev WHERE _effective < TIMESTAMP '{FD.CUT}'", "ev")
cte("ev2", f"SELECT * FROM ev WHERE _effective >= TIMESTAMP '{FD.CUT}'", "ev")
cte("st_all", "SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY _version DESC) = 1", "ev")
cte("st1", "SELECT * FROM ev1 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY _version DESC) = 1", "ev1")
cte("live_all", "SELECT user_id, event_type, value, _version, _effective FROM st_all WHERE NOT _deleted", "st_all")
cte("live1", "SELECT user_id, event_type, value, _version, _effective FROM st1 WHERE NOT _deleted", "st1")
cte("touched", "SELECT DISTINCT user_id FROM ev2", "ev2")
cte("hist", """SELECT user_id, event_type, value, _version, _deleted, __START_AT,
  lead(__START_AT) OVER (PARTITION BY user_id ORDER BY _version) AS __END_AT
FROM (SELECT *, max(_effective) OVER (PARTITION BY user_id ORDER BY _version
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS __START_AT FROM ev) x""", "ev")
cte("hist_view", """SELECT user_id, event_type, value, _version, __START_AT, __END_AT,
  (__END_AT IS NULL AND NOT _deleted) AS __CURRENT
FROM hist WHERE NOT _deleted AND (__END_AT IS NULL OR __END_AT > __START_AT)""", "hist")


@query("latest_per_key", sql(f"""SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) = 1"""))
def latest_per_key(t):
    """Latest delivery per (order, line) under the total tie-break order."""
    return windows.latest(t.lineitem, S.LINE_KEY, S.LINE_ORDER)


@query("changes_split", """SELECT event_id, user_id,
  CASE WHEN coalesce(event_type = 'error', false) THEN 'delete' ELSE 'upsert' END AS op FROM events""")
def changes_split(t):
    """Upserts and deletes of a feed (null-safe flag)."""
    ups, dels = CH.split(FD.feed(t), "is_delete")
    return (ups.select("event_id", K, F.lit("upsert").alias("op"))
            .unionByName(dels.select("event_id", K, F.lit("delete").alias("op"))))


@query("scd1_apply", sql("SELECT * FROM live_all", "live_all"))
def scd1_apply(t):
    """SCD1 upsert of the second half onto the first-half state (live rows)."""
    return CH.live(FD.scd1_state(t)).select(*LIVE_COLS)


@query("scd1_delete", sql("SELECT user_id, _version, _effective AS deleted_at FROM st_all WHERE _deleted", "st_all"))
def scd1_delete(t):
    """C4: keys hard-deleted by the feed (kept as hidden tombstones)."""
    return CH.tombstones(FD.scd1_state(t)).select(K, CH.VERSION, F.col(CH.EFFECTIVE).alias("deleted_at"))


@query("scd1_no_deletes", sql("""SELECT user_id, event_type, value, _version, _effective FROM ev WHERE NOT _deleted
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY _version DESC) = 1""", "ev"))
def scd1_no_deletes(t):
    """Deletes ignored — records retained, delete events dropped."""
    return CH.live(FD.scd1_state(t, track_deletes=False)).select(*LIVE_COLS)


@query("tombstones", sql("""SELECT user_id, event_type, value, _version, _deleted AS is_deleted,
  CASE WHEN _deleted THEN _effective END AS deleted_at, _effective AS record_valid_from,
  CASE WHEN _deleted THEN _effective END AS record_valid_to, NOT _deleted AS is_current FROM st_all""", "st_all"))
def tombstones(t):
    """C14: SCD1 state with deleted-row evidence columns."""
    return CH.with_tombstone_columns(FD.scd1_state(t))


@query("purge_tombstones", sql(f"""SELECT user_id, event_type, value, _version, _deleted, _effective FROM st_all
WHERE NOT (_deleted AND _effective < (SELECT max(ts) FROM events) - INTERVAL {FD.PURGE_HOURS} HOUR)""", "st_all"))
def purge_tombstones(t):
    """Tombstones older than the retention horizon removed."""
    horizon = t.events.agg(F.max("ts")).scalar() - F.expr(f"INTERVAL {FD.PURGE_HOURS} HOURS")
    return CH.purge(FD.scd1_state(t), horizon).select(K, *P, CH.VERSION, CH.DELETED, CH.EFFECTIVE)


@query("max_position", sql("""SELECT max(_version) AS max_version, max(_effective) AS max_ts, count(*) AS n_changes
FROM ev2""", "ev2"))
def max_position(t):
    """C11: cursor position reached by a batch."""
    b = FD.second_half(t)
    return b.agg(F.max("event_id").alias("max_version"), F.max("ts").alias("max_ts"),
                 F.count(F.lit(1)).alias("n_changes"))


cte("inc", """SELECT user_id, event_type, value, _version, _effective FROM (
  SELECT * FROM st1 UNION ALL SELECT * FROM ev2) u WHERE true
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY _version DESC) = 1 AND NOT _deleted""", "st1", "ev2")


@query("incremental_equals_rebuild", sql("""SELECT
  (SELECT count(*) FROM (SELECT * FROM inc EXCEPT ALL SELECT * FROM live_all) a) AS only_incremental,
  (SELECT count(*) FROM (SELECT * FROM live_all EXCEPT ALL SELECT * FROM inc) b) AS only_rebuild""",
    "live_all", "inc"))
def incremental_equals_rebuild(t):
    """C17: the incremental result equals a full rebuild for the same cutoff."""
    from strata.operators import quality
    return quality.assert_rebuild_equal(CH.live(FD.scd1_state(t)).select(*LIVE_COLS),
                                        CH.live(FD.scd1_rebuild(t)).select(*LIVE_COLS))


@query("diff_snapshots", sql("""SELECT coalesce(b.user_id, a.user_id) AS user_id,
  CASE WHEN b.user_id IS NULL THEN 'insert' WHEN a.user_id IS NULL THEN 'delete' ELSE 'update' END AS op,
  b.event_type AS before_event_type, b.value AS before_value, a.event_type AS after_event_type, a.value AS after_value
FROM live1 b FULL OUTER JOIN live_all a ON b.user_id = a.user_id
WHERE b.user_id IS NULL OR a.user_id IS NULL
   OR b.event_type IS DISTINCT FROM a.event_type OR b.value IS DISTINCT FROM a.value""", "live1", "live_all"))
def diff_snapshots(t):
    """Insert / delete / update between the live states at two cutoffs."""
    s0 = CH.apply_scd1(None, FD.norm(FD.first_half(t)), K)
    return CH.diff_snapshots(CH.live(s0), CH.live(FD.scd1_state(t)), K, P)


@query("hash_changed", sql("""SELECT n.* FROM (
  SELECT user_id, event_type, value, _version, _effective FROM ev2
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY _version DESC) = 1 AND NOT _deleted) n
LEFT JOIN live1 s ON n.user_id = s.user_id
WHERE s.user_id IS NULL OR n.event_type IS DISTINCT FROM s.event_type OR n.value IS DISTINCT FROM s.value""",
    "ev2", "live1"))
def hash_changed(t):
    """Incoming rows whose payload hash differs from the state (new keys kept)."""
    incoming = CH.live(CH.apply_scd1(None, FD.norm(FD.second_half(t)), K)).select(*LIVE_COLS)
    state = CH.live(CH.apply_scd1(None, FD.norm(FD.first_half(t)), K))
    return CH.drop_unchanged(incoming, state, K, P)


@query("change_feed", sql("""SELECT coalesce(b.user_id, a.user_id) AS user_id, c._change_type,
  CASE WHEN c._change_type IN ('delete', 'update_preimage') THEN b.event_type ELSE a.event_type END AS event_type,
  CASE WHEN c._change_type IN ('delete', 'update_preimage') THEN b.value ELSE a.value END AS value,
  CASE WHEN c._change_type IN ('delete', 'update_preimage') THEN b._version ELSE a._version END AS _version
FROM (SELECT * FROM live1 WHERE user_id IN (SELECT user_id FROM touched)) b
FULL OUTER JOIN (SELECT * FROM live_all WHERE user_id IN (SELECT user_id FROM touched)) a ON b.user_id = a.user_id
JOIN (VALUES ('insert'), ('delete'), ('update_preimage'), ('update_postimage')) c(_change_type)
  ON (c._change_type = 'insert' AND b.user_id IS NULL)
  OR (c._change_type = 'delete' AND a.user_id IS NULL)
  OR (c._change_type IN ('update_preimage', 'update_postimage') AND a.user_id IS NOT NULL AND b.user_id IS NOT NULL
      AND (b.event_type IS DISTINCT FROM a.event_type OR b.value IS DISTINCT FROM a.value))""",
    "live1", "live_all", "touched"))
def change_feed(t):
    """Row-level change feed of the batch (insert / delete / update pre- and post-images)."""
    s0 = CH.apply_scd1(None, FD.norm(FD.first_half(t)), K)
    touched = FD.second_half(t).select(K).groupBy(K).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    before = CH.live(s0).join(touched, K, "left_semi")
    after = CH.live(FD.scd1_state(t)).join(touched, K, "left_semi")
    return CH.change_feed(before, after, K, P, extra=[CH.VERSION])


@query("scd2_apply", sql("SELECT * FROM hist_view", "hist_view"))
def scd2_apply(t):
    """SCD2 history after applying the second half to the first-half history."""
    return CH.history_view(FD.scd2_history(t)).select(*HIST_COLS)


@query("scd2_out_of_order", sql("SELECT * FROM hist_view", "hist_view"))
def scd2_out_of_order(t):
    """Batches applied in reverse order with a redelivered batch give the same history."""
    return CH.history_view(FD.scd2_out_of_order(t)).select(*HIST_COLS)


@query("scd2_current", sql("SELECT * FROM hist_view WHERE __CURRENT", "hist_view"))
def scd2_current(t):
    """Current SCD2 rows."""
    from strata.operators import history
    return history.current(CH.history_view(FD.scd2_history(t))).select(*HIST_COLS)


@query("scd2_history", sql("""SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY __START_AT, _version)
  AS version_seq FROM hist_view""", "hist_view"))
def scd2_history(t):
    """Full history per key with its version sequence number."""
    from strata.operators import history
    return history.sequence_versions(CH.history_view(FD.scd2_history(t)).select(*HIST_COLS), K)


@query("scd2_delete", sql("""SELECT user_id, max(_version) AS last_version, max(__END_AT) AS closed_at
FROM hist_view GROUP BY user_id HAVING NOT bool_or(__CURRENT)""", "hist_view"))
def scd2_delete(t):
    """Keys whose last version was closed by a delete (soft delete: rows kept, none current)."""
    v = CH.history_view(FD.scd2_history(t))
    return (v.groupBy(K).agg(F.max(CH.VERSION).alias("last_version"), F.max(CH.END).alias("closed_at"),
                             F.max(F.col(CH.CURRENT).cast("int")).alias("_cur"))
            .filter(F.col("_cur") == 0).drop("_cur"))


@query("scd2_from_snapshot", sql("""SELECT user_id, event_type, value, _version, _effective AS __START_AT,
  CAST(NULL AS TIMESTAMP) AS __END_AT, true AS __CURRENT FROM live1""", "live1"))
def scd2_from_snapshot(t):
    """SCD2 history initialised from the first-half snapshot."""
    snap = CH.live(CH.apply_scd1(None, FD.norm(FD.first_half(t)), K))
    return CH.history_view(CH.snapshot_to_scd2(snap, K, P, CH.VERSION, CH.EFFECTIVE)).select(*HIST_COLS)


@query("null_key_quarantine", """SELECT 'quarantined' AS side, event_id, NULL::BIGINT AS user_id FROM events WHERE user_id % 7 = 0
UNION ALL SELECT 'state', max(event_id), user_id FROM events WHERE user_id % 7 <> 0 GROUP BY user_id""")
def null_key_quarantine(t):
    """Rows without a key are quarantined, and applying the batch three times gives what once gives."""
    feed = FD.feed(t).withColumn(K, F.when(F.col(K) % 7 != 0, F.col(K)))
    batch = FD.norm(feed)
    state = CH.apply_scd1(None, batch, K)
    for _ in range(2):
        state = CH.apply_scd1(state, batch, K)
    lost = CH.split_null_keys(batch, K)[1]
    return (lost.select(F.lit("quarantined").alias("side"), F.col(CH.VERSION).alias("event_id"), F.col(K).cast("long").alias(K))
            .unionByName(state.select(F.lit("state").alias("side"), F.col(CH.VERSION).alias("event_id"), F.col(K).cast("long").alias(K))))


@query("hash_separators", sql("""SELECT event_id, event_type || '|' AS a, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN '\\N' ELSE '|' || event_type END AS b,
  dense_rank() OVER (ORDER BY event_type || '|', event_id % 3) AS g FROM events"""))
def hash_separators(t):
    """Hashes of parts that hold the separator, the null token as text, and NULL: one per different list of parts."""
    from pyspark.sql import Window

    from strata.functions.keys import row_hash
    third = F.col("event_id") % 3
    rows = t.events.select("event_id", F.concat("event_type", F.lit("|")).alias("a"),
                           F.when(third == 0, F.lit(None)).when(third == 1, F.lit("\\N")).otherwise(F.concat(F.lit("|"), "event_type")).alias("b"))
    hashed = rows.withColumn("h", row_hash("a", "b"))
    groups = hashed.groupBy("h").agg(F.min("a").alias("ga"), F.min(F.col("event_id") % 3).alias("gb"))
    groups = groups.withColumn("g", F.dense_rank().over(Window.orderBy("ga", "gb")))   # one row per different hash: 15
    return hashed.join(groups.select("h", "g"), "h").select("event_id", "a", "b", "g")


@query("asof_scd2_history", sql("""SELECT e.event_id, h._version AS version, h.event_type AS state, h.value AS state_value
FROM events e LEFT JOIN hist h ON h.user_id = e.user_id AND h.__START_AT <= e.ts + INTERVAL 90 MINUTE
  AND (h.__END_AT IS NULL OR h.__END_AT > e.ts + INTERVAL 90 MINUTE) AND NOT h._deleted""", "hist"))
def asof_scd2_history(t):
    """D9 on timestamped SCD2 history: the version in force 90 minutes after each event, versions shorter than a day, open ones and none included."""
    from strata.operators import joins
    history = CH.history_view(FD.scd2_history(t)).select(F.col(K).alias("h_user"), F.col("event_type").alias("state"), F.col("value").alias("state_value"),
                                                          F.col(CH.VERSION).alias("version"), CH.START, CH.END)
    facts = t.events.select("event_id", K, (F.col("ts") + F.expr("INTERVAL 90 MINUTES")).alias("at"))
    out = joins.resolve_version(facts, history, [K], ["h_user"], at="at", start=CH.START, end=CH.END, unit="day")
    return out.select("event_id", "version", "state", "state_value")
