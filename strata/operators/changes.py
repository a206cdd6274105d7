"""Change application: split, latest-per-key, SCD1 / SCD2 merge, snapshot diff,
hash-compare CDC, tombstones, row-level change feed, purge.

There is no merge engine underneath: every operator is a DataFrame
transform (union, windowed pick, joins); ``strata.sources.sinks`` publishes the
partitions that it touches.  The contracts:

``apply_scd1`` — state rows carry the payload plus ``_version`` and
``_deleted``.  The winner per key is the maximum of
``(_version, _effective, _deleted, _row_hash)`` over ``state ∪ changes``,
which makes the operator commutative, associative and idempotent
(redelivery, reordering and retries are safe).  Rows with a
NULL in the key are not applied (``split_null_keys`` returns them for quarantine).  Deleted keys stay as hidden
tombstones so a late, older update cannot resurrect them; ``live`` filters
them out.

``apply_scd2`` — history rows carry the payload plus ``_version``,
``__START_AT``, ``__END_AT``, ``__CURRENT`` and ``_deleted`` (hidden delete
markers).  Only keys touched by the batch are rebuilt; their events are
ordered by version, ``start`` is the running maximum of the effective time,
``end`` the next event's start; zero-length versions are dropped (the later
one wins); a delete closes the open interval and opens none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.keys import row_hash
from strata.operators import windows

VERSION, DELETED, EFFECTIVE, HASH = "_version", "_deleted", "_effective", "_row_hash"
START, END, CURRENT = "__START_AT", "__END_AT", "__CURRENT"


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def delete_flag(c) -> Column:
    """Null-safe, case-insensitive delete flag: true only for an explicit true/1/yes."""
    col = F.col(c) if isinstance(c, str) else c
    s = F.lower(F.trim(col.cast("string")))
    return F.coalesce(s.isin("true", "1", "yes", "y", "t"), F.lit(False))


def split(changes: DataFrame, deleted: str | Column) -> tuple[DataFrame, DataFrame]:
    """(upserts, deletes) of a change feed; a NULL flag is an upsert."""
    flag = delete_flag(deleted)
    tagged = changes.withColumn("_is_delete", flag)
    return (tagged.filter(~F.col("_is_delete")).drop("_is_delete"),
            tagged.filter(F.col("_is_delete")).drop("_is_delete"))


def split_null_keys(changes: DataFrame, key) -> tuple[DataFrame, DataFrame]:
    """(rows with a whole key, rows with a NULL in it).  The second go to quarantine: no merge can address them."""
    whole = F.lit(True)
    for k in _cols(key):
        whole = whole & F.col(k).isNotNull()
    return changes.filter(whole), changes.filter(~whole)


def normalise(changes: DataFrame, key, payload: Sequence[str], version: str, deleted: str | Column | None,
              effective: str | None = None) -> DataFrame:
    """Change rows in the canonical change shape: key, payload, _version, _effective, _deleted, _row_hash."""
    keys = _cols(key)
    flag = delete_flag(deleted) if deleted is not None else F.lit(False)
    eff = F.col(effective) if effective else F.lit(None).cast("timestamp")
    return changes.select(*[F.col(k) for k in keys], *[F.col(p) for p in payload],
                          F.col(version).alias(VERSION), eff.alias(EFFECTIVE), flag.alias(DELETED),
                          row_hash(*payload).alias(HASH))


def winner_order() -> list[Column]:
    """Total order that picks the surviving change of a key."""
    return [F.col(VERSION).desc_nulls_last(), F.col(EFFECTIVE).desc_nulls_last(),
            F.col(DELETED).desc_nulls_last(), F.col(HASH).desc_nulls_last()]


def latest(df: DataFrame, key, order: Sequence) -> DataFrame:
    """Latest change per key (``row_number() = 1``; partial limit before the shuffle)."""
    return windows.latest(df, key, order)


def apply_scd1(state: DataFrame | None, changes: DataFrame, key, track_deletes: bool = True) -> DataFrame:
    """SCD1 merge of normalised ``changes`` into ``state`` (both in change shape).

    Returns the full new state including tombstones (``_deleted``).  With
    ``track_deletes=False`` delete events are ignored (records retained).
    Only keys present in ``changes`` are recomputed; other state rows pass
    through untouched (a bucketed sink rewrites only their buckets).
    """
    keys = _cols(key)
    changes = split_null_keys(changes, keys)[0]
    if not track_deletes:
        changes = changes.filter(~F.col(DELETED))
    if state is None:
        return latest(changes, keys, winner_order())
    touched = changes.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    untouched = state.join(touched, keys, "left_anti")
    rebuilt = latest(state.join(touched, keys, "left_semi").unionByName(changes), keys, winner_order())
    return untouched.unionByName(rebuilt)


def live(state: DataFrame) -> DataFrame:
    """Rows a reader sees: tombstones hidden, bookkeeping columns dropped."""
    return state.filter(~F.col(DELETED)).drop(DELETED, HASH)


def tombstones(state: DataFrame) -> DataFrame:
    return state.filter(F.col(DELETED))


def with_tombstone_columns(state: DataFrame) -> DataFrame:
    """C14: deleted-row evidence columns on an SCD1 state (tombstones visible)."""
    return state.select(
        *[c for c in state.columns if c not in (DELETED, HASH, EFFECTIVE)],
        F.col(DELETED).alias("is_deleted"),
        F.when(F.col(DELETED), F.col(EFFECTIVE)).alias("deleted_at"),
        F.col(EFFECTIVE).alias("record_valid_from"),
        F.when(F.col(DELETED), F.col(EFFECTIVE)).alias("record_valid_to"),
        (~F.col(DELETED)).alias("is_current"))


def purge(state: DataFrame, older_than: Column) -> DataFrame:
    """Drop tombstones whose delete time is before ``older_than``."""
    return state.filter(~(F.col(DELETED) & (F.col(EFFECTIVE) < older_than)))


#: Events from which on a key is spread over ranges of its versions, and about how many ranges it gets.
HOT_ROWS = 200_000
RANGES = 256


def _renamed(df: DataFrame, keys: list[str], *more: str) -> DataFrame:
    """The key columns as _k0, _k1 ..., so that a join leaves the events' own columns alone."""
    return df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *more)


def _on(keys: list[str]) -> Column:
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_k{i}"))
    return same


def _ranged(events: DataFrame, keys: list[str]) -> DataFrame:
    """With ``_range``: 0, but for keys of more than ``HOT_ROWS`` events the number of the key's range bounds up to the version.

    The bounds are versions that the key itself has (less than ``RANGES``, those of the smallest hashes), so ranges hold
    about as many versions each, whatever the type of the version and however it is spread.  A key's bounds are at most some
    hundred values; where no key is hot, which one aggregate tells when the plan is made, nothing of this is planned.
    """
    hot = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT_ROWS)
    if hot.isEmpty():       # one aggregate decides; the rest of the plan is only for hot keys
        return events.withColumns({"_hot": F.lit(False), "_range": F.lit(0)})
    versions = events.join(_renamed(hot, keys), _on(keys)).select(*keys, VERSION).filter(F.col(VERSION).isNotNull()).distinct()
    by_hash = Window.partitionBy(*keys).orderBy(F.xxhash64(VERSION), VERSION)
    chosen = versions.withColumn("_nth", F.row_number().over(by_hash)).filter(F.col("_nth") < RANGES)      # a limit in each task before the shuffle
    bounds = _renamed(chosen.groupBy(*keys).agg(F.sort_array(F.collect_list(VERSION)).alias("_bounds")), keys, "_bounds")
    out = events.join(bounds, _on(keys), "left")
    below = F.aggregate("_bounds", F.lit(0), lambda n, b: n + F.when(b <= F.col(VERSION), 1).otherwise(0))
    return (out.withColumn("_hot", F.col("_bounds").isNotNull()).withColumn("_range", F.coalesce(below, F.lit(0)))
            .drop("_bounds", *[f"_k{i}" for i in range(len(keys))]))


def _intervals(events: DataFrame, keys: list[str]) -> DataFrame:
    """Interval algebra over change-shaped events of whole keys.

    START is the running maximum of the effective time, END the next event's START.  One exchange by (key, range) serves
    both the choice of one event per version and the running windows; only hot keys have more than one range.  What a
    range takes over from those before it, and the START that follows it, come from one row per hot key and range, so a
    key with a third of all events is ordered in its ranges, never as a whole.
    """
    ev = _ranged(events, keys).repartition(*keys, "_range")
    # one event per (key, version): identical redeliveries collapse
    same = Window.partitionBy(*keys, "_range", VERSION).orderBy(F.col(EFFECTIVE).desc_nulls_last(), F.col(DELETED).desc_nulls_last(), F.col(HASH).desc_nulls_last())
    ev = ev.withColumn("_nth", F.row_number().over(same)).filter(F.col("_nth") == 1).drop("_nth")
    of_key = Window.partitionBy(*keys).orderBy("_range")
    edges = ev.filter("_hot").groupBy(*keys, "_range").agg(F.max(EFFECTIVE).alias("_most"), F.min_by(F.struct(EFFECTIVE), VERSION).alias("_first"))
    edges = edges.withColumn("_before", F.max("_most").over(of_key.rowsBetween(Window.unboundedPreceding, -1)))
    edges = edges.withColumn("_next", F.lead(F.greatest("_before", F.col(f"_first.{EFFECTIVE}"))).over(of_key))
    ev = ev.join(_renamed(edges, keys, F.col("_range").alias("_r"), "_before", "_next"), _on(keys) & (F.col("_range") == F.col("_r")), "left")
    w = Window.partitionBy(*keys, "_range").orderBy(F.col(VERSION).asc())
    ev = ev.withColumn(START, F.greatest("_before", F.max(EFFECTIVE).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    ev = ev.withColumn(END, F.coalesce(F.lead(START).over(w), F.when(F.lead(F.lit(1)).over(w).isNull(), F.col("_next"))))
    ev = ev.drop("_range", "_hot", "_r", "_before", "_next", *[f"_k{i}" for i in range(len(keys))])
    # Zero-length versions (superseded by a later version with the same start)
    # stay stored so that a later rebuild sees every event; views hide them.
    return ev.withColumn(CURRENT, F.col(END).isNull() & ~F.col(DELETED))


def apply_scd2(history: DataFrame | None, changes: DataFrame, key) -> DataFrame:
    """SCD2 merge: rebuild intervals of touched keys from their history and the new events.

    ``history`` is a previous result of this function (visible versions and
    hidden delete markers); ``changes`` are normalised change rows.
    """
    keys = _cols(key)
    changes = split_null_keys(changes, keys)[0]
    if history is None:
        return _intervals(changes, keys)
    touched = changes.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    untouched = history.join(touched, keys, "left_anti")
    past = history.join(touched, keys, "left_semi").drop(START, END, CURRENT)
    rebuilt = _intervals(past.unionByName(changes), keys)
    return untouched.unionByName(rebuilt)


def history_view(history: DataFrame) -> DataFrame:
    """Visible SCD2 rows: delete markers and zero-length versions hidden."""
    visible = ~F.col(DELETED) & (F.col(END).isNull() | (F.col(END) > F.col(START)))
    return history.filter(visible).drop(DELETED, HASH, EFFECTIVE)


def snapshot_to_scd2(snapshot: DataFrame, key, payload: Sequence[str], version: str, effective: str) -> DataFrame:
    """Initialise SCD2 history from a full snapshot (one open version per key)."""
    ev = normalise(snapshot, key, payload, version, None, effective)
    return _intervals(ev, _cols(key))


def diff_snapshots(before: DataFrame, after: DataFrame, key, payload: Sequence[str]) -> DataFrame:
    """(key, op, before.*, after.*) — insert / delete / update; unchanged keys omitted."""
    keys = _cols(key)
    b = before.select(*keys, *[F.col(p).alias(f"before_{p}") for p in payload],
                      row_hash(*payload).alias("_hb"))
    a = after.select(*keys, *[F.col(p).alias(f"after_{p}") for p in payload],
                     row_hash(*payload).alias("_ha"), F.lit(True).alias("_in_after"))
    b = b.withColumn("_in_before", F.lit(True))
    j = b.join(a, keys, "full_outer")
    op = (F.when(F.col("_in_before").isNull(), "insert")
          .when(F.col("_in_after").isNull(), "delete")
          .when(~F.col("_hb").eqNullSafe(F.col("_ha")), "update"))
    return (j.withColumn("op", op).filter(F.col("op").isNotNull())
            .select(*keys, "op", *[f"before_{p}" for p in payload], *[f"after_{p}" for p in payload]))


def drop_unchanged(incoming: DataFrame, state: DataFrame, key, payload: Sequence[str]) -> DataFrame:
    """Keep incoming rows that are new or whose payload hash differs from the state."""
    keys = _cols(key)
    s = state.select(*keys, row_hash(*payload).alias("_hs"))
    return (incoming.withColumn("_hi", row_hash(*payload)).join(s, keys, "left")
            .filter(~F.col("_hi").eqNullSafe(F.col("_hs"))).drop("_hi", "_hs"))


def change_feed(before: DataFrame, after: DataFrame, key, payload: Sequence[str],
                extra: Sequence[str] = ()) -> DataFrame:
    """Row-level change feed between two live states of the touched keys.

    ``insert`` / ``delete`` rows carry the after / before image; an update
    yields an ``update_preimage`` and an ``update_postimage`` row.
    """
    keys = _cols(key)
    cols = list(payload) + list(extra)
    b = before.select(*keys, *[F.col(c).alias(f"b_{c}") for c in cols], row_hash(*payload).alias("_hb"),
                      F.lit(True).alias("_inb"))
    a = after.select(*keys, *[F.col(c).alias(f"a_{c}") for c in cols], row_hash(*payload).alias("_ha"),
                     F.lit(True).alias("_ina"))
    j = b.join(a, keys, "full_outer")
    pre = F.struct(F.lit("update_preimage").alias("_change_type"), *[F.col(f"b_{c}").alias(c) for c in cols])
    post = F.struct(F.lit("update_postimage").alias("_change_type"), *[F.col(f"a_{c}").alias(c) for c in cols])
    ins = F.struct(F.lit("insert").alias("_change_type"), *[F.col(f"a_{c}").alias(c) for c in cols])
    dele = F.struct(F.lit("delete").alias("_change_type"), *[F.col(f"b_{c}").alias(c) for c in cols])
    rows = (F.when(F.col("_inb").isNull(), F.array(ins))
            .when(F.col("_ina").isNull(), F.array(dele))
            .when(~F.col("_hb").eqNullSafe(F.col("_ha")), F.array(pre, post))
            .otherwise(F.array()))
    return j.select(*keys, F.inline(rows))
