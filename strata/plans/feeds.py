"""The fixture's change feed (FIXTURES.md §3).

``events`` is read as a change feed: key ``user_id``, version ``event_id``,
effective time ``ts``, delete flag ``event_type = 'error'``, payload
``(event_type, value)``.  The earlier state is built from the events before
``CUT`` and the later events are applied to it as a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import changes as CH

# Fixed values of the fixture feed.
KEY = "user_id"
PAYLOAD = ["event_type", "value"]
CUT = "2024-01-16"
PURGE_HOURS = 12     # retention of tombstones before the feed's last event


def feed(t) -> DataFrame:
    return t.events.withColumn("is_delete", F.col("event_type") == "error")


def first_half(t) -> DataFrame:
    return feed(t).filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))


def second_half(t) -> DataFrame:
    return feed(t).filter(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz"))


def norm(df: DataFrame) -> DataFrame:
    return CH.normalise(df, KEY, PAYLOAD, "event_id", "is_delete", "ts")


def scd1_state(t, track_deletes: bool = True) -> DataFrame:
    """State after the first half, then the second half applied as one batch."""
    s0 = CH.apply_scd1(None, norm(first_half(t)), KEY, track_deletes)
    return CH.apply_scd1(s0, norm(second_half(t)), KEY, track_deletes)


def scd1_rebuild(t) -> DataFrame:
    return CH.apply_scd1(None, norm(feed(t)), KEY)


def scd2_history(t) -> DataFrame:
    h0 = CH.apply_scd2(None, norm(first_half(t)), KEY)
    return CH.apply_scd2(h0, norm(second_half(t)), KEY)


def scd2_out_of_order(t) -> DataFrame:
    """Second half first; then the first half delivered twice (redelivery)."""
    h0 = CH.apply_scd2(None, norm(second_half(t)), KEY)
    late = norm(first_half(t)).unionByName(norm(first_half(t)))
    return CH.apply_scd2(h0, late, KEY)
