"""Structured Streaming counterparts of the batch operators.

The same DataFrame operators run on micro-batches: stateless Silver
projection and quality rules directly on the stream; keyed SCD1 / SCD2
application inside ``foreachBatch`` by idempotent merges, so a replayed epoch
changes nothing (exactly-once effect on the table).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import changes as CH
from strata.operators import quality as Q
from strata.sources import sinks


def read_changes(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental file discovery of a raw folder (checkpointed by the query)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", False).option("escape", '"').option("multiLine", True)
    return r.load(path)


def silver(stream: DataFrame, projection: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """O2: stateless filter + projection (the batch Silver function applied to the stream)."""
    return projection(stream)


def with_quality(stream: DataFrame, rules: Sequence[Q.Rule]) -> DataFrame:
    """O3: failing rule names and disposition as columns; split downstream by ``disposition``."""
    return (stream.withColumn("failed_rules", Q.failed_rules(rules))
            .withColumn("disposition", Q._disp(Q.severity_of(rules))))


def _event_time(stream: DataFrame, event_time: str) -> DataFrame:
    """Watermarks need TIMESTAMP (with time zone); wall-clock columns are read in the session zone."""
    if isinstance(stream.schema[event_time].dataType, T.TimestampNTZType):
        return stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return stream


def dedup(stream: DataFrame, key: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Redelivery dedup under an event-time watermark (bounded state)."""
    return _event_time(stream, event_time).withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))


def lag(stream: DataFrame, event_time: str, window: str, delay: str, by: Sequence[str] = ()) -> DataFrame:
    """Freshness per tumbling window: count and latest event time."""
    return (_event_time(stream, event_time).withWatermark(event_time, delay)
            .groupBy(F.window(event_time, window), *by)
            .agg(F.count(F.lit(1)).alias("events"), F.max(event_time).alias("latest_event")))


def apply_changes(path: str, key: Sequence[str], scd: int = 1, buckets: int = 16) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body applying a normalised micro-batch to a keyed table.

    Only the buckets that the batch touches are read and rewritten.  The merge is idempotent, so an epoch that is
    replayed after a failure between write and checkpoint gives the same table; no record of epochs is needed.
    """
    merge = CH.apply_scd1 if scd == 1 else CH.apply_scd2

    def run(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()     # read for the touched buckets and for the merge
        try:
            sinks.merge_table(batch, path, list(key), buckets, lambda state, changes: merge(state, changes, list(key)))
        finally:
            batch.unpersist()
    return run


def last_version_state(stream: DataFrame, key: str, version: str) -> DataFrame:
    """Last version seen per key, kept in streaming aggregation state (update mode)."""
    return stream.groupBy(key).agg(F.max(version).alias("last_version"), F.count(F.lit(1)).alias("changes"))


def version_guard(stream: DataFrame, key: Sequence[str], version: str, event_time: str, delay: str, keep: str) -> DataFrame:
    """Only changes whose version is above the highest one that the key has shown, with state that ends.

    The state of a key is its highest version and lives in Spark's keyed state; it ends once the watermark (``delay``
    behind the latest event time) has passed the key's last event by ``keep``, so it is as large as the keys of that
    time.  A change older than the key's state is dropped, equal versions in one batch come out once; after the state
    has ended a key starts anew, and the idempotent merges behind the guard decide.  A batch's rows of a key come in
    pieces (Arrow batches), and only the best row of each version is held: a key's rows of one micro-batch are bounded
    by the trigger's file limit.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    source = _event_time(stream, event_time).withWatermark(event_time, delay)
    names, state = source.columns, T.StructType([T.StructField("version", T.LongType()), T.StructField("last_ms", T.LongType())])
    kept_ms = int(pd.Timedelta(keep).total_seconds() * 1000)

    def guard(_, pieces, group):
        if group.hasTimedOut:
            group.remove()
            return
        high, last = group.get if group.exists else (None, 0)
        fresh: list[pd.DataFrame] = []
        for rows in pieces:
            rows = rows[rows[version].notna()]
            if high is not None:
                rows = rows[rows[version] > high]
            if len(rows):
                fresh.append(rows)
        if fresh:
            out = pd.concat(fresh).sort_values([version, event_time], kind="stable").drop_duplicates(version, keep="last")
            high = int(out[version].iloc[-1])
            last = max(last, int(out[event_time].max().timestamp() * 1000))
            yield out[names]
        if high is not None:
            group.update((high, last))
            group.setTimeoutTimestamp(max(last + kept_ms, group.getCurrentWatermarkMs() + 1))

    return source.groupBy(*key).applyInPandasWithState(guard, source.schema, state, "append", GroupStateTimeout.EventTimeTimeout)
