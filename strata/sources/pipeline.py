"""Ingest of one table: manifest, folders and cursor to the merged table.

One scan reads all folders of a run, whatever their number; one aggregate over it counts the rows and is the gate, and
one merge (or a rebuild from the newest snapshot) applies them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import changes as CH
from strata.sources import ingest, schema, sinks


def list_folders(spark: SparkSession, base: str, table: str, environment: str | None = None) -> list[tuple[str, dt.datetime]]:
    """(path, folder time) of a table's snapshot and changelog folders: a directory listing, nothing is opened."""
    jvm = spark.sparkContext._jvm
    out = []
    for kind in ingest.FOLDER_KINDS:
        pattern = jvm.org.apache.hadoop.fs.Path(f"{ingest.source_path(base, table, kind, environment)}/*")
        found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
        paths = [s.getPath().toString() for s in found or [] if s.isDirectory()]
        stamps = {p: p.rstrip("/").rpartition("/")[2] for p in paths}
        for p, stamp in stamps.items():
            try:
                out.append((p, dt.datetime.strptime(stamp, "%Y-%m-%dT%H-%M-%S")))
            except ValueError:      # not an export folder
                continue
    return sorted(out, key=lambda x: x[1])


def _fenced(changes: DataFrame, known: DataFrame | None, key: str, fence: int | None) -> DataFrame:
    """``changes`` without those that a snapshot up to version ``fence`` has overtaken: not newer, and of a key that ``known`` lacks.

    Versions rise over the whole table, so a snapshot holds every key that lived at its greatest version; an older change
    of another key is of a row that had gone by then.
    """
    if fence is None or known is None:
        return changes
    newer = F.col(CH.VERSION) > F.lit(fence)
    keys = known.select(key).distinct()
    return changes.filter(newer).unionByName(changes.filter(~newer).join(keys, key, "left_semi"))


def ingest_table(spark: SparkSession, base: str, table: str, columns: DataFrame, target: str, cursor_ts: dt.datetime | None = None,
                 scd: int = 1, buckets: int = 16, version: str = "versionnumber", effective: str = "modifiedon", deleted: str = "IsDelete",
                 environment: str | None = None, quarantine: str | None = None, force: bool = False, fence: int | None = None) -> dict:
    """C20: land a table's folders and bring ``target`` up to date.

    The first run (no cursor) and a forced one rebuild: the newest snapshot is the whole table, older snapshots are not
    read, and of the changelogs everything counts that this snapshot has not overtaken (``_fenced``).  ``target`` is
    replaced, so a key that the snapshot lacks is gone unless a later change brings it back.  Other runs merge the folders newer than ``cursor_ts``
    (a snapshot among them is merged as well; rows that vanished go with the next forced run); ``fence`` is that of the
    last rebuild and keeps late deliveries of old changes from bringing back what it dropped.

    A7: a changelog row without a version fails the run before anything is written; the table needs a forced run once the export is mended.

    ``columns`` are the manifest's rows (``schema.manifest_columns``).  Rows with values past the manifest's fields and
    rows without a key are not merged; with ``quarantine`` they are appended there.  Returns the run: status, mode, folders,
    rows, corrupt, unkeyed, deletes, unversioned, max_version, error, the fence and the next cursor.  Runs are idempotent, so a failed one is repeated as it was.
    """
    full = force or cursor_ts is None
    folders = [f for f in list_folders(spark, base, table, environment) if full or f[1] > cursor_ts]
    is_snapshot = {p: p.rstrip("/").split("/")[-2] == ingest.FOLDER_KINDS[0] for p, _ in folders}
    last = next((f for f in reversed(folders) if is_snapshot[f[0]]), None)
    if full and last:
        folders = [f for f in folders if f == last or not is_snapshot[f[0]]]
    run = {"table_name": table, "status": "NO_NEW_DATA", "mode": "full" if full else "incremental", "folders": len(folders), "rows": 0, "corrupt": 0, "unkeyed": 0,
           "deletes": 0, "unversioned": 0, "max_version": None, "error": None, "fence": fence, "cursor_ts": cursor_ts}
    if not folders:
        return run
    kind = schema.struct_of(columns, table)
    key = schema.resolve_key(columns.filter(F.col("table_name") == table)).first()["key_column"]
    rows = ingest.read_positional_csv(spark, [p for p, _ in folders], kind)
    snapshot = F.lit(False) if not last else F.col("source_file").contains(f"/{ingest.FOLDER_KINDS[0]}/")
    bad, lost = F.col(ingest.CORRUPT).isNotNull(), F.col(key).isNull()
    good = ~bad & ~lost
    rows = rows.withColumn("_snapshot", snapshot).persist()       # the folders are read once: gate, merge and quarantine take it from here
    try:
        seen = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("corrupt"), F.count_if(~bad & lost).alias("unkeyed"),
                        F.count_if(good & CH.delete_flag(deleted)).alias("deletes"), F.max(F.when(good, F.col(version))).alias("max_version"),
                        F.count_if(good & ~F.col("_snapshot") & F.col(version).isNull()).alias("unversioned"),
                        F.max(F.when(good & F.col("_snapshot"), F.col(version))).alias("_fence")).first().asDict()
        newest = seen.pop("_fence")
        run |= seen
        if seen["unversioned"]:
            return run | {"status": "FAILED", "error": f"{seen['unversioned']} changelog rows without {version}: mend the export, then run with force=True"}
        payload = [f.name for f in kind.fields if f.name not in (key, version, effective, deleted)]
        merge = CH.apply_scd1 if scd == 1 else CH.apply_scd2
        shaped = lambda df: CH.normalise(df, key, payload, version, deleted, effective)
        if full:
            first, log = shaped(rows.filter(good & F.col("_snapshot"))), shaped(rows.filter(good & ~F.col("_snapshot")))
            run["fence"] = newest if last else None
            changes = first.unionByName(_fenced(log, first if last else None, key, run["fence"]))
            sinks.rebuild_table(merge(None, changes, [key]), target, [key], buckets)
        else:
            sinks.merge_table(shaped(rows.filter(good)), target, [key], buckets, lambda state, new: merge(state, _fenced(new, state, key, fence), [key]))
        if quarantine:
            sinks.append_table(rows.filter(~good).drop("_snapshot"), quarantine)
    finally:
        rows.unpersist()
    return run | {"status": "SUCCESS", "cursor_ts": folders[-1][1]}
