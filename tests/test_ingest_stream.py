"""Manifest + positional CSV landing, ingest of a table, sinks, schema drift and streaming (restart)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import changes as CH
from strata.operators import control
from strata.operators import quality as Q
from strata.sources import ingest, quality_log, schema, sinks
from strata.streaming import streams


def write_manifest(path):
    m = {"entities": [
        {"name": "  Account ", "attributes": [
            {"name": "accountid", "dataType": "guid"},
            {"name": "name", "dataType": "string"},
            {"name": "revenue", "dataType": "decimal", "traits": {"precision": 19, "scale": 2}},
            {"name": "employees", "dataType": "int32"},
            {"name": "mystery", "dataType": "hologram"}]},
        {"name": None, "attributes": [{"name": "x", "dataType": "string"}]}]}
    with open(path, "w") as f:
        json.dump(m, f)


def test_manifest_schema_and_system_columns(spark, tmp_path):
    p = str(tmp_path / "model.json")
    write_manifest(p)
    cols = schema.manifest_columns(spark, p)
    rows = {r.column_name: r.spark_type for r in cols.filter("table_name = 'account'").collect()}
    assert rows["revenue"] == "decimal(19,2)" and rows["employees"] == "int" and rows["mystery"] == "string"
    assert {"versionnumber", "modifiedon", "createdon", "IsDelete"} <= set(rows)
    st = schema.struct_of(cols, "account")
    assert [f.name for f in st.fields][:5] == ["accountid", "name", "revenue", "employees", "mystery"]
    key = schema.resolve_key(cols).collect()[0]
    assert key.key_column == "accountid"


def test_positional_csv_quotes_short_rows_bad_numbers(spark, tmp_path):
    folder = tmp_path / "account" / "Changelog" / "2024-01-02T06-00-00"
    folder.mkdir(parents=True)
    (folder / "part.csv").write_text('a1,"Acme, ""Inc""\nline two",12.50,7\n'
                                     'a2,Beta,notanumber,3\n'
                                     'a3,Short\n')
    st = T.StructType([T.StructField("accountid", T.StringType()), T.StructField("name", T.StringType()),
                       T.StructField("revenue", T.DecimalType(19, 2)), T.StructField("employees", T.IntegerType())])
    df = ingest.read_positional_csv(spark, str(tmp_path / "account" / "Changelog" / "*"), st)
    rows = {r.accountid: r for r in df.collect()}
    assert rows["a1"].name == 'Acme, "Inc"\nline two' and float(rows["a1"].revenue) == 12.5
    assert rows["a2"].revenue is None and rows["a2"].employees == 3
    assert rows["a3"].revenue is None
    assert str(rows["a1"].folder_ts) == "2024-01-02 06:00:00"
    empty = ingest.read_positional_csv(spark, [], st)
    assert empty.count() == 0 and empty.columns == [*st.names, "_corrupt_record"]


def test_surplus_fields_and_times(spark, tmp_path):
    folder = tmp_path / "t" / "2024-01-02T06-00-00"
    folder.mkdir(parents=True)
    (folder / "part.csv").write_text('a1,n1,12:30:00,EXTRA\na2,n2,2024-05-06 07:08:09\na3\na4,n4,,\na5,n5,08:15,x,y\n')
    st = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("at", T.TimestampNTZType())])
    good, corrupt = ingest.split_corrupt(ingest.read_positional_csv(spark, str(tmp_path / "t" / "*"), st))
    assert {r["id"]: (r["name"], r["at"] and str(r["at"])) for r in good.collect()} == {
        "a2": ("n2", "2024-05-06 07:08:09"), "a3": (None, None), "a4": ("n4", None)}
    assert {r["id"]: (str(r["at"]), r["_corrupt_record"]) for r in corrupt.collect()} == {
        "a1": ("1970-01-01 12:30:00", "a1,n1,12:30:00,EXTRA"), "a5": ("1970-01-01 08:15:00", "a5,n5,08:15,x,y")}


def test_manifest_with_precision_alone(spark, tmp_path):
    p = str(tmp_path / "model.json")
    with open(p, "w") as f:
        json.dump({"entities": [{"name": "T", "attributes": [{"name": "tid", "dataType": "guid"}, {"name": "d", "dataType": "decimal", "traits": {"precision": 12}}]}]}, f)
    assert {r.column_name: r.spark_type for r in schema.manifest_columns(spark, p).collect()}["d"] == "decimal(12,0)"


def files_by_folder(root):
    return {f: sorted(os.listdir(os.path.join(root, f))) for f in os.listdir(root) if f.startswith("_bucket=")}


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "tbl")
    change = "k long, v string, ver long, gone boolean, at timestamp"
    rows = CH.normalise(spark.createDataFrame([(i, "a", 1, False, None) for i in range(200)], change), "k", ["v"], "ver", "gone", "at")
    merge = lambda state, changes: CH.apply_scd1(state, changes, ["k"])
    sinks.merge_table(rows, root, ["k"], 8, merge)
    before = files_by_folder(root)
    one = CH.normalise(spark.createDataFrame([(7, "b", 2, False, None)], change), "k", ["v"], "ver", "gone", "at")
    for _ in range(2):      # a retry changes nothing
        sinks.merge_table(one, root, ["k"], 8, merge)
    after = files_by_folder(root)
    assert len(before) == 8 and sum(before[f] != after[f] for f in before) == 1
    got = {r["k"]: r["v"] for r in sinks.read_table(spark, root).collect()}
    assert got == {i: "b" if i == 7 else "a" for i in range(200)}


def test_plain_writers(spark, tmp_path):
    root = str(tmp_path / "plain")
    sinks.ensure_table(spark, root, "k int, v string")
    sinks.append_table(spark.createDataFrame([(1, "a")], "k int, v string"), root)
    first = set(os.listdir(root))
    sinks.append_table(spark.createDataFrame([(2, "b")], "k int, v string"), root)
    sinks.ensure_table(spark, root, "k int, v string")
    assert first < set(os.listdir(root)) and sinks.read_table(spark, root).count() == 2
    sinks.replace_table(spark.createDataFrame([(3, 1.5)], "k int, w double"), root)
    assert [tuple(r) for r in sinks.read_table(spark, root).collect()] == [(3, 1.5)]


def export(root, table, kind, stamp, lines):
    folder = root / table / kind / stamp
    folder.mkdir(parents=True)
    (folder / "part.csv").write_text("\n".join(lines) + "\n")


def test_ingest_table(spark, tmp_path):
    """Two snapshots, an older changelog, delete then re-insert, a quoted newline, a corrupt row, a keyless row, a retry."""
    from strata.sources import pipeline
    manifest = str(tmp_path / "model.json")
    with open(manifest, "w") as f:
        json.dump({"entities": [{"name": "account", "attributes": [
            {"name": "accountid", "dataType": "string"}, {"name": "name", "dataType": "string"}, {"name": "versionnumber", "dataType": "int64"},
            {"name": "modifiedon", "dataType": "dateTime"}, {"name": "IsDelete", "dataType": "boolean"}]}]}, f)
    base, out = tmp_path / "export", str(tmp_path / "account")
    row = lambda k, n, v, d="": f"{k},{n},{v},2024-01-0{v} 00:00:00,{d}"
    export(base, "account", "Snapshot", "2024-01-01T00-00-00", [row("a", '"One\nline"', 1), row("b", "Two", 1), row("", "Nobody", 1), row("x", "y", 1) + ",2024-01-01,SURPLUS"])
    export(base, "account", "Changelog", "2023-12-31T00-00-00", [row("b", "Older", 0)])
    export(base, "account", "Changelog", "2024-01-02T00-00-00", [row("b", "Two", 2, "true"), row("c", "Three", 2)])
    columns = schema.manifest_columns(spark, manifest)
    first = pipeline.ingest_table(spark, str(base), "account", columns, out)
    assert (first["status"], first["rows"], first["corrupt"], first["unkeyed"], first["deletes"], first["max_version"]) == ("SUCCESS", 7, 1, 1, 1, 2)
    live = lambda: {r["accountid"]: r["name"] for r in CH.live(sinks.read_table(spark, out)).collect()}
    assert live() == {"a": "One\nline", "c": "Three"}
    again = pipeline.ingest_table(spark, str(base), "account", columns, out, cursor_ts=None)      # a retry from the start
    assert again == first and live() == {"a": "One\nline", "c": "Three"}
    assert pipeline.ingest_table(spark, str(base), "account", columns, out, cursor_ts=first["cursor_ts"])["status"] == "NO_NEW_DATA"
    export(base, "account", "Snapshot", "2024-01-03T00-00-00", [row("b", "Back", 3), row("c", "Three", 2)])
    third = pipeline.ingest_table(spark, str(base), "account", columns, out, cursor_ts=first["cursor_ts"])
    assert (third["rows"], third["max_version"]) == (2, 3) and live() == {"a": "One\nline", "b": "Back", "c": "Three"}


ACCOUNT = {"entities": [{"name": "account", "attributes": [
    {"name": "accountid", "dataType": "string"}, {"name": "name", "dataType": "string"}, {"name": "versionnumber", "dataType": "int64"},
    {"name": "modifiedon", "dataType": "dateTime"}, {"name": "IsDelete", "dataType": "boolean"}]}]}


def account(tmp_path, spark):
    """(export folder, manifest columns, a line of the export)"""
    manifest = str(tmp_path / "model.json")
    with open(manifest, "w") as f:
        json.dump(ACCOUNT, f)
    return tmp_path / "export", schema.manifest_columns(spark, manifest), lambda k, n, v, d="": f"{k},{n},{v},2024-01-01 00:00:{v or 0},{d}"


def test_newest_snapshot_replaces(spark, tmp_path):
    """Two snapshots, a vanished key, old changes of it, a later change of another one; a forced run equals a rebuild in an empty place."""
    from strata.sources import pipeline
    base, columns, row = account(tmp_path, spark)
    out = str(tmp_path / "account")
    live = lambda path: {r["accountid"]: r["name"] for r in CH.live(sinks.read_table(spark, path)).collect()}
    export(base, "account", "Snapshot", "2024-01-01T00-00-00", [row("a", "A1", 11), row("b", "B1", 12), row("c", "C1", 13)])
    first = pipeline.ingest_table(spark, str(base), "account", columns, out)
    assert first["mode"] == "full" and first["fence"] == 13 and live(out) == {"a": "A1", "b": "B1", "c": "C1"}
    export(base, "account", "Changelog", "2024-01-02T00-00-00", [row("b", "B2", 14), row("c", "C2", 15), row("e", "E1", 16)])
    second = pipeline.ingest_table(spark, str(base), "account", columns, out, cursor_ts=first["cursor_ts"], fence=first["fence"])
    assert second["mode"] == "incremental" and live(out) == {"a": "A1", "b": "B2", "c": "C2", "e": "E1"}
    # the newer snapshot lacks b and c; c comes back later, and an old change of b is delivered once more
    export(base, "account", "Snapshot", "2024-01-03T00-00-00", [row("a", "A3", 21), row("e", "E2", 22)])
    export(base, "account", "Changelog", "2024-01-04T00-00-00", [row("c", "C3", 23), row("b", "B2", 14), row("a", "A2", 20)])
    forced = pipeline.ingest_table(spark, str(base), "account", columns, out, cursor_ts=second["cursor_ts"], force=True)
    assert (forced["folders"], forced["rows"], forced["fence"]) == (4 - 1, 8, 22)
    want = {"a": "A3", "c": "C3", "e": "E2"}
    assert live(out) == want
    anew = str(tmp_path / "anew")
    assert pipeline.ingest_table(spark, str(base), "account", columns, anew) == forced and live(anew) == want
    # an old change in a new folder does not bring back b; a new one does; buckets of vanished keys are gone
    export(base, "account", "Changelog", "2024-01-05T00-00-00", [row("b", "B9", 19), row("e", "E1", 16)])
    third = pipeline.ingest_table(spark, str(base), "account", columns, out, cursor_ts=forced["cursor_ts"], fence=forced["fence"])
    assert live(out) == want
    export(base, "account", "Changelog", "2024-01-06T00-00-00", [row("b", "B10", 30)])
    pipeline.ingest_table(spark, str(base), "account", columns, out, cursor_ts=third["cursor_ts"], fence=third["fence"])
    assert live(out) == want | {"b": "B10"}
    # A table whose cursor is dropped starts anew
    cursor = spark.createDataFrame([("account", "SUCCESS"), ("other", "SUCCESS")], "table_name string, status string")
    assert [r.table_name for r in control.reset_table(cursor, "account").collect()] == ["other"]
    history = str(tmp_path / "history")
    pipeline.ingest_table(spark, str(base), "account", columns, history, scd=2)
    versions = sorted((r["accountid"], r["name"]) for r in CH.history_view(sinks.read_table(spark, history)).filter(F.col(CH.CURRENT)).collect())
    assert versions == sorted((want | {"b": "B10"}).items())


def test_changelog_without_versions_fails_the_run(spark, tmp_path):
    """Nothing is written, the cursor stays; the forced run after the export is mended goes through."""
    from strata.sources import pipeline
    base, columns, row = account(tmp_path, spark)
    out = str(tmp_path / "account")
    export(base, "account", "Snapshot", "2024-01-01T00-00-00", [row("a", "A1", 1)])
    first = pipeline.ingest_table(spark, str(base), "account", columns, out)
    export(base, "account", "Changelog", "2024-01-02T00-00-00", [row("a", "A2", ""), row("b", "B2", 2)])
    run = pipeline.ingest_table(spark, str(base), "account", columns, out, cursor_ts=first["cursor_ts"], fence=first["fence"])
    assert (run["status"], run["unversioned"], run["cursor_ts"]) == ("FAILED", 1, first["cursor_ts"]) and "versionnumber" in run["error"]
    assert sinks.read_table(spark, out).count() == 1
    r = ingest.require_version(spark.createDataFrame([(1, None)], "k int, v int"), "v").first()
    assert (r["has_column"], r["null_versions"], r["ok"]) == (True, 1, False)
    assert not ingest.require_version(spark.createDataFrame([(1,)], "k int"), "v").first()["ok"]


def test_merge_into_an_ensured_table(spark, tmp_path):
    root, merge = str(tmp_path / "made"), lambda state, changes: CH.apply_scd1(state, changes, ["k"])
    rows = CH.normalise(spark.createDataFrame([(i, "a", 1, False, None) for i in range(50)], "k long, v string, ver long, gone boolean, at timestamp"), "k", ["v"], "ver", "gone", "at")
    sinks.ensure_table(spark, root, rows.schema, keyed=True)
    assert sinks.read_table(spark, root).count() == 0
    for _ in range(2):
        sinks.merge_table(rows, root, ["k"], 4, merge)
        assert sorted(r["k"] for r in sinks.read_table(spark, root).collect()) == list(range(50))
    plain = str(tmp_path / "plain")
    sinks.ensure_table(spark, plain, rows.schema)
    with pytest.raises(ValueError, match="keyed"):
        sinks.merge_table(rows, plain, ["k"], 4, merge)


def test_schema_drift_classes(spark):
    prev = spark.createDataFrame([("t", "a", "int"), ("t", "b", "string"), ("t", "c", "double"), ("old", "x", "int")],
                                 "table_name string, column_name string, data_type string")
    cur = spark.createDataFrame([("t", "a", "bigint"), ("t", "c", "int"), ("t", "d", "string"), ("new", "y", "int")],
                                "table_name string, column_name string, data_type string")
    d = schema.classify_drift(schema.drift(prev, cur), prev, cur)
    got = {(r.table_name, r.column): r.drift_class for r in d.collect()}
    assert got[("t", "a")] == "widening" and got[("t", "c")] == "breaking_type"
    assert got[("t", "d")] == "additive" and got[("t", "b")] == "column_gone"
    old = spark.createDataFrame([("t", "w", "decimal(10,2)"), ("t", "n", "decimal(19,4)"), ("t", "s", "decimal(10,2)")], prev.schema)
    new = spark.createDataFrame([("t", "w", "decimal(19,4)"), ("t", "n", "decimal(10,2)"), ("t", "s", "decimal(10,6)")], prev.schema)
    decimals = {r.column: r.drift_class for r in schema.classify_drift(schema.drift(old, new), old, new).collect()}
    assert decimals == {"w": "widening", "n": "breaking_type", "s": "breaking_type"}
    assert got[("new", None)] == "new_table" and got[("old", None)] == "missing_table"


def test_stream_apply_changes_restart_equals_batch(spark, tmp_path, tables):
    src = str(tmp_path / "src")
    ev = tables.events.select("user_id", "event_type", "value", "event_id", "ts",
                              (F.col("event_type") == "error").alias("is_delete"))
    ev.filter("ts < '2024-01-16'").write.parquet(f"{src}/part=1")
    root, ckpt = str(tmp_path / "state"), str(tmp_path / "ckpt")
    sch = ev.schema

    def run_once():
        s = streams.read_changes(spark, src + "/*", sch)
        norm = CH.normalise(s, "user_id", ["event_type", "value"], "event_id", "is_delete", "ts")
        q = (norm.writeStream.foreachBatch(streams.apply_changes(root, ["user_id"]))
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()

    run_once()
    ev.filter("ts >= '2024-01-16'").write.parquet(f"{src}/part=2")
    run_once()  # restart from the checkpoint: only the new files are read
    got = CH.live(sinks.read_table(spark, root)).select("user_id", "event_type", "value", CH.VERSION)
    batch = CH.live(CH.apply_scd1(None, CH.normalise(ev, "user_id", ["event_type", "value"], "event_id",
                                                     "is_delete", "ts"), "user_id"))
    exp = batch.select("user_id", "event_type", "value", CH.VERSION)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_stream_dedup_and_lag(spark, tmp_path, tables):
    src = str(tmp_path / "ev")
    tables.events.write.parquet(src)
    s = spark.readStream.schema(tables.events.schema).parquet(src)
    s2 = s.unionByName(s)  # every event delivered twice
    q = (streams.dedup(s2, ["event_id"], "ts", "1 hour").writeStream.format("memory").queryName("dedup_out")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("SELECT count(*) AS n FROM dedup_out").collect()[0].n == tables.events.count()
    q = (streams.lag(s, "ts", "1 day", "1 hour").writeStream.format("memory").queryName("lag_out")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    total = spark.sql("SELECT sum(events) AS n FROM lag_out").collect()[0].n
    # the last window stays open under the watermark; every emitted window is complete
    assert total is not None and total <= tables.events.count()


RULES = [Q.Rule("has_value", "warn", "v is not null"), Q.Rule("positive", "quarantine", "v is null or v > 0"), Q.Rule("known", "reject", "k is not null")]


def test_split_in_one_pass(spark, tmp_path):
    """Rows and log of a batch and of a stream are the same; a repeated run replaces; one scan."""
    rows = [("a", 1), ("b", None), ("c", -1), (None, 2), (None, -2), ("d", 5)]
    src = str(tmp_path / "src")
    for part in (rows[:3], rows[3:]):
        spark.createDataFrame(part, "k string, v int").coalesce(1).write.mode("append").parquet(src)
    df = spark.read.parquet(src)
    batch, stream, log = str(tmp_path / "batch"), str(tmp_path / "stream"), str(tmp_path / "log")
    reads = spark.sparkContext.accumulator(0)

    def counted(parts):
        for p in parts:
            reads.add(p.num_rows)
            yield p
    for _ in range(2):
        got = quality_log.split_write(df.mapInArrow(counted, df.schema), RULES, batch, log, "batch")
        assert got == {"PASS": 2, "WARNING": 1, "QUARANTINE": 1, "REJECT": 2}
    assert reads.value == 2 * len(rows)     # once a run
    q = (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src).writeStream.foreachBatch(quality_log.split_stream(RULES, stream, log, "stream"))
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    one, two = (sorted(((r.k, r.v, tuple(r.failed_rules), r.disposition) for r in quality_log.read_split(spark, p).collect()), key=str) for p in (batch, stream))
    assert one == two and [x[:2] for x in one if x[3] == "REJECT"] == [(None, -2), (None, 2)]
    held = quality_log.read_split(spark, batch, held=True)
    assert held.count() == 3 and quality_log.read_split(spark, batch, held=False).count() == 3
    entries = spark.read.parquet(log)
    sums = {run: {(r.kind, r.name): (r.failed, r.passed) for r in entries.filter(F.col("run_id") == run).groupBy("kind", "name").agg(F.sum("failed").alias("failed"), F.sum("passed").alias("passed")).collect()}
            for run in ("batch", "stream")}
    assert sums["batch"] == sums["stream"] and sums["batch"]["rule", "known"] == (2, 4) and sums["batch"]["disposition", "REJECT"] == (2, 0)
    assert entries.filter("run_id = 'stream'").select("epoch").distinct().count() == 2


def test_version_guard_with_expiry_and_restart(spark, tmp_path):
    """Older and repeated versions are dropped across a restart; a key's state ends behind the watermark."""
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    kind = "k string, version long, ts timestamp, v string"
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)

    def send(rows):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(src)

    def run_once():
        s = spark.readStream.schema(kind).parquet(src)
        q = (streams.version_guard(s, ["k"], "version", "ts", "1 hour", "24 hours").writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted((r.k, r.version, r.v) for r in spark.read.schema(kind).parquet(out).collect())

    send([("a", 2, at(0), "a2"), ("a", 1, at(0), "a1"), ("a", 2, at(0), "a2"), ("b", 5, at(0), "b5"), ("c", None, at(0), "lost")])
    first = run_once()
    assert first == [("a", 1, "a1"), ("a", 2, "a2"), ("b", 5, "b5")]
    send([("a", 2, at(1), "again"), ("a", 3, at(1), "a3"), ("b", 4, at(1), "late")])
    assert run_once() == sorted([*first, ("a", 3, "a3")])       # from the checkpoint
    send([("z", 1, at(60), "far ahead")])                       # the watermark passes the others' last event by more than a day
    run_once()
    send([("b", 4, at(61), "anew"), ("z", 1, at(61), "again")])
    assert run_once() == sorted([*first, ("a", 3, "a3"), ("z", 1, "far ahead"), ("b", 4, "anew")])
