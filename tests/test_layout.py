"""Compaction, sketch statistics, type promotion, and small operators that no query states."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import cleanse, control, history, layout, marts
from strata.operators import quality as Q
from strata.operators.changes import START
from strata.sources import ingest, schema
from strata.streaming import streams


def test_bins():
    sizes = [("a", 60), ("b", 50), ("c", 30), ("d", 20), ("e", 1), ("f", 100), ("g", 51)]
    groups = layout.bins(sizes, 100)
    size = dict(sizes)
    assert all(sum(size[p] for p in g) <= 100 and len(g) > 1 for g in groups) and not {"a", "f", "g"} & {p for g in groups for p in g}
    assert layout.bins([("x", 10)], 100) == [] and layout.bins([], 100) == []


def test_compaction_rewrites_small_files_only(spark, tmp_path):
    root = str(tmp_path / "t")
    big = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    big.coalesce(1).write.parquet(root)
    kept = {f: os.path.getmtime(os.path.join(root, f)) for f in os.listdir(root) if f.startswith("part-")}
    small = spark.range(200_000, 200_900).select("id", F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("v"))
    small.unionByName(small.limit(50)).repartition(40).write.mode("append").parquet(root)
    want = layout.digest(spark.read.parquet(root))
    run = layout.compact_folder(spark, root, 1 << 20)
    files = [f for f in os.listdir(root) if f.startswith("part-")]
    assert (run["files_before"], run["files_after"], run["rewritten"]) == (41, len(files), 40) and len(files) <= 3
    assert all(os.path.getmtime(os.path.join(root, f)) == t for f, t in kept.items())
    assert layout.digest(spark.read.parquet(root)) == want and not [f for f in os.listdir(root) if f.startswith("_compact")]
    again = layout.compact_folder(spark, root, 1 << 20)
    assert again["rewritten"] in (0, run["written"])


def test_digest_tells_multisets_apart(spark):
    frame = lambda rows: spark.createDataFrame(rows, "a int, b string").repartition(3)
    base = layout.digest(frame([(1, "x"), (1, "x"), (2, None)]))
    assert base == layout.digest(frame([(2, None), (1, "x"), (1, "x")]))
    assert base != layout.digest(frame([(1, "x"), (2, None), (2, None)])) and base != layout.digest(frame([(1, "x"), (2, None)]))


def test_a_compaction_that_differs_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    spark.range(100).repartition(5).write.parquet(root)
    before = sorted(os.listdir(root))
    seen = iter(range(10))
    monkeypatch.setattr(layout, "digest", lambda df: next(seen))
    with pytest.raises(RuntimeError, match="differ"):
        layout.compact_folder(spark, root, 1 << 20)
    assert sorted(os.listdir(root)) == before


def test_sketches_within_their_bounds(spark):
    df = spark.range(60_000).select((F.col("id") % 40_000).alias("many"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("skewed"),
                                    F.lit(None).cast("int").alias("none"), F.lit("one").alias("one"))
    got = {r.column_name: r for r in layout.sketch_stats(df, ["many", "skewed", "none", "one"]).collect()}
    assert abs(got["many"].distinct_values - 40_000) < 0.06 * 40_000 and abs(got["skewed"].distinct_values - 501) < 0.06 * 501
    assert (got["skewed"].top_value, got["skewed"].top_rows) == ("hot", 20_000) and got["one"].top_rows == 60_000 and got["one"].skew == 1.0
    assert got["none"].non_null == 0 and got["none"].skew is None and got["skewed"].skew > 100
    plan = layout.sketch_stats(df, ["many", "skewed"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def d(p, s):
    return T.DecimalType(p, s)


@pytest.mark.parametrize("a, b, want", [(T.IntegerType(), T.LongType(), T.LongType()), (T.ShortType(), T.IntegerType(), T.IntegerType()), (T.FloatType(), T.DoubleType(), T.DoubleType()),
                                        (T.IntegerType(), T.DoubleType(), T.DoubleType()), (T.LongType(), T.DoubleType(), None), (d(10, 2), d(12, 4), d(12, 4)), (d(10, 0), d(10, 5), d(15, 5)),
                                        (d(38, 0), d(10, 5), None), (T.IntegerType(), d(5, 2), d(12, 2)), (T.DateType(), T.TimestampType(), T.TimestampType()), (T.StringType(), T.IntegerType(), None),
                                        (T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), T.ArrayType(T.LongType())), (T.BooleanType(), T.IntegerType(), None),
                                        (T.MapType(T.StringType(), T.FloatType()), T.MapType(T.StringType(), T.DoubleType()), T.MapType(T.StringType(), T.DoubleType())), (T.NullType(), T.DateType(), T.DateType())])
def test_common_type(a, b, want):
    assert schema.common_type(a, b) == want == schema.common_type(b, a)


def test_evolve_widens_stops_and_coerces(spark):
    old = spark.createDataFrame([(1, 1.5, "x", dt.date(2024, 1, 1), 7)], "Id int, f float, gone string, d date, n int")
    new = spark.createDataFrame([(2**40, Decimal("2.25"), dt.datetime(2024, 1, 2, 3), "late")], "id bigint, n decimal(10,2), d timestamp, added string")
    got = schema.evolve(old, new)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [("Id", "bigint"), ("f", "float"), ("gone", "string"), ("d", "timestamp"), ("n", "decimal(12,2)"), ("added", "string")]
    rows = {r["Id"]: r for r in got.collect()}
    assert rows[1]["n"] == Decimal("7.00") and rows[1]["added"] is None and rows[2**40]["gone"] is None and rows[1]["d"] == dt.datetime(2024, 1, 1)
    narrow = spark.createDataFrame([("a", True)], "id string, f boolean")
    with pytest.raises(schema.IncompatibleTypes, match="Id: int and string; f: float and boolean"):
        schema.evolve(old, narrow)
    assert [r["Id"] for r in schema.evolve(old, narrow, coerce=True).orderBy("Id").collect()] == ["1", "a"]


def test_control_tables(spark):
    """N1 / N2 upserts and RUNNING marks, F6 on an empty log."""
    table = spark.createDataFrame([("a", "SUCCESS", 1), ("b", "FAILED", 2)], "table_name string, status string, n int")
    rows = spark.createDataFrame([("b", "SUCCESS", 3), ("c", "SUCCESS", 4), ("c", "SUCCESS", 4)], "table_name string, status string, n int")
    got = sorted(map(tuple, control.upsert(table, rows, ["table_name"]).collect()))
    assert got == [("a", "SUCCESS", 1), ("b", "SUCCESS", 3), ("c", "SUCCESS", 4)]
    cursor = table.withColumn("last_run_ts", F.lit("2024-01-01").cast("timestamp"))
    marked = {r.table_name: (r.status, str(r.last_run_ts)) for r in control.mark_running(cursor, rows, F.lit("2024-02-02").cast("timestamp")).collect()}
    assert marked == {"a": ("SUCCESS", "2024-01-01 00:00:00"), "b": ("RUNNING", "2024-02-02 00:00:00")}
    runs = spark.createDataFrame([("r1", dt.datetime(2024, 1, 1)), ("r2", dt.datetime(2024, 1, 2))], "run_id string, run_started timestamp")
    assert control.last_run(runs).first().run_id == "r2" and control.last_run(runs.limit(0)).count() == 0


def test_small_operators(spark, tmp_path):
    """What no query states."""
    path = str(tmp_path / "raw")
    spark.range(10).write.parquet(path)
    assert ingest.register_raw(spark, "raw_numbers", path).count() == spark.table("raw_numbers").count() == 10
    m = spark.createDataFrame([("a", "dev"), ("a", "prod"), ("b", "dev")], "table_name string, environment string")
    assert [r.table_name for r in schema.name_collisions(m).collect()] == ["a"]
    now, before = (spark.createDataFrame(x, "table_name string, column_name string") for x in ([("a", "x"), ("a", "y")], [("a", "x")]))
    assert [r.column_name for r in schema.backfill_needed(now, before).collect()] == ["y"]
    lineage = ingest.with_lineage(spark.read.parquet(path), "b7", F.lit("2024-01-01").cast("timestamp"), ["id"]).collect()
    assert len({r._record_hash for r in lineage}) == 10 and all(r._source_file.startswith("file:") and r._batch_id == "b7" for r in lineage)
    clustered = layout.cluster(spark.range(1000).withColumn("k", F.col("id") * 7919 % 1000), ["k"], 4).select("k", F.spark_partition_id().alias("p"))
    spans = sorted((r.a, r.b) for r in clustered.groupBy("p").agg(F.min("k").alias("a"), F.max("k").alias("b")).collect())
    assert len(spans) > 1 and all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))
    measures = marts.Measures().add(marts.Measure("pct", "non")).add(marts.Measure("bal", "semi", time_key="day")).add(marts.Measure("rev", "additive", ("cur",)))
    for by, name in (["day"], "pct"), (["cur"], "bal"), (["day"], "rev"):
        with pytest.raises(ValueError):
            measures.check(by, [name])
    measures.check(["day", "cur"], ["bal", "rev"])
    stream = streams.silver(spark.readStream.schema("id long").parquet(path), lambda df: df.filter("id > 6"))
    q = streams.with_quality(stream, [Q.Rule("small", "reject", "id < 9")]).writeStream.format("memory").queryName("judged").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.id, r.disposition) for r in spark.table("judged").collect()) == [(7, "PASS"), (8, "PASS"), (9, "REJECT")]
    flags = spark.createDataFrame([("a", None), ("b", "0"), ("c", "False"), ("d", "true"), ("e", "1"), ("f", "odd")], "k string, gone string")
    assert sorted(r.k for r in cleanse.active_records(flags, "gone").collect()) == ["a", "b", "c", "f"]
    assert sorted(r.k for r in cleanse.active_records(flags, "gone", null_is_active=False).collect()) == ["b", "c"]
    versions = spark.createDataFrame([("a", 2), ("b", 1), ("a", 1)], f"k string, `{START}` int")
    assert [r[START] for r in history.of_key(versions, "k", "a").collect()] == [1, 2]


def test_load_evidence_tells_loads_apart(spark):
    """The checksum does not depend on order or on doubled deliveries, and separates its parts; every row counts once."""
    kind = "a string, b string, co int, m decimal(19,4), gone boolean, bad boolean"
    rows = [("1", "23", 1, Decimal(5), False, False), ("12", "3", 1, Decimal(5), False, None), ("x", "y", 1, Decimal(1), True, True), ("x", "z", 1, Decimal(1), True, False), (None, "q", 1, Decimal(9), True, True)]
    ev = lambda r: Q.load_evidence(spark.createDataFrame(r, kind).repartition(3), ["a", "b"], "co", "m", F.col("gone"), F.col("bad")).first()
    one, two = ev(rows), ev([*rows[::-1], rows[0]])
    assert (one.delivered, one.unkeyed, one.rejected, one.deleted, one.duplicates, one.kept, one.amount) == (5, 1, 1, 1, 0, 2, Decimal(10))
    assert two.duplicates == 1 and two.kept == 2 and two.checksum == one.checksum
    assert ev([rows[0], rows[0][:1] + ("2",) + rows[0][2:]]).checksum != ev([rows[0], rows[1]]).checksum
