"""Unit tests of window, join, quality and periodic operators on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import joins, periodic, quality as Q, windows


def test_dedup_multiset_split(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "a", 3), (1, "b", 2), (2, "c", 1), (2, "c", 1)],
                               "k int, v string, o int")
    kept, disc = windows.dedup(df, "k", ["o desc"])
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a", 3), (2, "c", 1)]
    assert sorted(tuple(r) for r in disc.collect()) == [(1, "a", 3), (1, "b", 2), (2, "c", 1)]


def test_resolve_version_open_and_closed(spark):
    hist = spark.createDataFrame([
        (1, dt.date(2020, 1, 1), dt.date(2021, 6, 1), "v1"),
        (1, dt.date(2021, 6, 1), None, "v2"),
        (2, dt.date(2020, 1, 1), dt.date(2020, 2, 1), "w1")], "hk int, valid_from date, valid_to date, name string")
    fact = spark.createDataFrame([(1, dt.date(2020, 5, 5)), (1, dt.date(2021, 6, 1)), (1, dt.date(2030, 1, 1)),
                                  (2, dt.date(2020, 3, 1)), (3, dt.date(2020, 1, 1))], "fk int, at date")
    out = joins.resolve_version(fact, hist, ["fk"], ["hk"], "at")
    got = sorted((r.fk, r.at, r.name) for r in out.collect())
    assert got == [(1, dt.date(2020, 5, 5), "v1"), (1, dt.date(2021, 6, 1), "v2"), (1, dt.date(2030, 1, 1), "v2"),
                   (2, dt.date(2020, 3, 1), None), (3, dt.date(2020, 1, 1), None)]


def test_orphans_null_fk_not_orphan(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert [r.fk for r in joins.orphans(child, parent, ["fk"], ["pk"]).collect()] == [2]


def test_quarantine_partition_of_input(spark):
    df = spark.createDataFrame([(1, "A"), (-1, "A"), (2, None), (3, "Z")], "q int, f string")
    rules = [Q.Rule("pos", "warn", "q > 0"), Q.Rule("flag", "quarantine", "f IN ('A')")]
    passed, held = Q.quarantine(df, rules)
    assert passed.count() + held.count() == df.count()
    assert sorted(r.q for r in passed.collect()) == [-1, 1]
    assert {r.q: r.failed_rules for r in held.collect()} == {2: ["flag"], 3: ["flag"]}


def test_reconcile_missing_group_is_a_break(spark):
    s = spark.createDataFrame([("x", 5), ("y", 2)], "g string, rows long")
    t = spark.createDataFrame([("x", 5)], "g string, rows long")
    res = {r.g: r.status for r in Q.reconcile(s, t, ["g"], ["rows"]).collect()}
    assert res == {"x": "MATCH", "y": "BREAK"}


def test_daily_balance_opening_and_gaps(spark):
    mv = spark.createDataFrame([("a", dt.datetime(2023, 12, 30), 5.0), ("a", dt.datetime(2024, 1, 2), 1.0)],
                               "k string, ts timestamp, amt double")
    out = periodic.daily_balance(mv, "k", "ts", "amt", "2024-01-01", "2024-01-03")
    assert [(r.balance_date.day, r.balance) for r in out.orderBy("balance_date").collect()] == [(1, 5.0), (2, 6.0), (3, 6.0)]


def test_watermark_filter_and_projection_reach_the_scan(spark):
    import __spark_entry__ as E
    df = E.queries()["incremental_scan"](spark, "/root/testdata/sf0.001").select("event_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
