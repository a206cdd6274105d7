"""Unit and property tests of the change-application operators on hand-made rows."""

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strata.operators import changes as CH

SCHEMA = "k string, v string, ver long, ts timestamp, del string"


def t(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def norm(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return CH.normalise(df, "k", ["v"], "ver", "del", "ts")


def rows_of(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_split_null_safe_case_insensitive(spark):
    df = spark.createDataFrame([("a", "x", 1, t(1), None), ("b", "x", 1, t(1), "True"),
                                ("c", "x", 1, t(1), "false"), ("d", "x", 1, t(1), "TRUE")], SCHEMA)
    ups, dels = CH.split(df, "del")
    assert sorted(r.k for r in ups.collect()) == ["a", "c"]
    assert sorted(r.k for r in dels.collect()) == ["b", "d"]


def test_scd1_latest_wins_delete_then_reinsert(spark):
    batch = norm(spark, [("a", "x", 1, t(1), None), ("a", None, 2, t(2), "true"), ("a", "y", 3, t(3), None),
                         ("b", "p", 1, t(1), None), ("b", None, 2, t(2), "true")])
    state = CH.apply_scd1(None, batch, "k")
    assert rows_of(CH.live(state), ["k", "v"]) == [("a", "y")]
    assert rows_of(CH.tombstones(state), ["k"]) == [("b",)]


def test_scd1_late_older_update_does_not_resurrect(spark):
    s1 = CH.apply_scd1(None, norm(spark, [("a", None, 5, t(5), "true")]), "k")
    s2 = CH.apply_scd1(s1, norm(spark, [("a", "old", 3, t(3), None)]), "k")
    assert CH.live(s2).count() == 0


def test_scd1_track_deletes_off(spark):
    batch = norm(spark, [("a", "x", 1, t(1), None), ("a", None, 2, t(2), "true")])
    assert rows_of(CH.live(CH.apply_scd1(None, batch, "k", track_deletes=False)), ["k", "v"]) == [("a", "x")]


def test_scd2_worked_example(spark):
    b1 = norm(spark, [("k", "A", 10, t(1), None), ("k", None, 20, t(4), "true"), ("k", "B", 30, t(6), None)])
    b2 = norm(spark, [("k", "C", 15, t(2), None), ("k", "A", 10, t(1), None)])
    h = CH.history_view(CH.apply_scd2(CH.apply_scd2(None, b1, "k"), b2, "k"))
    got = rows_of(h, ["v", CH.START, CH.END, CH.CURRENT])
    assert got == [("A", t(1), t(2), False), ("B", t(6), None, True), ("C", t(2), t(4), False)]


events = st.lists(st.tuples(st.sampled_from(["a", "b|", None]), st.sampled_from(["x", "|", "\\N", None]),
                            st.integers(1, 30), st.integers(0, 40), st.booleans()), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None)
@given(events, st.integers(0, 12))
def test_scd_batching_order_and_idempotence(spark, evs, cut):
    rows = [(k, v, ver, t(h), "true" if d else None) for k, v, ver, h, d in evs]
    # versions are unique per key in a real feed
    seen, uniq = set(), []
    for r in rows:
        if (r[0], r[2]) not in seen:
            seen.add((r[0], r[2]))
            uniq.append(r)
    a, b = uniq[:cut], uniq[cut:]
    full1 = CH.live(CH.apply_scd1(None, norm(spark, uniq), "k"))
    assert {r.k for r in CH.apply_scd1(None, norm(spark, uniq), "k").collect()} == {r[0] for r in uniq if r[0] is not None}
    cols1 = ["k", "v", CH.VERSION]
    if a and b:
        inc = CH.apply_scd1(CH.apply_scd1(None, norm(spark, b), "k"), norm(spark, a), "k")
        assert rows_of(CH.live(inc), cols1) == rows_of(full1, cols1)
        h = CH.apply_scd2(CH.apply_scd2(None, norm(spark, b), "k"), norm(spark, a + a), "k")
        hfull = CH.apply_scd2(None, norm(spark, uniq), "k")
        cols2 = ["k", "v", CH.VERSION, CH.START, CH.END, CH.CURRENT]
        assert rows_of(CH.history_view(h), cols2) == rows_of(CH.history_view(hfull), cols2)
    again = CH.apply_scd1(CH.apply_scd1(None, norm(spark, uniq), "k"), norm(spark, uniq), "k")
    assert rows_of(CH.live(again), cols1) == rows_of(full1, cols1)
    hv = CH.history_view(CH.apply_scd2(None, norm(spark, uniq), "k"))
    cur = hv.groupBy("k").agg(F.sum(F.col(CH.CURRENT).cast("int")).alias("c")).collect()
    assert all(r.c <= 1 for r in cur)


def test_diff_and_change_feed(spark):
    before = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, v string")
    after = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4")], "k string, v string")
    d = {r.k: r.op for r in CH.diff_snapshots(before, after, "k", ["v"]).collect()}
    assert d == {"b": "update", "c": "delete", "d": "insert"}
    feed = sorted((r.k, r._change_type, r.v) for r in CH.change_feed(before, after, "k", ["v"]).collect())
    assert feed == [("b", "update_postimage", "9"), ("b", "update_preimage", "2"), ("c", "delete", "3"),
                    ("d", "insert", "4")]


def test_row_hash_and_keys_tell_parts_apart(spark):
    from strata.functions.keys import row_hash, sha_key
    rows = [("a|b", "c"), ("a", "b|c"), ("a|", ""), ("a", "|"), ("\\N", "x"), (None, "x"), ("\\", "|x"), ("\\|", "x"), ("a\\", "b"), ("a", "\\b")]
    df = spark.createDataFrame(rows, "a string, b string").select(row_hash("a", "b").alias("h"), sha_key("a", "b").alias("k"))
    got = df.collect()
    assert len({r.h for r in got}) == len(rows) and len({r.k for r in got}) == len(rows)


def test_null_keys_go_to_quarantine_and_never_multiply(spark):
    batch = norm(spark, [("a", "x", 1, t(1), None), (None, "n", 1, t(1), None), (None, "m", 2, t(2), None)])
    keyed, lost = CH.split_null_keys(batch, "k")
    assert keyed.count() == 1 and sorted(r.v for r in lost.collect()) == ["m", "n"]
    for apply in (CH.apply_scd1, CH.apply_scd2):
        state = None
        for _ in range(3):
            state = apply(state, batch, "k")
            assert [r.k for r in state.collect()] == ["a"]


def test_scd2_of_a_hot_key_over_many_ranges(spark, monkeypatch):
    """One key holds a third of the rows and spans several version ranges; late effective times and deletes among them."""
    import random
    monkeypatch.setattr(CH, "HOT_ROWS", 60)
    monkeypatch.setattr(CH, "RANGES", 12)
    r = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"k{i % 40}", f"v{r.randint(0, 9)}", i * 7000, t(r.randint(0, 300)), "true" if r.random() < 0.1 else None) for i in range(300)]
    half = r.sample(rows, 150)
    state = CH.apply_scd2(CH.apply_scd2(None, norm(spark, half), "k"), norm(spark, [x for x in rows if x not in half]), "k")
    want = []
    for k in {x[0] for x in rows}:
        own, high, starts = sorted((x for x in rows if x[0] == k), key=lambda x: x[2]), None, []
        for x in own:
            high = x[3] if high is None else max(high, x[3])
            starts.append(high)
        want += [(k, x[2], s, e) for x, s, e in zip(own, starts, [*starts[1:], None])]
    got = [tuple(x) for x in state.select("k", CH.VERSION, CH.START, CH.END).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    ranges = {tuple(x) for x in CH._ranged(norm(spark, rows), ["k"]).select("k", "_range").distinct().collect()}
    assert len([x for x in ranges if x[0] == "hot"]) > 4 and {x[1] for x in ranges if x[0] != "hot"} == {0}


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "decimal(20,3)", "string", "date"])
def test_scd2_ranges_of_every_version_type(spark, monkeypatch, kind):
    """A key with a third of 300,000 events is cut into many small ranges, and its intervals are those of one ordered pass."""
    monkeypatch.setattr(CH, "HOT_ROWS", 20_000)
    days = kind == "date"       # a type with few values: many events of a version are one
    n = F.col("id") * 7919 % 300_007
    version = {"bigint": n, "timestamp": (n * 0.001).cast("timestamp"), "decimal(20,3)": (n / 8).cast(kind), "string": F.lpad(n.cast("string"), 8, "0"),
               "date": F.date_add(F.lit("2000-01-01").cast("date"), (n % 3000).cast("int"))}[kind]
    ev = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("k"),
                                     (F.col("id") % 11).cast("string").alias("v"), version.alias("ver"),
                                     F.timestamp_seconds((F.xxhash64("id") % 1_000_000) + 1_700_000_000).alias("ts"), (F.col("id") % 97 == 0).alias("del"))
    changes = CH.normalise(ev, "k", ["v"], "ver", "del", "ts").repartition(4)
    sizes = CH._ranged(changes, ["k"]).filter("k = 'hot'").groupBy("_range").count().collect()
    assert len(sizes) > 100 and max(r["count"] for r in sizes) < 5000
    got = CH.apply_scd2(None, changes, "k").filter("k IN ('hot', 'k1', 'k4999')").select("k", CH.VERSION, CH.EFFECTIVE, CH.START, CH.END).toPandas()
    raw = changes.filter("k IN ('hot', 'k1', 'k4999')").select("k", CH.VERSION, CH.EFFECTIVE).toPandas()
    want = raw.groupby(["k", CH.VERSION], as_index=False)[CH.EFFECTIVE].max().sort_values(["k", CH.VERSION])
    want[CH.START] = want.groupby("k")[CH.EFFECTIVE].cummax()
    want[CH.END] = want.groupby("k")[CH.START].shift(-1)
    got = got.sort_values(["k", CH.VERSION]).reset_index(drop=True)
    assert len(got) == len(want) and (len(got) < 4000) == days
    assert got.equals(want.reset_index(drop=True).astype(got.dtypes))


def test_asof_join_on_timestamps(spark):
    """Bounds inside a day, a version within one day, empty versions, an open one, and facts on every bound."""
    from strata.operators import joins
    d = dt.datetime
    h = [("a", 1, d(2019, 6, 1), d(2020, 1, 1, 12)), ("a", 2, d(2020, 1, 1, 12), d(2020, 1, 1, 15)), ("a", 3, d(2020, 1, 1, 15), d(2020, 1, 1, 15)),
         ("a", 4, d(2020, 1, 1, 15), None), ("b", 5, d(2020, 1, 1), d(2020, 2, 1))]
    facts = [(i, k, at) for i, (k, at) in enumerate([("a", d(2019, 5, 31, 23, 59)), ("a", d(2019, 6, 1)), ("a", d(2020, 1, 1, 6)), ("a", d(2020, 1, 1, 12)), ("a", d(2020, 1, 1, 14, 59)),
                                                     ("a", d(2020, 1, 1, 15)), ("a", d(2030, 1, 1)), ("b", d(2020, 1, 31, 23)), ("b", d(2020, 2, 1)), ("c", d(2020, 1, 1))])]
    want = [None, 1, 1, 2, 2, 4, 4, 5, None, None]
    for unit in ("day", "month", "year"):
        out = joins.resolve_version(spark.createDataFrame(facts, "i int, k string, at timestamp"), spark.createDataFrame(h, "hk string, n int, f timestamp, e timestamp"),
                                    ["k"], ["hk"], at="at", start="f", end="e", unit=unit)
        assert [r.n for r in out.orderBy("i").collect()] == want


def test_dedup_gives_back_every_copy(spark):
    from strata.operators import windows
    rows = [(1, "a")] * 2500 + [(1, "b"), (2, "c")]
    kept, lost = windows.dedup(spark.createDataFrame(rows, "k int, v string"), ["k"], ["v"])
    assert sorted(map(tuple, kept.collect())) == [(1, "a"), (2, "c")]
    assert sorted(map(tuple, lost.collect())) == [(1, "a")] * 2499 + [(1, "b")]
