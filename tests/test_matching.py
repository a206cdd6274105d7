"""Allocation, reversal pairing, bitemporal segments and restatement on hand-made rows."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import matching as MT
from strata.operators import periodic as PD
from strata.sources import sinks

D = Decimal


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def allocated(spark, rows, scale=2):
    df = spark.createDataFrame([(h, i, D(w), D(t)) for h, i, w, t in rows], "h string, i int, w decimal(19,4), t decimal(19,4)").repartition(3)
    out = MT.allocate(df, ["h"], ["i"], "w", "t", "share", scale)
    assert out.columns == ["h", "i", "w", "t", "share"]
    return {(r.h, r.i): r.share for r in out.collect()}


def test_allocation_adds_up(spark):
    rows = [("thirds", i, "1", "100.00") for i in range(3)] + [("note", i, "1", "-100.00") for i in range(3)] + [("none", 0, "5", "0"), ("none", 1, "7", "0")]
    rows += [("zero", 0, "0", "1.00"), ("zero", 1, "0", "1.00"), ("zero", 2, "0", "1.00"), ("one", 9, "12.5", "7.77"), ("mixed", 0, "30", "10.01"), ("mixed", 1, "-10", "10.01"), ("cancel", 0, "5", "3.00"), ("cancel", 1, "-5", "3.00")]
    got = allocated(spark, rows)
    assert [got["thirds", i] for i in range(3)] == [D("33.34"), D("33.33"), D("33.33")]
    assert sorted(got["note", i] for i in range(3)) == [D("-33.34"), D("-33.33"), D("-33.33")]
    assert got["none", 0] == got["none", 1] == 0 and got["one", 9] == D("7.77")
    assert [got["zero", i] for i in range(3)] == [D("0.34"), D("0.33"), D("0.33")] and got["mixed", 0] + got["mixed", 1] == D("10.01")
    assert got["cancel", 0] + got["cancel", 1] == D("3.00")


def test_allocation_of_many_lines(spark):
    """One header holds a third of the lines, all shares alike; the others are random.  Sums agree to the digit, and no share is off by one."""
    r = random.Random(4)
    rows = [("hot", i, "1", "1234.5671") for i in range(2000)] + [(f"h{i % 300}", i, str(r.randint(1, 9999)), str(D((i % 300) * 7919 % 1000) / 100)) for i in range(4000)]
    got = allocated(spark, rows, 4)
    total, weight = {}, {}
    for h, _, w, t in rows:
        total[h] = D(t)
        weight[h] = weight.get(h, 0) + D(w)
    for h in total:
        assert sum(v for (k, _), v in got.items() if k == h) == total[h]
    for h, i, w, t in rows:
        assert abs(got[h, i] - D(t) * D(w) / weight[h]) < D("0.0001")


def plain_pairs(rows):
    """First-to-first matching by hand."""
    out = {}
    for k in {r[0] for r in rows}:
        sold = [[d, i, q] for kk, d, i, q, back in sorted(rows) if kk == k and not back]
        for _, d, i, q, back in sorted(r for r in rows if r[0] == k and r[4]):
            while q and sold:
                x = min(q, sold[0][2])
                out[k, sold[0][1], i] = out.get((k, sold[0][1], i), 0) + x
                q -= x
                sold[0][2] -= x
                if not sold[0][2]:
                    sold.pop(0)
            if q:
                out[k, None, i] = q
        out |= {(k, i, None): q for _, i, q in sold}
    return out


@pytest.mark.parametrize("step", [1, 7, 100_000])
def test_reversals(spark, step):
    """Partial and repeated reversals, a key without originals, one without reversals, a hot key over many days."""
    r = random.Random(step)
    rows = [("a", day(1), 1, 10, False), ("a", day(2), 2, 5, False), ("a", day(3), 3, 4, True), ("a", day(4), 4, 8, True), ("b", day(1), 5, 3, True), ("c", day(1), 6, 3, False)]
    rows += [("hot" if i % 3 == 0 else f"k{i % 9}", day(r.randint(0, 20)), i, r.randint(1, 30), r.random() < 0.4) for i in range(100, 400)]
    df = spark.createDataFrame([(k, d, i, D(q), b) for k, d, i, q, b in rows], "k string, d date, i int, q decimal(19,4), back boolean").repartition(4)
    out = MT.pair_reversals(df.filter("not back"), df.filter("back"), ["k"], ["d", "i"], "d", "q", step)
    got = out.collect()
    assert {(x.k, x.o_i, x.r_i): int(x.matched) for x in got} == plain_pairs(rows) and len(got) == len(plain_pairs(rows))
    assert all(x.is_matched == (x.o_i is not None and x.r_i is not None) for x in got)
    net = {k: sum(q if not b else -q for kk, _, _, q, b in rows if kk == k) for k in {x[0] for x in rows}}
    rest = {}
    for x in got:
        if not x.is_matched:
            rest[x.k] = rest.get(x.k, 0) + int(x.matched) * (1 if x.r_i is None else -1)
    assert rest == {k: v for k, v in net.items() if v or k in rest}


def test_running_total_without_order_inside_the_key_task(spark):
    rows = [(None if i % 5 == 0 else "k", i // 10, i, i % 7) for i in range(200)]
    out = MT.running_total(spark.createDataFrame(rows, "k string, p int, i int, a long").repartition(5), ["k"], F.col("p"), ["p", "i"], "a", "before")
    for r in out.collect():
        assert r.before == sum(a for k, _, i, a in rows if k == r.k and i < r.i)


def test_bitemporal_segments(spark):
    """Corrections that cut, cover and reach past earlier statements; as known on every day."""
    r = random.Random(7)
    rows = [("x", i, day(a := r.randint(0, 60)), None if r.random() < 0.2 else day(a + r.randint(1, 90)), dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randint(0, 40)), f"v{i}") for i in range(25)]
    rows += [("y", 100, day(0), None, dt.datetime(2024, 1, 1), "first"), ("y", 101, day(10), day(20), dt.datetime(2024, 1, 2), "correction"), ("y", 102, day(5), day(5), dt.datetime(2024, 1, 1), "empty")]
    df = spark.createDataFrame(rows, "k string, i int, f date, u date, s timestamp, v string").repartition(3)
    seg = MT.bitemporal_segments(df, ["k"], "f", "u", "s", "i")
    y = sorted((str(x.f), str(x.u), x.v, x.is_current) for x in seg.filter("k = 'y'").collect())
    assert ("2024-01-11", "2024-01-21", "correction", True) in y and ("2024-01-11", "2024-01-21", "first", False) in y and ("2024-01-21", "None", "first", True) in y
    days, times = [str(day(n)) for n in range(0, 160, 9)], [f"2024-01-0{1 + h // 24} {h % 24:02d}:30:00" for h in range(0, 44, 5)]
    got = {(x.k, str(x.valid_at), str(x.known_at)): x.v for x in MT.as_known_grid(seg, ["k"], "f", "u", "s", days, times, ["v"]).collect()}
    want = {}
    for k in ("x", "y"):
        for d in days:
            for at in times:
                seen = [(s, i, v) for kk, i, f, u, s, v in rows if kk == k and str(f) <= d and (u is None or d < str(u)) and str(s) <= at]
                if seen:
                    want[k, d, at] = max(seen)[2]
    assert got == want


def files(root):
    return {f: sorted(os.listdir(os.path.join(root, f))) for f in os.listdir(root) if "=" in f}


@pytest.mark.parametrize("late, days", [([("a", 4, 5)], 6), ([("a", 4, 5), ("b", 7, -2), ("a", 4, 1)], 6), ([("new", 8, 9)], 10), ([("a", -3, 2)], 10), ([("a", 50, 2)], 0)])
def test_restated_table_equals_a_rebuild(spark, tmp_path, late, days):
    """Only the days that change are overwritten; a new key changes all of them."""
    schema, first, last = "k string, ts timestamp, amount decimal(19,4)", str(day(0)), str(day(9))
    at = lambda rows: spark.createDataFrame([(k, dt.datetime(2024, 1, 1, 12) + dt.timedelta(days=d), D(a)) for k, d, a in rows], schema)
    base = [("a", 0, 3), ("a", 4, 2), ("b", 2, 7), ("b", -5, 1)]
    path = str(tmp_path / "balance")
    sinks.write_partitioned(PD.daily_balance(at(base), "k", "ts", "amount", first, last), path, ["balance_date"])
    before = files(path)
    changed = PD.restate_table(spark, path, at(late), "k", "ts", "amount", first, last)
    after = files(path)
    rows = lambda df: sorted((r.k, str(r.balance_date), r.movement, r.balance) for r in df.collect())
    assert rows(spark.read.parquet(path)) == rows(PD.daily_balance(at(base + late), "k", "ts", "amount", first, last))
    assert len(changed) == days and {f for f in before if before[f] != after[f]} == {f"balance_date={d}" for d in changed}


def test_daily_balance_of_an_empty_feed(spark, tmp_path):
    from strata.plans import registry
    registry.load_all()
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(0).write.parquet(str(tmp_path / "events.parquet"))
    assert registry.QUERIES["daily_balance"](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("most", [3, 200_000])
def test_allocation_in_windows_and_by_class(spark, most):
    """Headers on both sides of the bound, a missing header, a missing weight: the same shares either way."""
    r = random.Random(7)
    rows = [(None if i % 9 == 0 else f"h{i % 9}", i, None if i == 5 else D(r.randint(1, 99)), D("10.01")) for i in range(60)] + [("one", 0, D(5), D("3.33")), ("two", 0, D(1), D("0.01")), ("two", 1, D(1), D("0.01"))]
    df = spark.createDataFrame(rows, "h string, i int, w decimal(19,4), t decimal(19,4)").repartition(3)
    got = {(x.h, x.i): x.share for x in MT.allocate(df, ["h"], ["i"], "w", "t", "share", most=most).collect()}
    assert set(got) == {(h, i) for h, i, w, _ in rows if w is not None}
    weight = {}
    for h, _, w, _ in rows:
        weight[h] = weight.get(h, 0) + (w or 0)
    left = {h: 1001 if h not in ("one", "two") else 333 if h == "one" else 1 for h in weight}
    for h in weight:
        parts = sorted(((left[h] * w) % weight[h], -i, int(left[h] * w // weight[h])) for k, i, w, _ in rows if k == h and w is not None)[::-1]
        room = left[h] - sum(q for _, _, q in parts)
        for n, (_, i, q) in enumerate(parts):
            assert got[h, -i] * 100 == q + (n < room)


@pytest.mark.parametrize("most", [4, 200_000])
def test_pairs_in_order_and_by_cut(spark, most):
    """Keys on both sides of the bound and a missing key give the rows of the plain matching."""
    r = random.Random(3)
    rows = [(k, day(r.randint(0, 30)), i, r.randint(1, 9), i % 3 == 0) for k, n in (("a", 40), ("b", 3), ("c", 4), ("d", 5), (None, 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, d date, i int, q long, back boolean").repartition(3)
    out = MT.pair_reversals(df.filter("not back"), df.filter("back"), ["k"], ["d", "i"], "d", "q", step=5, most=most)
    assert out.columns == ["k", "o_d", "o_i", "r_d", "r_i", "matched", "is_matched"]
    got = {}
    for x in out.collect():
        key = (x.k, None if x.o_i is None else (x.o_d, x.o_i), None if x.r_i is None else (x.r_d, x.r_i), x.is_matched)
        assert key not in got
        got[key] = x.matched
    want = {}
    for k in {x[0] for x in rows}:
        sides = [[[(d, i), q] for kk, d, i, q, b in sorted((x for x in rows if x[0] == k), key=lambda x: x[1:3]) if b == side] for side in (False, True)]
        sold, returned = sides
        while k is not None and sold and returned:
            n = min(sold[0][1], returned[0][1])
            want[k, sold[0][0], returned[0][0], True] = n
            for side in sides:
                side[0][1] -= n
                if not side[0][1]:
                    side.pop(0)
        want |= {(k, at, None, False): q for at, q in sold} | {(k, None, at, False): q for at, q in returned}
    assert got == want


def test_allocation_and_pairs_move_rows_once(spark):
    """Rows of keys of usual size take one exchange by the key, not several by key, class, period and cut."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    df = spark.createDataFrame([("a", day(0), 0, D(1), D(1), False)], "k string, d date, i int, w decimal(19,4), t decimal(19,4), back boolean").repartition(3)

    def written(out):
        plan = out._jdf.queryExecution()
        out.collect()
        return plan.executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning")
    assert written(MT.allocate(df, ["k"], ["i"], "w", "t", "s")) <= 2
    assert written(MT.pair_reversals(df.filter("not back"), df.filter("back"), ["k"], ["d", "i"], "d", "w", step=5)) <= 2


@pytest.mark.parametrize("most", [1, 200_000])
def test_pairs_beside_undated_rows(spark, most):
    """An undated sale of 3 takes up the start of the axis: the return of 5 meets 2 of the dated sale, 3 stay; the sale's rest is 8."""
    df = spark.createDataFrame([("a", None, 1, 3, False), ("a", day(1), 2, 10, False), ("a", day(2), 3, 5, True)], "k string, d date, i int, q long, back boolean")
    out = MT.pair_reversals(df.filter("not back"), df.filter("back"), ["k"], ["d", "i"], "d", "q", step=5, most=most).collect()
    assert {(x.o_i, x.r_i, x.matched, x.is_matched) for x in out} == {(2, 3, 2, True), (2, None, 8, False), (None, 3, 3, False)} and len(out) == 3
