"""The model's queries on hand-made tables in a folder."""

import datetime as dt
import re

import pytest

from strata.operators import windows
from strata.plans import registry

registry.load_all()

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
}


def ts(text):
    return dt.datetime.fromisoformat(text)


def line(order, number, part=1, supp=1, qty=2.0, price=10.0, discount=0.1, tax=0.05, flag="N", status="O", ship="1995-03-01"):
    return (order, part, supp, number, qty, price, discount, tax, flag, status, ts(ship))


ROWS = {
    "region": [(0, "R0"), (1, "R1")],
    "nation": [(n, f"N{n}", n % 2) for n in range(7)],
    "customer": [(c, f"C{c}", c % 7, 10.0 * c - 20, " building") for c in range(8)] + [(90, "lost", None, 1.0, "x"), (91, "far", 99, 1.0, "x")],
    "supplier": [(1, "S1", 1, 0.0), (2, "S2", 2, 0.0), (3, "S3", None, 0.0)],
    "part": [(1, "p1", "b1", "t1", 3, 5.0), (2, "p2", "b1", "t2", 30, None)],
    "orders": [(o, o % 8, "OPF"[o % 3], 18.9, ts(f"1995-0{1 + o % 6}-15"), "1-URGENT") for o in range(14)] + [(50, 90, "O", 5.0, ts("1995-02-02"), "2-HIGH"), (51, None, "X", 0.0, ts("1995-02-03"), "2-HIGH")],
    "lineitem": [line(o, n, flag="NRA"[(o + n) % 3], status="OF"[n % 2]) for o in range(14) for n in (1, 2)],
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """``folder(table=rows)`` writes the tables, some of them replaced."""
    def make(**other):
        at = tmp_path_factory.mktemp("model")
        for name, schema in SCHEMAS.items():
            spark.createDataFrame(other.get(name, ROWS[name]), schema).coalesce(2).write.parquet(f"{at}/{name}.parquet")
        return str(at)
    return make


def rows(spark, name, at):
    return registry.QUERIES[name](spark, at).collect()


def test_headers_are_checked_against_their_lines(spark, folder):
    """Order 1: the header's total agrees with revenue and tax of its lines; 2: it does not; 3: no lines at all; 4: a line came twice."""
    orders = [(o, 1, "O", total, ts("1995-01-15"), "1-URGENT") for o, total in ((1, 18.9), (2, 30.0), (3, 4.0), (4, 9.45))]
    at = folder(orders=orders, lineitem=[line(1, 1), line(1, 2), line(2, 1), line(4, 1), line(4, 1, ship="1995-02-01")])
    got = {r.invoice_id: (r.header_total, r.line_total, r.difference) for r in rows(spark, "header_line_check", at)}
    assert got == {2: (30.0, 9.45, 20.55), 3: (4.0, None, 4.0)}


def test_every_address_is_used(spark, folder):
    """A customer of each of seven nations has an address in mid-1995, as an order of that year names the nation; one without a nation has none."""
    got = {r.customer_account: (r.primary_city, r.city_was_missing) for r in rows(spark, "default_with_flag", folder())}
    assert got == {**{c: (f"CITY-N{c % 7}-1995", False) for c in range(8)}, 90: ("UNKNOWN", True), 91: ("UNKNOWN", True)}


def test_every_nation_is_a_source(spark, folder):
    """Orders of 1996 only: no address in mid-1995, so the nation's name counts, of every nation."""
    orders = [(o, o % 8, "O", 1.0, ts("1996-01-15"), "1-URGENT") for o in range(7)] + [(7, 3, "O", 1.0, ts("1995-01-15"), "1-URGENT")]
    got = {r.customer_account: (r.location, r.source_used) for r in rows(spark, "by_precedence", folder(orders=orders))}
    assert got == {**{c: (f"N{c % 7}", "nation") for c in range(8) if c != 3}, 3: ("CITY-N3-1995", "address"), 90: (None, None), 91: (None, None)}


def plan(spark, name, at):
    return registry.QUERIES[name](spark, at)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name, amount", [("obt_revenue", "line_revenue"), ("fact_sales_invoice_line", "line_revenue"), ("fact_sales_order_line", "sales_qty")])
def test_amounts_are_computed_after_the_joins(spark, folder, name, amount):
    """Below the topmost join no line carries a computed amount: lines move with the source's columns."""
    above, join, below = plan(spark, name, folder()).partition("Join ")
    assert join and f" AS {amount}#" in above and f" AS {amount}#" not in below


def test_wide_rows_with_and_without_customers(spark, folder):
    """Customers that meet the headers: every line is there once, with its customer's name, also where nation or customer are missing."""
    lines = [line(o, 1) for o in (0, 1, 2, 50, 51)] + [line(1, 2), line(1, 2, ship="1995-04-01"), line(2, 7, part=9, supp=9)]
    got = sorted((r.invoice_number, r.line_number, r.customer_name, r.company) for r in rows(spark, "obt_revenue", folder(lineitem=lines)))
    assert got == [(0, 1, "C0", 0), (1, 1, "C1", 1), (1, 2, "C1", 1), (2, 1, "C2", 0), (2, 7, "C2", 0), (50, 1, "lost", None), (51, 1, None, None)]


def test_the_ten_tests_read_the_lines_few_times(spark, folder):
    at = folder()
    got = {r.n: (r.measured, r.failures, r.passed) for r in rows(spark, "sales_invoice_line_tests", at)}
    assert {n: v[0] for n, v in got.items()} == {1: 28, 2: 28, 3: 28, 4: 28, 5: 2, 6: 28, 7: 28, 8: 28, 9: got[9][0], 10: 0} and all(v[2] for v in got.values())
    reads = [x for x in plan(spark, "sales_invoice_line_tests", at).splitlines() if "Relation " in x and "l_orderkey#" in x]
    assert 0 < len(reads) <= 10


def exchanges(spark, name, at, column):
    """The different exchanges of the plan whose rows carry ``column``."""
    node = registry.QUERIES[name](spark, at)._jdf.queryExecution().executedPlan()
    todo, found = [node.initialPlan() if node.nodeName() == "AdaptiveSparkPlan" else node], set()
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Exchange" and f"{column}#" in node.output().mkString(" "):
            found.add(re.sub(r"plan_id=\d+|#\d+L?", "", node.canonicalized().toString()))
    return found


ODD_LINES = [line(o, n, part=1 + (o + n) % 3, supp=1 + n % 4, flag="NRA"[(o + n) % 3], status="OF"[n % 2], tax=n / 100) for o in range(14) for n in (1, 2, 3)] + [
    line(3, 2, ship="1995-05-01"), line(3, 2, ship="1995-05-01"), line(3, None), line(3, None, ship="1994-05-01"), line(5, 1, part=None), line(5, 7, part=None, supp=None), line(None, 1), line(None, 1), line(None, None),
    line(50, 1), line(51, 2, part=1), line(99, 1)]
#: Parts, customers and orders that come twice: lines are repeated as often.
ODD = {"lineitem": ODD_LINES, "part": ROWS["part"] + [(1, "p1", "b1", "t1", 3, 6.0)], "customer": ROWS["customer"] + [(2, "C2", 3, 1.0, "x")],
       "orders": ROWS["orders"] + [(3, 3, "O", 20.0, ts("1996-01-01"), "1-URGENT"), (None, 1, "O", 1.0, ts("1995-01-01"), "2-HIGH")]}


@pytest.fixture
def shuffled(spark):
    """Joins of large tables: nothing is broadcast unasked."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")


@pytest.mark.parametrize("name", ["fact_sales_invoice_line", "obt_revenue"])
def test_invoice_lines_move_once(spark, folder, shuffled, name):
    """Only the exchange that brings lines together by order, and the last one, to their supplier, carry their amounts."""
    assert len(exchanges(spark, name, folder(), "l_extendedprice")) == 2


@pytest.mark.parametrize("name", ["fact_sales_invoice_line", "obt_revenue", "sales_invoice_line"])
def test_crowded_orders_give_the_same_lines(spark, folder, monkeypatch, name):
    """Every order crowded, some, and none: the same rows, each as often, on repeated keys and NULLs, too."""
    at, got = folder(**ODD), []
    for most in (4_096, 4, 0):
        monkeypatch.setattr(windows, "TOGETHER_ROWS", most)
        got.append(sorted(map(str, rows(spark, name, at))))
    assert got[0] == got[1] == got[2] and len(got[0]) > len(ODD_LINES)


def test_the_ten_tests_on_crowded_orders(spark, folder, monkeypatch):
    """The same figures whichever way the lines take; discarded deliveries without a full key are not traceable."""
    at, got = folder(**ODD), []
    for most in (4_096, 4, 0):
        monkeypatch.setattr(windows, "TOGETHER_ROWS", most)
        got.append([tuple(r) for r in rows(spark, "sales_invoice_line_tests", at)])
    assert got[0] == got[1] == got[2]
    figures = {r[0]: r[2:4] for r in got[0]}
    # discarded: two of (3, 2), one of (3, NULL), one of (5, 1) and one of (NULL, 1); those without a full key count as untraced
    assert figures[10] == (5, 2) and figures[2][0] == figures[8][0]


def test_the_ten_tests_move_the_lines_once(spark, folder, shuffled):
    """Everything that needs whole lines shares the exchange that brings them together by order; those to the supplier, small, aside."""
    found = exchanges(spark, "sales_invoice_line_tests", folder(), "l_extendedprice")
    assert len([x for x in found if "l_suppkey" not in x.partition("\n")[0] and "Join" not in x]) == 1


def test_the_ten_tests_without_lines(spark, folder):
    got = {r.n: (r.measured, r.failures) for r in rows(spark, "sales_invoice_line_tests", folder(lineitem=[]))}
    assert {n: v[0] for n, v in got.items() if n != 1} == dict.fromkeys(range(2, 11), 0)


def test_tax_and_cost_of_odd_lines(spark, folder):
    """The invoice's tax counts each kept line once, though its part stands there twice; a line without a part has no cost."""
    lines = [line(3, 1, tax=0.5), line(3, 2, tax=0.1), line(3, 2, tax=0.9, ship="1994-01-01"), line(3, None, part=None, tax=0.4)]
    at = folder(lineitem=lines, part=ROWS["part"] + [(1, "p1", "b1", "t1", 3, 6.0)])
    got = sorted((r.line_number or 0, r.line_cost, r.allocated_tax) for r in rows(spark, "fact_sales_invoice_line", at))
    tax = 9 / 18.9 * 9 * (0.5 + 0.1 + 0.4)
    assert [(n, c) for n, c, _ in got] == [(0, 0.0), (1, 7.5), (1, 9.0), (2, 7.5), (2, 9.0)] and all(abs(x - tax) < 1e-9 for *_, x in got)


def test_rows_beside_rows(spark):
    left = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, None, "c"), (2, 1, "d")], "k int, l int, v string")
    right = spark.createDataFrame([(1, 1, 10), (1, None, 11), (1, None, 12), (1, 2, 13), (3, 3, 14)], "k int, l int, w int")
    got = sorted((r.v, r.w or 0) for r in windows.beside(left, right, "k", "l").collect())
    assert got == [("a", 10), ("b", 10), ("c", 11), ("c", 12), ("d", 0)]
