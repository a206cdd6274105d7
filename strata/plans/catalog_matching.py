"""Named queries of allocation, reversal pairing and bitemporal history."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import joins
from strata.operators import matching as MT
from strata.plans import silver as S
from strata.plans.oracle import sql
from strata.plans.registry import query

#: Dates and instants of the grid query: days of the feed's month.
GRID_DAYS = ("2024-01-03", "2024-01-10", "2024-01-17", "2024-01-24", "2024-01-31")
GRID_TIMES = tuple(f"{d} 12:00:00" for d in GRID_DAYS)


@query("allocated_tax", sql("""SELECT invoice_id, line_num, CAST(total AS DOUBLE) AS total_tax,
  CAST((q + CASE WHEN row_number() OVER (PARTITION BY invoice_id ORDER BY r DESC, line_num) <= digits - sum(q) OVER (PARTITION BY invoice_id) THEN 1 ELSE 0 END)::DECIMAL(19,2) / 100 AS DOUBLE) AS allocated_tax
FROM (SELECT *, (x - ((x % a) + a) % a) // a AS q, ((x % a) + a) % a AS r FROM (
  SELECT *, digits * w AS x, sum(w) OVER (PARTITION BY invoice_id) AS a FROM (
    SELECT il.invoice_id, il.line_num, total, round(total * 100)::HUGEINT AS digits, (il.line_revenue * 10000)::HUGEINT AS w
    FROM il JOIN (SELECT invoice_id, CASE WHEN invoice_id % 5 = 0 THEN -total_tax ELSE total_tax END AS total FROM ih) h ON h.invoice_id = il.invoice_id) l) y) z""", "il", "ih"))
def allocated_tax(t):
    """Header tax dealt out to the lines by revenue, to the cent (every fifth invoice as a credit note)."""
    h = S.invoice_header(t).select(F.col("invoice_id").alias("h_id"), F.when(F.col("invoice_id") % 5 == 0, -F.col("total_tax")).otherwise(F.col("total_tax")).alias("total_tax"))
    lines = S.invoice_line(t).select("invoice_id", "line_num", "line_revenue").join(h, F.col("invoice_id") == F.col("h_id"))
    return MT.allocate(lines, ["invoice_id"], ["line_num"], "line_revenue", "total_tax", "allocated_tax").select("invoice_id", "line_num", "total_tax", "allocated_tax")


_REVERSALS = """m AS (SELECT item_id, ship_date, invoice_id, line_num, invoiced_qty AS qty, department = 'R' AS back FROM il),
c AS (SELECT *, sum(qty) OVER (PARTITION BY item_id, back ORDER BY ship_date, invoice_id, line_num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM m WHERE qty > 0),
p AS (SELECT o.item_id, o.ship_date AS o_ship_date, o.invoice_id AS o_invoice_id, o.line_num AS o_line_num, r.ship_date AS r_ship_date, r.invoice_id AS r_invoice_id, r.line_num AS r_line_num,
  least(o.upto, r.upto) - greatest(o.upto - o.qty, r.upto - r.qty) AS matched
  FROM c o JOIN c r ON o.item_id = r.item_id AND NOT o.back AND r.back AND o.upto - o.qty < r.upto AND r.upto - r.qty < o.upto)"""


@query("reversal_pairs", sql("SELECT * FROM il", "il").replace("SELECT * FROM il", ", " + _REVERSALS + """
SELECT * REPLACE (CAST(matched AS DOUBLE) AS matched), true AS is_matched FROM p
UNION ALL SELECT c.item_id, c.ship_date, c.invoice_id, c.line_num, NULL, NULL, NULL, CAST(any_value(qty) - coalesce(sum(matched), 0) AS DOUBLE), false
  FROM c LEFT JOIN p ON o_invoice_id = c.invoice_id AND o_line_num = c.line_num WHERE NOT back GROUP BY ALL HAVING any_value(qty) > coalesce(sum(matched), 0)
UNION ALL SELECT c.item_id, NULL, NULL, NULL, c.ship_date, c.invoice_id, c.line_num, CAST(any_value(qty) - coalesce(sum(matched), 0) AS DOUBLE), false
  FROM c LEFT JOIN p ON r_invoice_id = c.invoice_id AND r_line_num = c.line_num WHERE back GROUP BY ALL HAVING any_value(qty) > coalesce(sum(matched), 0)"""))
def reversal_pairs(t):
    """K7: returned quantities of an item paired with its sold ones in the order of their dates, and what stays without a partner."""
    il = S.invoice_line(t).select("item_id", "ship_date", "invoice_id", "line_num", "invoiced_qty", "department")
    back = F.col("department") == "R"
    return MT.pair_reversals(il.filter(~back), il.filter(back), ["item_id"], ["ship_date", "invoice_id", "line_num"], "ship_date", "invoiced_qty", step=200)


# where a customer is: at its nation first, then (a third of them after a gap) at the next one; a few are entered twice for a while
_WHEREABOUTS = """w AS (SELECT c_custkey, c_nationkey AS place, DATE '1992-01-01' AS f, DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS u FROM customer
UNION ALL SELECT c_custkey, (c_nationkey + 1) % 25, DATE '1995-01-01' + CAST(c_custkey % 365 + CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 40 ELSE 0 END AS INTEGER), NULL FROM customer
UNION ALL SELECT c_custkey, (c_nationkey + 2) % 25, DATE '1996-01-01', DATE '1996-09-01' FROM customer WHERE c_custkey % 11 = 0),
chain AS (SELECT c_custkey, place, city, rate, greatest(f, valid_from) AS valid_from, least(u, valid_to) AS valid_to
  FROM w JOIN ah ON ah.nation_key = place AND (valid_to IS NULL OR f < valid_to) AND (u IS NULL OR valid_from < u))"""


def _whereabouts(t):
    c = t.customer.select("c_custkey", "c_nationkey")
    moved = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
    gap = F.date_add(moved, F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") % 40).otherwise(0).cast("int"))
    parts = [(c, 0, F.lit("1992-01-01").cast("date"), moved), (c, 1, gap, F.lit(None).cast("date")),
             (c.filter("c_custkey % 11 = 0"), 2, F.lit("1996-01-01").cast("date"), F.lit("1996-09-01").cast("date"))]
    every = [df.select("c_custkey", F.pmod(F.col("c_nationkey") + n, F.lit(25)).alias("place"), f.alias("valid_from"), u.alias("valid_to")) for df, n, f, u in parts]
    return every[0].unionByName(every[1]).unionByName(every[2])


def _chain(t):
    h = S.address_history(t).select("nation_key", "city", "rate", "valid_from", "valid_to")
    return joins.dated_chain(_whereabouts(t), [(h, "place", "nation_key")])


@query("address_chain", sql("SELECT * FROM ah", "ah").replace("SELECT * FROM ah", ", " + _WHEREABOUTS + """
SELECT c_custkey, place, city, CAST(rate AS DOUBLE) AS rate, valid_from, valid_to FROM chain"""))
def address_chain(t):
    """Customer, location and address through dated hops, each row with the period in which every hop held."""
    return _chain(t).select("c_custkey", "place", "city", "rate", "valid_from", "valid_to")


@query("customer_at_date", sql("SELECT * FROM ah", "ah").replace("SELECT * FROM ah", ", " + _WHEREABOUTS + """
SELECT c.c_custkey, c_name, place, city, count(place) OVER (PARTITION BY c.c_custkey) AS addresses FROM customer c
LEFT JOIN (SELECT * FROM chain WHERE valid_from <= DATE '1996-03-31' AND (valid_to IS NULL OR DATE '1996-03-31' < valid_to)) a ON a.c_custkey = c.c_custkey"""))
def customer_at_date(t):
    """Customers with the address that every hop names at a date: none in a gap, all of them where two are entered."""
    at = joins.valid_at(_chain(t), F.lit("1996-03-31").cast("date")).select(F.col("c_custkey").alias("k"), "place", "city")
    n = at.groupBy(F.col("k").alias("n_k")).agg(F.count(F.lit(1)).alias("addresses"))
    c = t.customer.select("c_custkey", "c_name")
    out = c.join(at, F.col("c_custkey") == F.col("k"), "left").join(n, F.col("c_custkey") == F.col("n_k"), "left")
    return out.select("c_custkey", "c_name", "place", "city", F.coalesce("addresses", F.lit(0)).alias("addresses"))


_STATED = """WITH e AS (SELECT user_id, event_id, event_type, ts, CAST(ts AS DATE) - CAST(event_id % 12 AS INTEGER) AS f,
  CASE WHEN event_id % 6 > 0 THEN CAST(ts AS DATE) - CAST(event_id % 12 AS INTEGER) + CAST(event_id % 6 * 3 AS INTEGER) END AS u FROM events)"""


def _stated(t):
    """Statements about an earlier stretch of days, as the feed's events make them; every sixth is open."""
    start = F.expr("date_sub(to_date(ts), cast(event_id % 12 as int))")
    return t.events.select("user_id", "event_id", "event_type", "ts", start.alias("valid_from"),
                           F.when(F.col("event_id") % 6 > 0, F.expr("date_add(date_sub(to_date(ts), cast(event_id % 12 as int)), cast(event_id % 6 * 3 as int))")).alias("valid_to"))


@query("bitemporal_segments", _STATED + """, b AS (SELECT DISTINCT user_id, unnest([f, u]) AS d FROM e),
s AS (SELECT user_id, d, lead(d) OVER (PARTITION BY user_id ORDER BY d) AS until FROM b WHERE d IS NOT NULL)
SELECT s.user_id, d AS valid_from, until AS valid_to, event_id, event_type, ts,
  lead(ts) OVER (PARTITION BY s.user_id, d ORDER BY ts, event_id) AS system_to, lead(ts) OVER (PARTITION BY s.user_id, d ORDER BY ts, event_id) IS NULL AS is_current
FROM s JOIN e ON e.user_id = s.user_id AND d >= f AND (u IS NULL OR d < u)""")
def bitemporal_segments(t):
    """K3: the full two-axis table: corrections cut earlier statements, valid and system periods derived."""
    return MT.bitemporal_segments(_stated(t), ["user_id"], "valid_from", "valid_to", "ts", "event_id")


@query("as_known_grid", _STATED + ", g AS (SELECT v, k FROM (SELECT unnest([" + ", ".join(f"DATE '{d}'" for d in GRID_DAYS) + "]) AS v), (SELECT unnest(["
       + ", ".join(f"TIMESTAMP '{d}'" for d in GRID_TIMES) + """]) AS k))
SELECT user_id, v AS valid_at, k AS known_at, event_id, event_type FROM e JOIN g ON v >= f AND (u IS NULL OR v < u) AND ts <= k
QUALIFY row_number() OVER (PARTITION BY user_id, v, k ORDER BY ts DESC, event_id DESC) = 1""")
def as_known_grid(t):
    """K3: what was valid on five days, as known at five times."""
    h = MT.bitemporal_segments(_stated(t), ["user_id"], "valid_from", "valid_to", "ts", "event_id")
    return MT.as_known_grid(h, ["user_id"], "valid_from", "valid_to", "ts", GRID_DAYS, GRID_TIMES, ["event_id", "event_type"])
