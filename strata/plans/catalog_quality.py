"""Named queries of the data-quality, reconciliation and join-check operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.keys import checksum
from strata.operators import joins, quality as Q, windows
from strata.plans import gold as G
from strata.plans import silver as S
from strata.plans.oracle import LINE_ORDER_SQL, cte, sql
from strata.plans.registry import query

# The rule set applied to raw lines (SQL text, shared by both engines).
LINE_RULES = [
    Q.Rule("valid_quantity", "warn", "l_quantity BETWEEN 1 AND 50"),
    Q.Rule("known_return_flag", "reject", "l_returnflag IN ('A', 'N', 'R')"),
    Q.Rule("low_tax", "quarantine", "l_tax < 0.07"),
    Q.Rule("small_discount", "warn", "l_discount <= 0.08"),
    Q.Rule("shipped_after_1995_06", "quarantine", "l_shipdate >= TIMESTAMP '1995-06-01 00:00:00'"),
]
# Posted orders are the parent table of the orphan checks: lines of orders not
# yet posted (status 'P') have no parent there.
POSTED = "o_orderstatus <> 'P'"
NOW = "2024-02-01 00:00:00"


def _sev_sql() -> str:
    parts = ", ".join(f"CASE WHEN NOT coalesce({r.condition}, false) THEN {Q.SEVERITY[r.severity]} ELSE 0 END"
                      for r in LINE_RULES)
    return f"greatest(0, {parts})"


def _failed_sql() -> str:
    parts = ", ".join(f"CASE WHEN NOT coalesce({r.condition}, false) THEN '{r.name}' END" for r in LINE_RULES)
    return f"list_filter([{parts}], lambda x: x IS NOT NULL)"


DISP_SQL = "CASE s WHEN 0 THEN 'PASS' WHEN 1 THEN 'WARNING' WHEN 2 THEN 'QUARANTINE' WHEN 3 THEN 'REJECT' END"

_expect_sql = " UNION ALL ".join(
    f"SELECT '{r.name}' AS rule, '{r.severity}' AS severity, count(*) FILTER (WHERE NOT coalesce({r.condition}, false)) AS failed, "
    f"count(*) FILTER (WHERE coalesce({r.condition}, false)) AS passed FROM lineitem" for r in LINE_RULES)


@query("expect_counts", _expect_sql)
def expect_counts(t):
    """Warn-style expectations — rows kept, violations counted per rule."""
    return Q.expect(t.lineitem, LINE_RULES)


@query("expect_or_drop", "SELECT * FROM lineitem WHERE " + " AND ".join(
    f"coalesce({r.condition}, false)" for r in LINE_RULES if r.severity == "reject"))
def expect_or_drop(t):
    """Rows failing a drop (reject) rule are removed."""
    return Q.expect_or_drop(t.lineitem, [r for r in LINE_RULES if r.severity == "reject"])


@query("quarantine", f"""SELECT * EXCLUDE (s, fr), array_to_string(fr, ',') AS failed_rules, {DISP_SQL} AS disposition
FROM (SELECT *, {_sev_sql()} AS s, {_failed_sql()} AS fr FROM lineitem) x WHERE s > 1""")
def quarantine(t):
    """Quarantined rows with their failing rules, from one evaluation pass."""
    _, held = Q.quarantine(t.lineitem, LINE_RULES)
    return held.withColumn("failed_rules", F.array_join("failed_rules", ","))


@query("quarantine_passed", f"""SELECT * FROM lineitem WHERE {_sev_sql()} <= 1""")
def quarantine_passed(t):
    """The complement — rows released (warn-only failures stay)."""
    passed, _ = Q.quarantine(t.lineitem, LINE_RULES)
    return passed.drop("failed_rules")


@query("disposition", f"""SELECT {DISP_SQL} AS disposition, count(*) AS n_rows
FROM (SELECT {_sev_sql()} AS s FROM lineitem) x GROUP BY 1""")
def disposition(t):
    """PASS / WARNING / QUARANTINE / REJECT distribution."""
    return Q.disposition(t.lineitem, LINE_RULES).groupBy("disposition").agg(F.count(F.lit(1)).alias("n_rows"))


@query("grain_unique", """SELECT sum(n) AS rows, count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
  count(*) FILTER (WHERE n > 1) = 0 AS passed
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) x""")
def grain_unique(t):
    """The declared grain (order, line) of raw lines — not unique before dedup."""
    return Q.grain_unique(t.lineitem, S.LINE_KEY)


@query("grain_unique_silver", sql("""SELECT sum(n) AS rows, count(*) AS distinct_keys,
  count(*) FILTER (WHERE n > 1) AS duplicate_keys, count(*) FILTER (WHERE n > 1) = 0 AS passed
FROM (SELECT invoice_id, line_num, count(*) AS n FROM il GROUP BY 1, 2) x""", "il"))
def grain_unique_silver(t):
    """The same grain holds on the Silver invoice line."""
    return Q.grain_unique(S.invoice_line(t), ["invoice_id", "line_num"])


@query("grain_not_null", """SELECT count(*) AS rows,
  count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS null_keys,
  count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) = 0 AS passed FROM lineitem""")
def grain_not_null(t):
    """No key part is NULL."""
    return Q.grain_not_null(t.lineitem, S.LINE_KEY)


@query("key_profile", """SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(DISTINCT l_partkey) AS n_distinct_l_partkey,
  min(l_shipdate) AS first_seen, max(l_shipdate) AS last_seen, count(*) > 1 AS is_duplicate
FROM lineitem GROUP BY 1, 2""")
def key_profile(t):
    """Business-key study — duplicates, reuse for different items, first / last seen."""
    return Q.key_profile(t.lineitem, S.LINE_KEY, "l_partkey", "l_shipdate")


cte("ctl_raw", f"""SELECT l_returnflag, sum(n) AS rows, sum(n - 1) AS duplicate_rows, sum(q) AS sum_qty,
  sum(a) AS sum_amount, min(dmin) AS min_date, max(dmax) AS max_date, sum(ck) AS checksum
FROM (SELECT l_returnflag, l_orderkey, l_linenumber, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(19,6))) AS q,
        sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS a, min(l_shipdate) AS dmin, max(l_shipdate) AS dmax,
        sum(CAST(('0x' || substr(md5(concat_ws('|', coalesce(CAST(l_orderkey AS VARCHAR), '\\N'),
            coalesce(CAST(l_linenumber AS VARCHAR), '\\N'), coalesce(CAST(l_partkey AS VARCHAR), '\\N'),
            coalesce(l_returnflag, '\\N'))), 1, 8)) AS BIGINT)) AS ck
      FROM lineitem GROUP BY 1, 2, 3) x GROUP BY 1""")


def _raw_lines(t):
    return t.lineitem.select("*", S.dec6("l_quantity").alias("qty"), S.dec4("l_extendedprice").alias("amount"))


def _ctl(df):
    return Q.control_totals(df, ["l_returnflag"], S.LINE_KEY, ["qty", "amount"], "l_shipdate",
                            ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"]) \
        .withColumnRenamed("sum_qty", "sum_qty").withColumnRenamed("sum_amount", "sum_amount")


@query("control_totals", sql("""SELECT l_returnflag, rows, duplicate_rows, CAST(sum_qty AS DOUBLE) AS sum_qty,
  CAST(sum_amount AS DOUBLE) AS sum_amount, min_date, max_date, checksum FROM ctl_raw""", "ctl_raw"))
def control_totals(t):
    """Control totals per return flag: rows, duplicates, sums, date range, checksum."""
    return _ctl(_raw_lines(t))


@query("reconcile", sql("""SELECT coalesce(s.l_returnflag, g.l_returnflag) AS l_returnflag,
  s.rows AS src_rows, g.rows AS tgt_rows, coalesce(x.rows, 0) AS excl_rows,
  coalesce(s.rows, 0) - coalesce(g.rows, 0) - coalesce(x.rows, 0) AS diff_rows,
  CAST(s.amount AS DOUBLE) AS src_amount, CAST(g.amount AS DOUBLE) AS tgt_amount,
  CAST(coalesce(x.amount, 0) AS DOUBLE) AS excl_amount,
  CAST(coalesce(s.amount, 0) - coalesce(g.amount, 0) - coalesce(x.amount, 0) AS DOUBLE) AS diff_amount,
  CASE WHEN abs(coalesce(s.rows, 0) - coalesce(g.rows, 0) - coalesce(x.rows, 0)) <= 0
        AND abs(coalesce(s.amount, 0) - coalesce(g.amount, 0) - coalesce(x.amount, 0)) <= 0 THEN 'MATCH' ELSE 'BREAK' END AS status
FROM (SELECT l_returnflag, count(*) AS rows, sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS amount FROM lineitem GROUP BY 1) s
FULL OUTER JOIN (SELECT l_returnflag, count(*) AS rows, sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS amount FROM li WHERE l_returnflag <> 'R' OR l_linenumber <> 4 GROUP BY 1) g
  ON s.l_returnflag = g.l_returnflag
LEFT JOIN (SELECT l_returnflag, count(*) AS rows, sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS amount
           FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                 ORDER BY """ + LINE_ORDER_SQL + """) > 1) d GROUP BY 1) x
  ON coalesce(s.l_returnflag, g.l_returnflag) = x.l_returnflag""", "li"))
def reconcile(t):
    """raw = silver + deduplicated, per return flag (rows and amount), outer-joined control totals; the target has lost some returned lines."""
    kept, discarded = windows.dedup(t.lineitem, S.LINE_KEY, S.LINE_ORDER)
    kept = kept.filter("l_returnflag <> 'R' OR l_linenumber <> 4")

    def totals(df):
        return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"),
                                              F.sum(S.dec4("l_extendedprice")).alias("amount"))
    return Q.reconcile(totals(t.lineitem), totals(kept), ["l_returnflag"], ["rows", "amount"], 0.0, totals(discarded))


@query("dedup_tiebreak", f"""SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) > 1""")
def dedup_tiebreak(t):
    """rows discarded by the ordered-tie-break dedup (kept ⊎ discarded = input)."""
    return windows.dedup(t.lineitem, S.LINE_KEY, S.LINE_ORDER)[1]


@query("duplicates", """SELECT l.*, d.dup_count FROM lineitem l JOIN
  (SELECT l_orderkey, l_linenumber, count(*) AS dup_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) d
  USING (l_orderkey, l_linenumber)""")
def duplicates(t):
    """duplicated-key rows kept with their key's count."""
    return windows.duplicates(t.lineitem, S.LINE_KEY)


@query("orphans", f"""SELECT l.* FROM lineitem l WHERE l.l_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE {POSTED} AND o.o_orderkey = l.l_orderkey)""")
def orphans(t):
    """Lines whose order is absent from the posted-orders table (NULL FKs reported apart)."""
    return joins.orphans(t.lineitem, t.orders.filter(POSTED), ["l_orderkey"], ["o_orderkey"])


@query("fk_rate", f"""SELECT count(*) AS children, count(*) FILTER (WHERE l_orderkey IS NULL) AS null_fk,
  count(*) FILTER (WHERE l_orderkey IS NOT NULL AND p.o_orderkey IS NULL) AS orphans,
  CASE WHEN count(*) - count(*) FILTER (WHERE l_orderkey IS NULL) > 0 THEN
    CAST(count(*) - count(*) FILTER (WHERE l_orderkey IS NULL)
         - count(*) FILTER (WHERE l_orderkey IS NOT NULL AND p.o_orderkey IS NULL) AS DOUBLE)
    / CAST(count(*) - count(*) FILTER (WHERE l_orderkey IS NULL) AS DOUBLE) END AS integrity_rate
FROM lineitem l LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE {POSTED}) p ON l.l_orderkey = p.o_orderkey""")
def fk_rate(t):
    """Referential-integrity rate of lines against posted orders."""
    return Q.fk_rate(t.lineitem, t.orders.filter(POSTED), "l_orderkey", "o_orderkey")


@query("sync_lag", f"""SELECT event_type, max(ts) AS last_sync,
  CAST(floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(ts))) / 60000000) AS BIGINT) AS lag_minutes
FROM events GROUP BY event_type""")
def sync_lag(t):
    """Latest sync and lag in minutes per feed (grouped, against an injected now)."""
    return Q.sync_lag(t.events, "event_type", "ts", F.lit(NOW).cast("timestamp_ntz"))


CUSTOMER_CHECKS = [
    ("c_name", "completeness", "c_name IS NOT NULL AND trim(c_name) <> ''"),
    ("c_acctbal", "validity", "c_acctbal >= 0"),
    ("c_mktsegment", "validity", "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"),
    ("c_nationkey", "consistency", "c_nationkey BETWEEN 0 AND 24"),
]


@query("scorecard", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{d}' AS dimension, count(*) FILTER (WHERE coalesce({cond}, false)) AS meeting, "
    f"count(*) AS rows, CAST(count(*) FILTER (WHERE coalesce({cond}, false)) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rate "
    f"FROM customer" for c, d, cond in CUSTOMER_CHECKS))
def scorecard(t):
    """Completeness / validity / consistency rates per column."""
    return Q.scorecard(t.customer, CUSTOMER_CHECKS)


@query("header_line_check", sql("""SELECT h.invoice_id, CAST(h.invoice_amount AS DOUBLE) AS header_total,
  CAST(s.line_total AS DOUBLE) AS line_total,
  CAST(h.invoice_amount - coalesce(s.line_total, 0) AS DOUBLE) AS difference
FROM ih h LEFT JOIN (SELECT invoice_id, sum(line_revenue + line_tax) AS line_total FROM il GROUP BY 1) s
  ON h.invoice_id = s.invoice_id
WHERE abs(h.invoice_amount - coalesce(s.line_total, 0)) > 1.00""", "ih", "il"))
def header_line_check(t):
    """Invoice header total vs the sum of its lines (revenue + tax), tolerance 1.00."""
    lines = S.invoice_line(t).withColumn("gross", F.col("line_revenue") + F.col("line_tax"))
    return (Q.header_line_check(S.invoice_header(t).withColumnRenamed("invoice_amount", "header_total"),
                                lines, "invoice_id", "header_total", "gross", 1.00)
            .select("invoice_id", "header_total", "line_total", "difference"))


@query("undecoded", """SELECT o_orderstatus, count(*) AS n_rows FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('O', 'F') GROUP BY 1""")
def undecoded(t):
    """Status codes with no label (the label table omits 'P')."""
    spark = t.spark
    labels = spark.createDataFrame([("O", "Open"), ("F", "Invoiced")], "code string, label string")
    return Q.undecoded(t.orders, "o_orderstatus", labels, "code")


@query("readiness", sql("""SELECT 'grain_unique' AS "check", count(*) FILTER (WHERE n > 1) = 0 AS passed,
  CAST(count(*) FILTER (WHERE n > 1) AS VARCHAR) AS observed
FROM (SELECT invoice_id, line_num, count(*) AS n FROM il GROUP BY 1, 2) a
UNION ALL
SELECT 'grain_not_null', count(*) FILTER (WHERE invoice_id IS NULL OR line_num IS NULL) = 0,
  CAST(count(*) FILTER (WHERE invoice_id IS NULL OR line_num IS NULL) AS VARCHAR) FROM il
UNION ALL
SELECT 'header_exists', count(*) FILTER (WHERE h.invoice_id IS NULL) = 0,
  CAST(count(*) FILTER (WHERE h.invoice_id IS NULL) AS VARCHAR)
FROM il LEFT JOIN (SELECT DISTINCT invoice_id FROM ih) h ON il.invoice_id = h.invoice_id
UNION ALL
SELECT 'amount_not_negative', count(*) FILTER (WHERE line_revenue < 0) = 0,
  CAST(count(*) FILTER (WHERE line_revenue < 0) AS VARCHAR) FROM il""", "il", "ih"))
def readiness(t):
    """Does the Silver invoice line qualify to feed a fact? one row per criterion."""
    il = S.invoice_line(t)
    gu = Q.grain_unique(il, ["invoice_id", "line_num"]).select("passed", F.col("duplicate_keys").alias("observed"))
    gn = Q.grain_not_null(il, ["invoice_id", "line_num"]).select("passed", F.col("null_keys").alias("observed"))
    fk = Q.fk_rate(il, S.invoice_header(t), "invoice_id", "invoice_id").select(
        (F.col("orphans") == 0).alias("passed"), F.col("orphans").alias("observed"))
    neg = il.agg(F.count_if(F.col("line_revenue") < 0).alias("observed")).withColumn("passed", F.col("observed") == 0)
    return Q.readiness([("grain_unique", gu), ("grain_not_null", gn), ("header_exists", fk),
                        ("amount_not_negative", neg)])


@query("profile_raw", """SELECT 'events' AS table_name, count(*) AS rows, count(*) FILTER (WHERE event_type = 'error') AS soft_deleted,
  max(ts) AS latest_sync FROM events
UNION ALL SELECT 'orders', count(*), 0, max(o_orderdate) FROM orders
UNION ALL SELECT 'lineitem', count(*), 0, max(l_shipdate) FROM lineitem""")
def profile_raw(t):
    """Rows, soft deletes and latest sync per raw table."""
    return (Q.profile(t.events, "events", F.col("event_type") == "error", "ts")
            .unionByName(Q.profile(t.orders, "orders", None, "o_orderdate"))
            .unionByName(Q.profile(t.lineitem, "lineitem", None, "l_shipdate")))


@query("layer_counts", sql("""SELECT 'raw.lineitem' AS layer_table, count(*) AS rows FROM lineitem
UNION ALL SELECT 'silver.invoice_line', count(*) FROM il
UNION ALL SELECT 'gold.fact_sales_invoice_line', count(*) FROM il JOIN ih ON il.invoice_id = ih.invoice_id""", "il", "ih"))
def layer_counts(t):
    """H1: row counts across layers."""
    return Q.layer_counts([("raw.lineitem", t.lineitem), ("silver.invoice_line", S.invoice_line(t)),
                           ("gold.fact_sales_invoice_line", G.fact_sales_invoice_line(t))])


cte("tw", "SELECT sales_id FROM so UNION ALL SELECT sales_id FROM so WHERE sales_id % 10 = 0", "so")


@query("fanout_check", sql("""SELECT (SELECT count(*) FROM il) AS rows_before,
  (SELECT count(*) FROM il JOIN tw ON il.invoice_id = tw.sales_id) AS rows_after,
  (SELECT CAST(sum(line_revenue) AS DOUBLE) FROM il) AS total_before,
  (SELECT CAST(sum(line_revenue) AS DOUBLE) FROM il JOIN tw ON il.invoice_id = tw.sales_id) AS total_after,
  (SELECT count(*) FROM il JOIN tw ON il.invoice_id = tw.sales_id) > (SELECT count(*) FROM il) AS fanout""", "il", "tw"))
def fanout_check(t):
    """Rows and revenue before / after joining the lines to order headers of which every tenth came twice."""
    il = S.invoice_line(t)
    so = S.sales_order(t).select("sales_id")
    so = so.unionByName(so.filter("sales_id % 10 = 0"))
    return joins.fanout_check(il, il.join(so, il.invoice_id == so.sales_id, "inner"), "line_revenue")
