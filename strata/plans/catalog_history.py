"""Named queries of the history / snapshot-grain operators (K1–K13) and as-of joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.keys import sha_key
from strata.operators import joins, periodic as PD
from strata.plans import feeds as FD
from strata.plans import silver as S
from strata.plans.catalog import dbl
from strata.plans.oracle import cte, skey, sql
from strata.plans.registry import query

# The milestone order.
MILESTONES = ["view", "click", "signup", "purchase"]


@query("asof_dimension", sql(f"""SELECT o.o_orderkey, o.o_custkey, CAST(o.o_orderdate AS DATE) AS order_date,
  {skey('a.nation_key', 'a.valid_from')} AS address_version_key, a.city, CAST(a.rate AS DOUBLE) AS rate
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN ah a ON a.nation_key = c.c_nationkey AND CAST(o.o_orderdate AS DATE) >= a.valid_from
  AND (a.valid_to IS NULL OR CAST(o.o_orderdate AS DATE) < a.valid_to)""", "ah"))
def asof_dimension(t):
    """Each order resolved to the address/rate version valid on its order date."""
    o = (t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))
         .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
         .drop("c_custkey"))
    h = S.address_history(t).select(F.col("nation_key").alias("h_nation"), "valid_from", "valid_to", "city", "rate")
    r = joins.resolve_version(o, h, ["c_nationkey"], ["h_nation"], at="order_date")
    return r.select("o_orderkey", "o_custkey", "order_date",
                    F.when(F.col("h_nation").isNotNull(), sha_key("h_nation", "valid_from")).alias("address_version_key"),
                    "city", "rate")


def _period(t):
    """The feed's first and last day, found when the query runs."""
    days = t.events.agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("b"))
    return days.select("a").scalar(), days.select("b").scalar()


_BALANCE = """WITH period AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events), mv AS (
  SELECT user_id, CAST(ts AS DATE) AS d,
    CASE WHEN event_type = 'purchase' THEN -abs(CAST(value AS DECIMAL(19,4))) ELSE CAST(value AS DECIMAL(19,4)) END AS amt
  FROM events),
daily AS (SELECT user_id, d, sum(amt) AS amt FROM mv GROUP BY 1, 2),
spine AS (SELECT k.user_id, CAST(s.d AS DATE) AS d FROM (SELECT DISTINCT user_id FROM daily) k,
  (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d FROM period) s)
SELECT user_id, balance_date, CAST(movement AS DOUBLE) AS movement, CAST(balance AS DOUBLE) AS balance FROM (
  SELECT s.user_id, s.d AS balance_date, coalesce(daily.amt, 0) AS movement,
    sum(coalesce(daily.amt, 0)) OVER (PARTITION BY s.user_id ORDER BY s.d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance
  FROM spine s LEFT JOIN daily ON s.user_id = daily.user_id AND s.d = daily.d) x"""


@query("daily_balance", _BALANCE)
def daily_balance(t):
    """K4: periodic snapshot — end-of-day balance per user over the feed period (purchases negative)."""
    mv = t.events.withColumn("amount", PD.signed(S.dec4("value"), F.col("event_type") == "purchase"))
    return PD.daily_balance(mv, "user_id", "ts", "amount", *_period(t))


@query("restated_balance", _BALANCE)
def restated_balance(t):
    """K9: the balance built without the first half's purchases, then restated with them as late rows; equal to a full rebuild."""
    mv = t.events.withColumn("amount", PD.signed(S.dec4("value"), F.col("event_type") == "purchase"))
    late = (F.col("ts") < F.lit(FD.CUT).cast("timestamp_ntz")) & (F.col("event_type") == "purchase")
    table = PD.daily_balance(mv.filter(~late), "user_id", "ts", "amount", *_period(t))
    return PD.restate(table, mv.filter(late), "user_id", "ts", "amount", *_period(t))


@query("accumulating_funnel", """SELECT user_id,
  min(ts) FILTER (WHERE event_type = 'view') AS first_view, min(ts) FILTER (WHERE event_type = 'click') AS first_click,
  min(ts) FILTER (WHERE event_type = 'signup') AS first_signup, min(ts) FILTER (WHERE event_type = 'purchase') AS first_purchase,
  datediff('day', CAST(min(ts) FILTER (WHERE event_type = 'view') AS DATE), CAST(min(ts) FILTER (WHERE event_type = 'click') AS DATE)) AS days_view_to_click,
  datediff('day', CAST(min(ts) FILTER (WHERE event_type = 'click') AS DATE), CAST(min(ts) FILTER (WHERE event_type = 'signup') AS DATE)) AS days_click_to_signup,
  datediff('day', CAST(min(ts) FILTER (WHERE event_type = 'signup') AS DATE), CAST(min(ts) FILTER (WHERE event_type = 'purchase') AS DATE)) AS days_signup_to_purchase
FROM events GROUP BY user_id""")
def accumulating_funnel(t):
    """K5: accumulating snapshot — milestone times per user and durations between them."""
    return PD.accumulating(t.events, "user_id", "ts", "event_type", MILESTONES)


@query("factless", """SELECT user_id, CAST(ts AS DATE) AS activity_date, event_type, count(*) AS occurrences
FROM events GROUP BY 1, 2, 3""")
def factless(t):
    """K6: factless fact — which user did which kind of activity on which day."""
    ev = t.events.withColumn("activity_date", F.to_date("ts"))
    return PD.factless(ev, ["user_id", "activity_date", "event_type"])


@query("net_activity", sql("""SELECT department AS return_flag_group,
  CAST(sum(CASE WHEN department <> 'R' THEN line_revenue ELSE 0 END) AS DOUBLE) AS gross,
  CAST(sum(CASE WHEN department = 'R' THEN -abs(line_revenue) ELSE 0 END) AS DOUBLE) AS reversals,
  CAST(sum(CASE WHEN department = 'R' THEN -abs(line_revenue) ELSE line_revenue END) AS DOUBLE) AS net,
  CAST(sum(CASE WHEN cost_center = 'O' THEN line_revenue ELSE 0 END) AS DOUBLE) AS unposted
FROM il GROUP BY 1""", "il"))
def net_activity(t):
    """K7 / K8: gross, reversal (opposite sign), net and unposted totals."""
    il = S.invoice_line(t)
    is_rev = F.col("department") == "R"
    s = PD.signed(F.col("line_revenue"), is_rev)
    return il.groupBy(F.col("department").alias("return_flag_group")).agg(
        F.sum(F.when(~is_rev, F.col("line_revenue")).otherwise(0)).alias("gross"),
        F.sum(F.when(is_rev, s).otherwise(0)).alias("reversals"),
        F.sum(s).alias("net"),
        F.sum(F.when(F.col("cost_center") == "O", F.col("line_revenue")).otherwise(0)).alias("unposted"))


@query("partitions_to_restate", f"""SELECT CAST(ts AS DATE) AS partition_date, count(*) AS late_rows
FROM events WHERE ts < TIMESTAMP '{FD.CUT}' AND event_type = 'purchase' GROUP BY 1""")
def partitions_to_restate(t):
    """K9: daily partitions touched by late-arriving rows (purchases dated before the cut, arriving with the batch)."""
    late = FD.first_half(t).filter(F.col("event_type") == "purchase").withColumn("partition_date", F.to_date("ts"))
    return PD.restate_scope(late, ["partition_date"])


@query("current_state", sql("SELECT * FROM live_all", "live_all"))
def current_state(t):
    """K1: current-state table of the feed (latest live row per key)."""
    from strata.operators import changes as CH
    return CH.live(FD.scd1_rebuild(t)).select(FD.KEY, *FD.PAYLOAD, CH.VERSION, CH.EFFECTIVE)


@query("append_events", f"""SELECT DISTINCT ON (event_id) * FROM (
  SELECT * FROM events WHERE ts < TIMESTAMP '{FD.CUT}'
  UNION ALL SELECT * FROM events WHERE ts >= TIMESTAMP '{FD.CUT}'
  UNION ALL SELECT * FROM events WHERE ts >= TIMESTAMP '{FD.CUT}') u""")
def append_events(t):
    """K2: append-only event table; a redelivered batch adds nothing (anti join on the event key)."""
    from strata.operators import history as HI
    table = t.events.filter(F.col("ts") < F.lit(FD.CUT).cast("timestamp_ntz"))
    batch = t.events.filter(F.col("ts") >= F.lit(FD.CUT).cast("timestamp_ntz"))
    once = HI.append_events(table, batch, "event_id")
    return HI.append_events(once, batch, "event_id")
