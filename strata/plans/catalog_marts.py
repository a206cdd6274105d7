"""Named queries: remaining dimensions / facts, marts and the business questions."""

from __future__ import annotations

from strata.plans import gold as G
from strata.plans import marts as MT
from strata.plans.catalog import dbl
from strata.plans.oracle import cte, dkey, skey, sql
from strata.plans.registry import query

cte("fsol", f"""SELECT {skey('sl.sales_id', 'sl.line_num', 'so.company')} AS sales_line_sk,
  {skey('so.customer_account', 'so.company')} AS customer_bk, {skey('sl.item_id')} AS product_bk,
  {skey('so.delivery_mode_code')} AS delivery_mode_sk, {skey('s.s_nationkey', 's.s_suppkey')} AS warehouse_sk,
  {dkey('so.order_date')} AS order_date_key, {dkey('so.delivery_date')} AS promised_delivery_date_key,
  {dkey('sl.line_ship_date')} AS requested_ship_date_key,
  sl.sales_id AS sales_order_number, sl.line_num AS line_number, so.company, so.customer_account,
  so.sales_status AS order_status, sl.sales_qty, sl.unit_price, sl.line_amount, sl.remain_qty_physical,
  sl.remain_amount_financial, CAST(sl.sales_qty - sl.remain_qty_physical AS DECIMAL(19,6)) AS delivered_qty,
  datediff('day', so.delivery_date, sl.line_ship_date) AS days_variance_to_promise
FROM sl JOIN so ON sl.sales_id = so.sales_id LEFT JOIN supplier s ON sl.supplier_id = s.s_suppkey""", "sl", "so")

cte("f_cd", """SELECT f.*, dc.customer_account, dc.customer_name, dd.fiscal_year, dd.fiscal_quarter, dd.calendar_year
FROM fsil f LEFT JOIN (SELECT * FROM dim_customer WHERE is_current) dc ON f.customer_bk = dc.customer_bk
LEFT JOIN dim_date dd ON f.invoice_date_key = dd.date_key""", "fsil", "dim_customer", "dim_date")

cte("mbp", """SELECT dp.item_id, dp.product_number, sum(f.line_revenue) AS revenue, sum(f.gross_margin) AS gross_margin,
  round(CAST(sum(f.gross_margin) AS DOUBLE) / CAST(CASE WHEN sum(f.line_revenue) <> 0 THEN sum(f.line_revenue) END AS DOUBLE) * 100.0, 2)
    AS gross_margin_pct
FROM fsil f LEFT JOIN (SELECT * FROM dim_product WHERE is_current) dp ON f.product_bk = dp.product_bk
GROUP BY dp.item_id, dp.product_number""", "fsil", "dim_product")

cte("acc", """SELECT ts AS event_time, user_id AS user_name, event_type AS action_name,
  'gold.table_' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS table_full_name,
  CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50 AS is_protected FROM events""")

query("dim_delivery_mode", sql(f"""SELECT {skey("split_part(o_orderpriority, '-', 1)")} AS delivery_mode_sk,
  split_part(o_orderpriority, '-', 1) AS delivery_mode_code, split_part(o_orderpriority, '-', 2) AS delivery_mode_name
FROM orders GROUP BY o_orderpriority"""))(G.dim_delivery_mode)

query("dim_sales_rep", sql(f"""SELECT {skey('s.s_suppkey', 'n.n_regionkey')} AS sales_rep_sk, s.s_suppkey AS personnel_number,
  p.party_name AS sales_rep_name, n.n_regionkey AS company
FROM supplier s LEFT JOIN party p ON 'S' || CAST(s.s_suppkey AS VARCHAR) = p.party_id
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""", "party"))(G.dim_sales_rep)

query("fact_sales_order_line", sql(dbl("SELECT * FROM fsol", "sales_qty", "line_amount", "remain_qty_physical",
                                       "remain_amount_financial", "delivered_qty"), "fsol"))(G.fact_sales_order_line)

query("revenue_by_customer_quarter", sql("""SELECT customer_account, customer_name, fiscal_year, fiscal_quarter,
  CAST(sum(line_revenue_mst) AS DOUBLE) AS revenue_mst, count(*) AS lines
FROM f_cd GROUP BY 1, 2, 3, 4""", "f_cd"))(MT.revenue_by_customer_quarter)

query("margin_pct_by_product", sql(dbl("SELECT * FROM mbp", "revenue", "gross_margin"), "mbp"))(MT.margin_by_product)

query("top10_margin_products", sql(dbl("""SELECT * FROM mbp ORDER BY gross_margin_pct DESC NULLS LAST, item_id ASC
LIMIT 10""", "revenue", "gross_margin"), "mbp"))(MT.top10_margin_products)

query("revenue_by_dimension", sql("""SELECT fd.department, fd.cost_center, CAST(sum(f.line_revenue_mst) AS DOUBLE) AS revenue_mst
FROM fsil f LEFT JOIN dim_financial fd ON f.financial_dim_sk = fd.financial_dim_sk GROUP BY 1, 2""",
                                  "fsil", "dim_financial"))(MT.revenue_by_dimension)

query("company_rollup", sql("""SELECT company, calendar_year, CAST(sum(line_revenue_mst) AS DOUBLE) AS revenue_mst,
  count(*) AS lines FROM f_cd GROUP BY ROLLUP (company, calendar_year)""", "f_cd"))(MT.company_rollup)

query("open_backlog", sql("""SELECT customer_account, CAST(sum(remain_amount_financial) AS DOUBLE) AS backlog_amount,
  CAST(sum(remain_qty_physical) AS DOUBLE) AS backlog_qty, count(*) AS open_lines
FROM fsol WHERE order_status = 'Open' GROUP BY 1""", "fsol"))(MT.open_backlog)

query("on_time_pct", sql("""SELECT company, count(*) AS lines, count(*) FILTER (WHERE days_variance_to_promise <= 0) AS on_time_lines,
  round(CAST(count(*) FILTER (WHERE days_variance_to_promise <= 0) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0, 2) AS on_time_pct
FROM fsol GROUP BY 1""", "fsol"))(MT.on_time_pct)

query("revenue_vs_cost_by_category", sql("""SELECT dp.product_category_parent, dp.product_category,
  CAST(sum(f.line_revenue_mst) AS DOUBLE) AS revenue_mst, CAST(sum(f.line_cost) AS DOUBLE) AS cost,
  CAST(sum(f.gross_margin) AS DOUBLE) AS gross_margin
FROM fsil f LEFT JOIN (SELECT * FROM dim_product WHERE is_current) dp ON f.product_bk = dp.product_bk
GROUP BY 1, 2""", "fsil", "dim_product"))(MT.revenue_vs_cost_by_category)

query("credit_exposure", sql("""SELECT dc.customer_account, dc.customer_name, CAST(dc.credit_limit AS DOUBLE) AS credit_limit,
  CAST(o.open_amount AS DOUBLE) AS open_amount, CAST(CAST(o.open_amount - dc.credit_limit AS DECIMAL(19,4)) AS DOUBLE) AS exposure,
  o.open_amount > dc.credit_limit AS over_limit
FROM (SELECT * FROM dim_customer WHERE is_current) dc
JOIN (SELECT customer_account, sum(total_amount) AS open_amount FROM so WHERE sales_status_code = 1 GROUP BY 1) o
  ON dc.customer_account = o.customer_account""", "dim_customer", "so"))(MT.credit_exposure)

query("ar_aging", sql(f"""SELECT customer_account,
  CASE WHEN d <= 0 THEN 'current' WHEN d <= 30 THEN '1-30' WHEN d <= 60 THEN '31-60' WHEN d <= 90 THEN '61-90' ELSE '90+' END AS bucket,
  CAST(sum(total_amount) AS DOUBLE) AS open_amount, count(*) AS items
FROM (SELECT customer_account, total_amount, datediff('day', order_date + 30, DATE '{G.AS_OF}') AS d FROM so
      WHERE order_date <= DATE '{G.AS_OF}'
        AND (sales_status_code <> 3 OR order_date + 30 > DATE '{G.AS_OF}')) x
GROUP BY 1, 2""", "so"))(MT.ar_aging)

query("agg_sales_monthly", sql("""SELECT strftime(order_date, '%Y-%m') AS order_month, sales_status, count(*) AS order_count,
  CAST(sum(total_amount) AS DOUBLE) AS total_amount,
  CAST(sum(total_amount) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_order_amount,
  count(DISTINCT customer_account) AS distinct_customers
FROM so GROUP BY 1, 2""", "so"))(MT.sales_monthly)

query("access_top", sql("""SELECT table_full_name, count(*) AS access_count, count(DISTINCT user_name) AS distinct_users
FROM acc GROUP BY 1 ORDER BY access_count DESC, table_full_name ASC LIMIT 10""", "acc"))(MT.access_top)

query("protected_writes", sql("""SELECT event_time, user_name, action_name, table_full_name FROM acc
WHERE is_protected AND action_name IN ('purchase', 'signup')""", "acc"))(MT.protected_writes)

query("recent_reads", sql(f"""SELECT table_full_name, count(*) AS reads, count(DISTINCT user_name) AS readers FROM acc
WHERE action_name IN ('view', 'click') AND event_time >= TIMESTAMP '{MT.ACCESS_NOW}' - INTERVAL {MT.RECENT_DAYS} DAY
GROUP BY 1""", "acc"))(MT.recent_reads)

query("semi_additive_balance", """SELECT period, CAST(sum(last_balance) AS DOUBLE) AS balance FROM (
  SELECT user_id, CAST(ts AS DATE) AS period, arg_max(CAST(value AS DECIMAL(19,4)), (ts, event_id)) AS last_balance
  FROM events GROUP BY 1, 2) x GROUP BY 1""")(MT.semi_additive_balance)

query("ledger_by_layer", sql("""SELECT CASE WHEN line_cost > 0 THEN 'Posted' ELSE 'Unposted' END AS posting_layer,
  'CUR-' || CAST(company AS VARCHAR) AS currency, CAST(sum(line_revenue_mst) AS DOUBLE) AS line_revenue_mst
FROM fsil GROUP BY 1, 2""", "fsil"))(MT.ledger_by_layer)
