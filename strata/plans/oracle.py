"""Independent ANSI-SQL (DuckDB dialect) statements of every registered query.

These express the adopted semantics directly in SQL — windows, joins and
group-bys over the raw fixture views — and are used only to check the Spark
plans.  Shared building blocks are common table expressions; ``sql(...)``
assembles a statement from the blocks it needs.
"""

from __future__ import annotations

NULL_TOKEN = "\\N"


def _part(p: str) -> str:
    """A key part: every backslash and bar gets a backslash in front; NULL is the token."""
    return f"coalesce(regexp_replace({p}, '([\\\\|])', '\\\\\\1', 'g'), '{NULL_TOKEN}')"


def skey(*parts: str, upper: bool = True) -> str:
    """SQL text of the delimited SHA-256 key."""
    text = "upper(trim(CAST({} AS VARCHAR)))" if upper else "trim(CAST({} AS VARCHAR))"
    return "sha256(concat_ws('|', " + ", ".join(_part(text.format(p)) for p in parts) + "))"


def rhash(*parts: str) -> str:
    return "sha256(concat_ws('|', " + ", ".join(_part(f"CAST({p} AS VARCHAR)") for p in parts) + "))"


def dkey(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"


# name -> (sql body, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, deps)


def sql(final: str, *deps: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order) + "\n" + final


LINE_ORDER_SQL = ("l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, "
                  "l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, "
                  "l_tax DESC NULLS LAST, l_returnflag ASC NULLS FIRST, l_linestatus ASC NULLS FIRST")

# ---------------------------------------------------------------- silver
cte("cc", """SELECT c.c_custkey AS customer_account, n.n_regionkey AS company, c.c_nationkey AS nation_key
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")

cte("so", """SELECT o.o_orderkey AS sales_id, cc.company, cc.customer_account, cc.nation_key,
  CASE o.o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 WHEN 'F' THEN 3 END AS sales_status_code,
  CASE CASE o.o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 WHEN 'F' THEN 3 END
       WHEN 1 THEN 'Open' WHEN 2 THEN 'Delivered' WHEN 3 THEN 'Invoiced' WHEN 4 THEN 'Cancelled' END AS sales_status,
  CAST(o.o_orderdate AS DATE) AS order_date,
  CAST(o.o_orderdate AS DATE) + 30 AS delivery_date,
  split_part(o.o_orderpriority, '-', 1) AS delivery_mode_code,
  CAST(o.o_totalprice AS DECIMAL(19,4)) AS total_amount
FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderkey
        ORDER BY o_orderdate DESC NULLS LAST, o_totalprice DESC NULLS LAST) = 1) o
LEFT JOIN cc ON o.o_custkey = cc.customer_account""", "cc")

cte("li", f"""SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) = 1""")

cte("sl", """SELECT l_orderkey AS sales_id, l_linenumber AS line_num, l_partkey AS item_id, l_suppkey AS supplier_id,
  CAST(l_quantity AS DECIMAL(19,6)) AS sales_qty,
  l_extendedprice / l_quantity AS unit_price,
  CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * (1 - CAST(l_discount AS DECIMAL(19,4))) AS DECIMAL(19,4)) AS line_amount,
  CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(19,6)) ELSE CAST(0 AS DECIMAL(19,6)) END AS remain_qty_physical,
  CASE WHEN l_linestatus = 'O'
       THEN CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * (1 - CAST(l_discount AS DECIMAL(19,4))) AS DECIMAL(19,4))
       ELSE CAST(0 AS DECIMAL(19,4)) END AS remain_amount_financial,
  CAST(l_shipdate AS DATE) AS line_ship_date, l_returnflag, l_linestatus
FROM li""", "li")

cte("il", """SELECT l_orderkey AS invoice_id, l_linenumber AS line_num, l_partkey AS item_id, l_suppkey AS supplier_id,
  CAST(l_quantity AS DECIMAL(19,6)) AS invoiced_qty,
  l_extendedprice / l_quantity AS unit_price,
  CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * (1 - CAST(l_discount AS DECIMAL(19,4))) AS DECIMAL(19,4)) AS line_revenue,
  CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * CAST(l_discount AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS line_discount_amount,
  CAST(CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * (1 - CAST(l_discount AS DECIMAL(19,4))) AS DECIMAL(19,4))
       * CAST(l_tax AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS line_tax,
  CAST(l_shipdate AS DATE) AS ship_date, l_returnflag AS department, l_linestatus AS cost_center
FROM li""", "li")

cte("ih", """SELECT so.sales_id AS invoice_id, so.company, so.customer_account AS invoice_account, so.nation_key,
  so.order_date AS invoice_date, so.order_date + 30 AS due_date, so.total_amount AS invoice_amount,
  COALESCE(tax.total_tax, CAST(0 AS DECIMAL(19,4))) AS total_tax, so.sales_status
FROM so LEFT JOIN (SELECT invoice_id, CAST(SUM(line_tax) AS DECIMAL(19,4)) AS total_tax FROM il GROUP BY invoice_id) tax
  ON so.sales_id = tax.invoice_id""", "so", "il")

# the cost of a line is that of the delivery that survives; returned lines take no adjustment
cte("cpt", """SELECT l_orderkey AS trans_invoice_id, l_linenumber AS trans_line_num, l_partkey AS item_id,
  posted AS cost_amount_posted, adjusted AS cost_amount_adjustment,
  CAST(posted + adjusted AS DECIMAL(19,4)) AS total_cost, CAST(l_quantity AS DECIMAL(19,6)) AS inventory_qty
FROM (SELECT *, CAST(worth * CAST(0.7 AS DECIMAL(3,2)) AS DECIMAL(19,4)) AS posted,
        CASE WHEN l_returnflag IS DISTINCT FROM 'R' THEN CAST(worth * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(19,4)) ELSE 0 END AS adjusted
      FROM (SELECT li.*, CAST(p_retailprice AS DECIMAL(19,4)) * CAST(l_quantity AS DECIMAL(19,6)) AS worth
            FROM li, part WHERE p_partkey = l_partkey) priced) valued""", "li")

cte("ah", """SELECT n.n_nationkey AS nation_key, make_date(y.yr, 1, 1) AS valid_from, make_date(y.yr + 1, 1, 1) AS valid_to,
  'CITY-' || n.n_name || '-' || CAST(y.yr AS VARCHAR) AS city, n.n_name AS country, r.r_name AS region_name,
  CAST(1 + n.n_nationkey / 100 AS DECIMAL(10,4)) AS rate
FROM (SELECT c.c_nationkey, year(o.o_orderdate) AS yr FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
      GROUP BY c.c_nationkey, year(o.o_orderdate)) y
JOIN nation n ON y.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("cust", """SELECT c.c_custkey AS customer_account, cc.company, cc.nation_key, c.c_name AS customer_name,
  upper(trim(c.c_mktsegment)) AS customer_group, CAST(c.c_acctbal AS DECIMAL(19,4)) AS credit_limit,
  CASE WHEN c.c_acctbal < 0 THEN 'Blocked' ELSE 'No' END AS blocked_status
FROM (SELECT * FROM customer QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY c_acctbal DESC NULLS LAST) = 1) c
LEFT JOIN cc ON c.c_custkey = cc.customer_account""", "cc")

cte("party", """SELECT p.party_id, p.party_name, p.nation_key,
  CASE WHEN p.num % 2 = 0 THEN 'Person' WHEN p.num % 2 = 1 THEN 'Organization' ELSE 'Unknown' END AS party_type,
  CASE WHEN p.num % 2 = 0 THEN 'First ' || CAST(p.num AS VARCHAR) END AS first_name,
  CASE WHEN p.num % 2 = 1 THEN 'ORG-' || lpad(CAST(p.num AS VARCHAR), 6, '0') END AS organization_number
FROM (SELECT 'C' || CAST(c_custkey AS VARCHAR) AS party_id, c_name AS party_name, c_custkey AS num, c_nationkey AS nation_key FROM customer
      UNION ALL
      SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, s_suppkey, s_nationkey FROM supplier) p""")

cte("item", f"""SELECT p_partkey AS item_id, p_name AS product_name, 'P-' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS product_number,
  p_type AS item_group, {skey('p_type', 'p_brand')} AS category_id, p_size, CAST(p_retailprice AS DECIMAL(19,4)) AS list_price
FROM (SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY p_retailprice DESC NULLS LAST) = 1) p""")

cte("cat", f"""SELECT {skey('p_type', 'p_brand')} AS category_id, p_brand AS name, {skey('p_type')} AS parent_category_id
FROM part GROUP BY p_type, p_brand
UNION ALL
SELECT {skey('p_type')}, p_type, CAST(NULL AS VARCHAR) FROM part GROUP BY p_type""")

# ---------------------------------------------------------------- gold
cte("dim_customer", f"""SELECT {skey('cust.customer_account', 'cust.company')} AS customer_bk, cust.customer_account, cust.company,
  COALESCE(p.party_name, cust.customer_name) AS customer_name, p.party_type, p.organization_number,
  cust.customer_group, cust.credit_limit, cust.blocked_status,
  'Net 30' AS payment_term_description, 30 AS payment_net_days,
  a.city AS primary_city, a.country AS primary_country, a.region_name AS primary_region, TRUE AS is_current
FROM cust
LEFT JOIN party p ON 'C' || CAST(cust.customer_account AS VARCHAR) = p.party_id
LEFT JOIN (SELECT * FROM ah WHERE valid_from <= DATE '2001-08-31' AND (valid_to IS NULL OR DATE '2001-08-31' < valid_to)) a
  ON cust.nation_key = a.nation_key""", "cust", "party", "ah")

cte("dim_product", f"""SELECT {skey('i.item_id')} AS product_bk, i.item_id, i.product_number, i.product_name,
  i.item_group AS item_group_name, leaf.name AS product_category, par.name AS product_category_parent,
  CASE WHEN i.p_size >= 25 THEN 'Large' ELSE 'Standard' END AS product_type, TRUE AS is_current
FROM item i
LEFT JOIN cat leaf ON i.category_id = leaf.category_id
LEFT JOIN cat par ON leaf.parent_category_id = par.category_id""", "item", "cat")

cte("fin_rows", f"""SELECT combination_id, attribute_id, value FROM (
  SELECT {skey('l_returnflag', 'l_linestatus')} AS combination_id, l_returnflag, l_linestatus
  FROM lineitem GROUP BY l_returnflag, l_linestatus) c,
  LATERAL (VALUES (1, l_returnflag), (2, l_linestatus), (3, 'BU-' || l_returnflag || l_linestatus)) v(attribute_id, value)""")

cte("fin_dim", """SELECT combination_id,
  max(CASE WHEN attribute_name = 'Department' THEN value END) AS department,
  max(CASE WHEN attribute_name = 'CostCenter' THEN value END) AS cost_center,
  max(CASE WHEN attribute_name = 'BusinessUnit' THEN value END) AS business_unit
FROM (SELECT r.*, a.attribute_name FROM fin_rows r
      LEFT JOIN (VALUES (1, 'Department'), (2, 'CostCenter'), (3, 'BusinessUnit')) a(attribute_id, attribute_name)
      ON r.attribute_id = a.attribute_id) x
GROUP BY combination_id""", "fin_rows")

cte("dim_financial", """SELECT combination_id AS financial_dim_sk, department, cost_center, business_unit FROM fin_dim""", "fin_dim")

CAL_SQL = """SELECT {dk} AS date_key, d AS full_date, isodow(d) AS day_of_week, strftime(d, '%A') AS day_name,
  month(d) AS month_number, strftime(d, '%B') AS month_name, quarter(d) AS quarter, year(d) AS calendar_year,
  year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END AS fiscal_year,
  CAST(floor(((month(d) - 7 + 12) % 12) / 3) + 1 AS INTEGER) AS fiscal_quarter,
  CAST(((month(d) - 7 + 12) % 12) + 1 AS INTEGER) AS fiscal_period,
  strftime(d, '%m-%d') IN ('01-01', '07-04', '12-25') AS is_holiday"""

cte("dim_date", CAL_SQL.format(dk=dkey("d")) + """
FROM (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem) x) s""")

cte("dim_warehouse", f"""SELECT {skey('s.s_nationkey', 's.s_suppkey')} AS warehouse_sk, s.s_nationkey AS site_id,
  s.s_suppkey AS warehouse_id, n.n_regionkey AS company, count(*) AS line_count
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY s.s_nationkey, s.s_suppkey, n.n_regionkey""")

# one row per kept line with everything that the invoice fact and the wide table say about it, from the raw tables
cte("sold", """SELECT li.*, o_custkey, region_key, nation, day, order_total, net, duty,
  sum(duty) OVER (PARTITION BY l_orderkey) AS order_duty, s_nationkey AS site,
  coalesce((SELECT total_cost FROM cpt WHERE trans_invoice_id = l_orderkey AND trans_line_num = l_linenumber), 0) AS spent,
  (SELECT rate FROM ah WHERE nation_key = nation AND valid_from <= day AND (valid_to > day OR valid_to IS NULL)) AS fx
FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * (1 - CAST(l_discount AS DECIMAL(19,4))) AS DECIMAL(19,4)) AS net,
        CAST(CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * (1 - CAST(l_discount AS DECIMAL(19,4))) AS DECIMAL(19,4))
             * CAST(l_tax AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS duty FROM li) li
JOIN (SELECT arg_max(o_custkey, (o_orderdate, o_totalprice)) AS o_custkey, o_orderkey, max(CAST(o_orderdate AS DATE)) AS day,
        CAST(arg_max(o_totalprice, (o_orderdate, o_totalprice)) AS DECIMAL(19,4)) AS order_total FROM orders GROUP BY o_orderkey) ON o_orderkey = l_orderkey
LEFT JOIN (SELECT c_custkey, n_nationkey AS nation, n_regionkey AS region_key FROM customer JOIN nation ON n_nationkey = c_nationkey) ON c_custkey = o_custkey
LEFT JOIN supplier ON s_suppkey = l_suppkey""", "li", "cpt", "ah")

cte("fsil", f"""SELECT {skey('l_orderkey', 'l_linenumber', 'region_key')} AS invoice_line_sk, {skey('o_custkey', 'region_key')} AS customer_bk,
  {skey('l_partkey')} AS product_bk, {skey('l_returnflag', 'l_linestatus')} AS financial_dim_sk, {skey('site', 'l_suppkey')} AS warehouse_sk,
  {dkey('day')} AS invoice_date_key, l_orderkey AS invoice_number, l_linenumber AS line_number, l_orderkey AS sales_order_number,
  region_key AS company, o_custkey AS invoice_account, day AS invoice_date, CAST(l_quantity AS DECIMAL(19,6)) AS invoiced_qty,
  l_extendedprice / l_quantity AS unit_price, net AS line_revenue, CAST(net * fx AS DECIMAL(19,4)) AS line_revenue_mst,
  CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * CAST(l_discount AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS line_discount_amount,
  CAST(spent AS DECIMAL(19,4)) AS line_cost, CAST(net - spent AS DECIMAL(19,4)) AS gross_margin,
  coalesce(CAST(net AS DOUBLE) / nullif(CAST(order_total AS DOUBLE), 0) * CAST(CAST(order_duty AS DECIMAL(19,4)) AS DOUBLE), 0) AS allocated_tax
FROM sold""", "sold")

cte("obt", """SELECT s.l_orderkey AS invoice_number, s.l_linenumber AS line_number, s.l_orderkey AS sales_order_number, s.region_key AS company,
  CAST(s.l_quantity AS DECIMAL(19,6)) AS invoiced_qty, s.l_extendedprice / s.l_quantity AS unit_price,
  s.net AS line_revenue, CAST(s.net * s.fx AS DECIMAL(19,4)) AS line_revenue_mst, CAST(s.spent AS DECIMAL(19,4)) AS line_cost,
  CAST(s.net - s.spent AS DECIMAL(19,4)) AS gross_margin,
  CAST(CAST(s.l_extendedprice AS DECIMAL(19,4)) * CAST(s.l_discount AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS line_discount_amount,
  coalesce(CAST(s.net AS DOUBLE) / nullif(CAST(s.order_total AS DOUBLE), 0) * CAST(CAST(s.order_duty AS DECIMAL(19,4)) AS DOUBLE), 0) AS allocated_tax,
  coalesce(round(CAST(s.net - s.spent AS DOUBLE) / nullif(CAST(s.net AS DOUBLE), 0) * 100, 2), 0) AS gross_margin_pct,
  c.customer_account, c.customer_name, c.customer_group, c.primary_city, c.primary_country, c.credit_limit, c.payment_term_description,
  i.item_id, i.product_number, i.item_group_name, i.product_category, i.product_category_parent, i.product_type,
  s.l_returnflag AS department, s.l_linestatus AS cost_center, 'BU-' || s.l_returnflag || s.l_linestatus AS business_unit,
  s.day AS invoice_date, d.fiscal_year, d.fiscal_quarter, d.fiscal_period, d.month_name, d.calendar_year, s.site AS site_id,
  CASE WHEN s.site IS NOT NULL THEN s.l_suppkey END AS warehouse_id
FROM sold s
LEFT JOIN dim_customer c ON c.customer_account = s.o_custkey AND c.company IS NOT DISTINCT FROM s.region_key
LEFT JOIN dim_product i ON i.item_id = s.l_partkey
LEFT JOIN dim_date d ON d.full_date = s.day""", "sold", "dim_customer", "dim_product", "dim_date")
