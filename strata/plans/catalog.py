"""Named queries: each key binds a Spark plan to its SQL statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans import gold as G
from strata.plans import silver as S
from strata.plans.oracle import sql
from strata.plans.registry import query


def dbl(select: str, *cols: str) -> str:
    """Final SELECT with the named (decimal) columns presented as DOUBLE."""
    if not cols:
        return select
    rep = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{select}\n) q"


# ------------------------------------------------------------------ silver
query("silver_sales_order", sql(dbl("SELECT * FROM so", "total_amount"), "so"))(S.sales_order)
query("silver_sales_line", sql(dbl("SELECT * FROM sl", "sales_qty", "line_amount", "remain_qty_physical",
                                   "remain_amount_financial"), "sl"))(S.sales_line)
query("silver_invoice_header", sql(dbl("SELECT * FROM ih", "invoice_amount", "total_tax"), "ih"))(S.invoice_header)
query("silver_invoice_line", sql(dbl("SELECT * FROM il", "invoiced_qty", "line_revenue", "line_discount_amount",
                                     "line_tax"), "il"))(S.invoice_line)
query("cost_per_trans", sql(dbl("SELECT * FROM cpt", "cost_amount_posted", "cost_amount_adjustment", "total_cost",
                                "inventory_qty"), "cpt"))(S.cost_per_trans)
query("silver_customer", sql(dbl("SELECT * FROM cust", "credit_limit"), "cust"))(S.customer)
query("party_subtypes", sql("SELECT * FROM party", "party"))(S.party)
query("silver_address", sql(dbl("SELECT * FROM ah", "rate"), "ah"))(S.address_history)
query("silver_item", sql(dbl("SELECT * FROM item", "list_price"), "item"))(S.item)

# ------------------------------------------------------------------ gold
query("dim_customer", sql(dbl("SELECT * FROM dim_customer", "credit_limit"), "dim_customer"))(G.dim_customer)
query("dim_product", sql("SELECT * FROM dim_product", "dim_product"))(G.dim_product)
query("eav_pivot", sql("SELECT * FROM fin_dim", "fin_dim"))(G.financial_dimension)
query("dim_financial", sql("SELECT * FROM dim_financial", "dim_financial"))(G.dim_financial)
query("dim_date", sql("SELECT * FROM dim_date", "dim_date"))(G.dim_date)
query("dim_warehouse", sql("SELECT * FROM dim_warehouse", "dim_warehouse"))(G.dim_warehouse)
query("fact_sales_invoice_line", sql(dbl("SELECT * FROM fsil", "invoiced_qty", "line_revenue", "line_revenue_mst",
                                         "line_discount_amount", "line_cost", "gross_margin"), "fsil"))(G.fact_sales_invoice_line)
query("obt_revenue", sql(dbl("SELECT * FROM obt", "invoiced_qty", "line_revenue", "line_revenue_mst", "line_cost",
                             "gross_margin", "line_discount_amount", "credit_limit"), "obt"))(G.obt_revenue)

from strata.plans import catalog_changes  # noqa: E402,F401
from strata.plans import catalog_quality  # noqa: E402,F401
from strata.plans import catalog_marts  # noqa: E402,F401
from strata.plans import catalog_history  # noqa: E402,F401
from strata.plans import catalog_silver  # noqa: E402,F401
from strata.plans import catalog_control  # noqa: E402,F401
from strata.plans import catalog_resolve  # noqa: E402,F401
from strata.plans import catalog_matching  # noqa: E402,F401
from strata.plans import worked_example  # noqa: E402,F401
from strata.plans import catalog_standard  # noqa: E402,F401
