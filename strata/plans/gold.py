"""Gold layer: conformed dimensions, facts and the one-big-table.

Dimensions are keyed by a durable business key (delimited SHA-256); facts
carry the business keys and resolve dimension rows by key (current rows) or
by date (as-of, ``strata.operators.joins.resolve_version``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import decode
from strata.functions.keys import date_key, sha_key
from strata.operators import joins
from strata.plans import silver as S

# Fixed values of the model.
AS_OF = "2001-08-31"           # reporting as-of date of the fixture
FISCAL_START_MONTH = 7         # fiscal year starts on 1 July, named by its end year
HOLIDAYS_MMDD = ("01-01", "07-04", "12-25")
PAYMENT_TERM_DESCRIPTION = "Net 30"


def _as_of():
    return F.lit(AS_OF).cast("date")


def dim_customer(t) -> DataFrame:
    """Customer + party + address valid at the as-of date (D6 bridge, D8)."""
    c = S.customer(t)
    p = S.party(t).select("party_id", "party_type", "organization_number", F.col("party_name").alias("p_name"))
    addr = joins.valid_at(S.address_history(t), _as_of()).select(
        F.col("nation_key").alias("a_nation"), F.col("city").alias("primary_city"),
        F.col("country").alias("primary_country"), F.col("region_name").alias("primary_region"))
    return (c.join(p, F.concat(F.lit("C"), c.customer_account.cast("string")) == p.party_id, "left")
            .join(addr, F.col("nation_key") == F.col("a_nation"), "left")
            .select(
                sha_key("customer_account", "company").alias("customer_bk"),
                "customer_account", "company",
                F.coalesce("p_name", "customer_name").alias("customer_name"),
                "party_type", "organization_number", "customer_group", "credit_limit", "blocked_status",
                F.lit(PAYMENT_TERM_DESCRIPTION).alias("payment_term_description"),
                F.lit(S.PAYMENT_DAYS).alias("payment_net_days"),
                "primary_city", "primary_country", "primary_region",
                F.lit(True).alias("is_current"),
            ))


def dim_product(t) -> DataFrame:
    """Item + category + parent category (D1, D7 self join one level up)."""
    i = S.item(t)
    cat = S.category(t)
    leaf = cat.select(F.col("category_id").alias("leaf_id"), F.col("name").alias("product_category"),
                      F.col("parent_category_id").alias("leaf_parent"))
    parent = cat.select(F.col("category_id").alias("parent_id"), F.col("name").alias("product_category_parent"))
    return (i.join(leaf, i.category_id == leaf.leaf_id, "left")
            .join(parent, F.col("leaf_parent") == F.col("parent_id"), "left")
            .select(sha_key("item_id").alias("product_bk"), "item_id", "product_number", "product_name",
                    F.col("item_group").alias("item_group_name"), "product_category", "product_category_parent",
                    F.when(F.col("p_size") >= 25, "Large").otherwise("Standard").alias("product_type"),
                    F.lit(True).alias("is_current")))


def financial_attribute_rows(t) -> DataFrame:
    """EAV source: one row per (combination, attribute value) from the line flags."""
    combos = (t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("_n"))
              .select(sha_key("l_returnflag", "l_linestatus").alias("combination_id"), "l_returnflag", "l_linestatus"))
    return combos.select("combination_id", F.inline(F.array(
        F.struct(F.lit(1).alias("attribute_id"), F.col("l_returnflag").alias("value")),
        F.struct(F.lit(2).alias("attribute_id"), F.col("l_linestatus").alias("value")),
        F.struct(F.lit(3).alias("attribute_id"),
                 F.concat(F.lit("BU-"), F.col("l_returnflag"), F.col("l_linestatus")).alias("value")))))


# Attribute names of the dimension set.
FINANCIAL_ATTRIBUTES = {1: "Department", 2: "CostCenter", 3: "BusinessUnit"}


def financial_dimension(t) -> DataFrame:
    """Attribute rows joined to attribute names, pivoted by conditional max."""
    rows = financial_attribute_rows(t)
    named = rows.withColumn("attribute_name", decode(F.col("attribute_id"), FINANCIAL_ATTRIBUTES))
    return (named.groupBy("combination_id")
            .agg(F.max(F.when(F.col("attribute_name") == "Department", F.col("value"))).alias("department"),
                 F.max(F.when(F.col("attribute_name") == "CostCenter", F.col("value"))).alias("cost_center"),
                 F.max(F.when(F.col("attribute_name") == "BusinessUnit", F.col("value"))).alias("business_unit")))


def dim_financial(t) -> DataFrame:
    """Financial dimension keyed by its combination."""
    return financial_dimension(t).select(F.col("combination_id").alias("financial_dim_sk"),
                                         "department", "cost_center", "business_unit")


def date_rows(first: F.Column, last: F.Column, source: DataFrame) -> DataFrame:
    """Daily spine ``[first, last]`` from a one-row aggregate of ``source``."""
    bounds = source.agg(first.alias("_first"), last.alias("_last"))
    return bounds.select(F.explode(F.sequence("_first", "_last")).alias("full_date"))


def calendar_columns(d: str) -> dict:
    """Calendar attributes of a date column."""
    m = F.month(d)
    shifted = (m - F.lit(FISCAL_START_MONTH) + 12) % 12  # 0 = first fiscal month
    return {
        "day_of_week": F.weekday(d) + 1, "day_name": F.date_format(d, "EEEE"),
        "month_number": m, "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d), "calendar_year": F.year(d),
        "fiscal_year": F.year(d) + F.when(m >= FISCAL_START_MONTH, 1).otherwise(0),
        "fiscal_quarter": (F.floor(shifted / 3) + 1).cast("int"),
        "fiscal_period": (shifted + 1).cast("int"),
        "is_holiday": F.date_format(d, "MM-dd").isin(*HOLIDAYS_MMDD),
    }


def calendar(df: DataFrame, d: str = "full_date") -> DataFrame:
    return df.select(date_key(d).alias("date_key"), F.col(d).alias("full_date"),
                     *(c.alias(n) for n, c in calendar_columns(d).items()))


def dim_date(t) -> DataFrame:
    """Calendar for every day between the first order and the last shipment."""
    days = (t.orders.select(F.to_date("o_orderdate").alias("d"))
            .unionByName(t.lineitem.select(F.to_date("l_shipdate").alias("d"))))
    return calendar(date_rows(F.min("d"), F.max("d"), days))


def dim_delivery_mode(t) -> DataFrame:
    """Delivery modes from the priority codes (``n-NAME``)."""
    return (t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("_n"))
            .select(sha_key(F.split("o_orderpriority", "-", 2).getItem(0)).alias("delivery_mode_sk"),
                    F.split("o_orderpriority", "-", 2).getItem(0).alias("delivery_mode_code"),
                    F.split("o_orderpriority", "-", 2).getItem(1).alias("delivery_mode_name")))


def warehouse_of_lines(t) -> DataFrame:
    """(site, warehouse) pairs used by lines: site = supplier nation, warehouse = supplier."""
    return t.supplier.select(F.col("s_suppkey").alias("warehouse_id"), F.col("s_nationkey").alias("site_id"))


def dim_warehouse(t) -> DataFrame:
    """Warehouse dimension as the distinct (site, warehouse, company) key set."""
    li = t.lineitem.select("l_suppkey")
    s = warehouse_of_lines(t)
    nation = t.nation.select("n_nationkey", F.col("n_regionkey").alias("company"))
    return (li.join(s, li.l_suppkey == s.warehouse_id, "inner")
            .join(nation, F.col("site_id") == F.col("n_nationkey"), "left")
            .groupBy("site_id", "warehouse_id", "company").agg(F.count(F.lit(1)).alias("line_count"))
            .select(sha_key("site_id", "warehouse_id").alias("warehouse_sk"), "site_id", "warehouse_id", "company",
                    "line_count"))


def dim_sales_rep(t) -> DataFrame:
    """Suppliers as workers, name from the party table (D1 lookup)."""
    p = S.party(t).select("party_id", "party_name")
    nation = t.nation.select("n_nationkey", F.col("n_regionkey").alias("company"))
    w = t.supplier.select("s_suppkey", "s_nationkey")
    return (w.join(p, F.concat(F.lit("S"), F.col("s_suppkey").cast("string")) == F.col("party_id"), "left")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select(sha_key("s_suppkey", "company").alias("sales_rep_sk"),
                    F.col("s_suppkey").alias("personnel_number"),
                    F.col("party_name").alias("sales_rep_name"), "company"))


def fact_sales_order_line(t) -> DataFrame:
    """Order lines with delivered quantity, promise variance and three date keys (computed from the source's columns after the joins)."""
    so = S.sales_order(t).select(F.col("sales_id").alias("h_sales_id"), "company", "customer_account",
                                  "sales_status", "order_date", "delivery_date", "delivery_mode_code")
    wh = warehouse_of_lines(t)
    return (S._line_base(t).join(so, F.col("l_orderkey") == F.col("h_sales_id"), "inner")
            .join(wh, F.col("l_suppkey") == F.col("warehouse_id"), "left")
            .select(*S.sales_columns(), *so.columns, *wh.columns)
            .select(
                sha_key("sales_id", "line_num", "company").alias("sales_line_sk"),
                sha_key("customer_account", "company").alias("customer_bk"),
                sha_key("item_id").alias("product_bk"),
                sha_key("delivery_mode_code").alias("delivery_mode_sk"),
                sha_key("site_id", "warehouse_id").alias("warehouse_sk"),
                date_key("order_date").alias("order_date_key"),
                date_key("delivery_date").alias("promised_delivery_date_key"),
                date_key("line_ship_date").alias("requested_ship_date_key"),
                F.col("sales_id").alias("sales_order_number"),
                F.col("line_num").alias("line_number"),
                "company", "customer_account",
                F.col("sales_status").alias("order_status"),
                "sales_qty", "unit_price", "line_amount", "remain_qty_physical", "remain_amount_financial",
                (F.col("sales_qty") - F.col("remain_qty_physical")).cast("decimal(19,6)").alias("delivered_qty"),
                F.datediff("line_ship_date", "delivery_date").alias("days_variance_to_promise"),
            ))


def invoice_lines_in_full(t, customers: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """Kept invoice lines with their header, cost (of the kept delivery), site and accounting rate, on natural keys.

    Lines and headers lie by order and meet there; only their keys go to parts and customers and come back with what was
    found (rates and ``customers``, keyed by c_account and c_company, with the headers; ``products``, keyed by p_item, beside the
    price).  Lines of orders too large for one task take another way to the same rows.  Lines keep the source's columns until
    their last join.
    """
    # one rate per nation and calendar year: bounded by construction
    rates = S.address_history(t).select(F.col("nation_key").alias("r_nation"), "valid_from", "valid_to", "rate")
    header = joins.resolve_version(S.untaxed_header(t, customers), F.broadcast(rates), ["nation_key"], ["r_nation"], at="invoice_date")
    near, crowded, _ = S.lines_apart(t)     # lines without an order have no header
    lines = S.taxed_lines_together(t, near, products).join(header, F.col("l_orderkey") == F.col("h_invoice_id"))
    if crowded is not None:
        lines = lines.unionByName(S.taxed_lines_apart(t, crowded, products).join(header, F.col("l_orderkey") == F.col("h_invoice_id")))
    wh = warehouse_of_lines(t)
    more = [] if products is None else products.columns
    base = (lines.join(wh, F.col("l_suppkey") == F.col("warehouse_id"), "left")
            .withColumns({**S.cost_columns(), "total_tax": F.coalesce("total_tax", F.lit(0).cast("decimal(19,4)"))})
            .select(*S.invoice_columns(), (F.col("posted") + F.col("adjustment")).cast("decimal(19,4)").alias("total_cost"), "total_tax", *header.columns, *wh.columns, *more))
    cost = F.coalesce("total_cost", F.lit(0).cast("decimal(19,4)"))
    share = F.col("line_revenue").cast("double") / F.col("invoice_amount").cast("double")
    return (base.withColumn("line_cost", cost)
            .withColumn("line_revenue_mst", (F.col("line_revenue") * F.col("rate")).cast("decimal(19,4)"))
            .withColumn("gross_margin", (F.col("line_revenue") - cost).cast("decimal(19,4)"))
            .withColumn("allocated_tax", F.when(F.col("invoice_amount") != 0, share * F.col("total_tax").cast("double")).otherwise(F.lit(0.0))))


def fact_sales_invoice_line(t) -> DataFrame:
    """Invoice lines with cost (E1), margin, allocated tax (E11) and accounting-currency revenue."""
    return invoice_lines_in_full(t).select(
        sha_key("invoice_id", "line_num", "company").alias("invoice_line_sk"),
        sha_key("invoice_account", "company").alias("customer_bk"),
        sha_key("item_id").alias("product_bk"),
        sha_key("department", "cost_center").alias("financial_dim_sk"),
        sha_key("site_id", F.col("supplier_id")).alias("warehouse_sk"),
        date_key("invoice_date").alias("invoice_date_key"),
        F.col("invoice_id").alias("invoice_number"), F.col("line_num").alias("line_number"),
        F.col("invoice_id").alias("sales_order_number"), "company", "invoice_account", "invoice_date",
        "invoiced_qty", "unit_price", "line_revenue", "line_revenue_mst", "line_discount_amount",
        "line_cost", "gross_margin", "allocated_tax")


def obt_revenue(t) -> DataFrame:
    """Invoice lines flattened with current customer and product rows.

    Joined on natural keys; calendar, financial and warehouse attributes are functions of columns that the lines have.
    """
    customers = dim_customer(t).filter("is_current").select(
        F.col("company").alias("c_company"), F.col("customer_account").alias("c_account"), "customer_name", "customer_group",
        "primary_city", "primary_country", "credit_limit", "payment_term_description")
    products = dim_product(t).filter("is_current").select(
        F.col("item_id").alias("p_item"), "product_number", "item_group_name", "product_category", "product_category_parent", "product_type")
    lines = invoice_lines_in_full(t, customers, products)
    percent = F.round(F.col("gross_margin").cast("double") / F.col("line_revenue").cast("double") * 100, 2)
    days = calendar_columns("invoice_date")
    return lines.select(
        F.col("invoice_id").alias("invoice_number"), F.col("line_num").alias("line_number"), F.col("invoice_id").alias("sales_order_number"), "company",
        "invoiced_qty", "unit_price", "line_revenue", "line_revenue_mst", "line_cost", "gross_margin", "line_discount_amount", "allocated_tax",
        F.when(F.col("line_revenue") != 0, percent).otherwise(F.lit(0.0)).alias("gross_margin_pct"),
        F.col("c_account").alias("customer_account"), "customer_name", "customer_group", "primary_city", "primary_country", "credit_limit", "payment_term_description",
        F.col("p_item").alias("item_id"), "product_number", "item_group_name", "product_category", "product_category_parent", "product_type",
        "department", "cost_center", F.concat(F.lit("BU-"), "department", "cost_center").alias("business_unit"), "invoice_date",
        *(days[n].alias(n) for n in ("fiscal_year", "fiscal_quarter", "fiscal_period", "month_name", "calendar_year")), "site_id", "warehouse_id")
