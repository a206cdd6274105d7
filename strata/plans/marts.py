"""Gold marts and the business questions, each from the fact and only the
dimensions it needs (a left join to an unused dimension is not free)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import marts as M
from strata.plans import gold as G
from strata.plans import silver as S

# Fixed values.
TOP_N = 10
ACCESS_NOW = "2024-02-01 00:00:00"
RECENT_DAYS = 7
WRITE_ACTIONS = ("purchase", "signup")
READ_ACTIONS = ("view", "click")
PROTECTED_FROM_K = 50    # objects gold.table_<k> with k >= 50 are the protected layer


def current_products(t) -> DataFrame:
    return G.dim_product(t).filter("is_current").select(F.col("item_id").alias("p_item"), "product_number", "product_category", "product_category_parent")


def fact_with_customer_date(t) -> DataFrame:
    """Invoice lines with their current customer and calendar, joined on the source's own keys; the calendar is a function of the date."""
    dc = G.dim_customer(t).filter("is_current").select(F.col("company").alias("c_company"), "customer_account", "customer_name")
    f = G.invoice_lines_in_full(t)
    days = G.calendar_columns("invoice_date")
    return (f.join(dc, (f.invoice_account == dc.customer_account) & f.company.eqNullSafe(dc.c_company), "left")
            .withColumns({c: days[c] for c in ("fiscal_year", "fiscal_quarter", "calendar_year")}))


def revenue_by_customer_quarter(t) -> DataFrame:
    f = fact_with_customer_date(t)
    return (f.groupBy("customer_account", "customer_name", "fiscal_year", "fiscal_quarter")
            .agg(F.sum("line_revenue_mst").alias("revenue_mst"), F.count(F.lit(1)).alias("lines")))


def margin_by_product(t) -> DataFrame:
    f = G.invoice_lines_in_full(t).withColumnRenamed("item_id", "line_item")
    g = (f.join(current_products(t), F.col("line_item") == F.col("p_item"), "left").groupBy(F.col("p_item").alias("item_id"), "product_number")
         .agg(F.sum("line_revenue").alias("revenue"), F.sum("gross_margin").alias("gross_margin")))
    return g.withColumn("gross_margin_pct", M.ratio(F.col("gross_margin"), F.col("revenue"), 2, 100.0))


def top10_margin_products(t) -> DataFrame:
    return M.top_n(margin_by_product(t), TOP_N, [F.col("gross_margin_pct").desc_nulls_last(), F.col("item_id").asc()])


def revenue_by_dimension(t) -> DataFrame:
    """The dimension's rows are the combinations that the lines hold, so the lines' own columns say it."""
    return (G.invoice_lines_in_full(t).groupBy("department", "cost_center")
            .agg(F.sum("line_revenue_mst").alias("revenue_mst")))


def company_rollup(t) -> DataFrame:
    f = fact_with_customer_date(t)
    return (f.rollup("company", "calendar_year")
            .agg(F.sum("line_revenue_mst").alias("revenue_mst"), F.count(F.lit(1)).alias("lines")))


def open_backlog(t) -> DataFrame:
    f = G.fact_sales_order_line(t).filter(F.col("order_status") == "Open")
    return (f.groupBy("customer_account")
            .agg(F.sum("remain_amount_financial").alias("backlog_amount"),
                 F.sum("remain_qty_physical").alias("backlog_qty"), F.count(F.lit(1)).alias("open_lines")))


def on_time_pct(t) -> DataFrame:
    f = G.fact_sales_order_line(t)
    return (f.groupBy("company")
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.count_if(F.col("days_variance_to_promise") <= 0).alias("on_time_lines"))
            .withColumn("on_time_pct", M.ratio(F.col("on_time_lines"), F.col("lines"), 2, 100.0)))


def revenue_vs_cost_by_category(t) -> DataFrame:
    f = G.invoice_lines_in_full(t)
    return (f.join(current_products(t), f.item_id == F.col("p_item"), "left").groupBy("product_category_parent", "product_category")
            .agg(F.sum("line_revenue_mst").alias("revenue_mst"), F.sum("line_cost").alias("cost"),
                 F.sum("gross_margin").alias("gross_margin")))


def credit_exposure(t) -> DataFrame:
    so = S.sales_order(t).filter(F.col("sales_status_code") == 1)
    open_amt = so.groupBy("customer_account").agg(F.sum("total_amount").alias("open_amount"))
    dc = G.dim_customer(t).filter("is_current").select("customer_account", "customer_name", "credit_limit")
    j = dc.join(open_amt, "customer_account", "inner")
    return (j.withColumn("exposure", (F.col("open_amount") - F.col("credit_limit")).cast("decimal(19,4)"))
            .withColumn("over_limit", F.col("open_amount") > F.col("credit_limit")))


def ar_aging(t) -> DataFrame:
    as_of = F.lit(G.AS_OF).cast("date")
    r = S.receivable(t).filter((F.col("transaction_date") <= as_of)
                               & (F.col("settlement_date").isNull() | (F.col("settlement_date") > as_of)))
    r = r.withColumn("bucket", M.aging_bucket(F.datediff(as_of, F.col("due_date"))))
    return r.groupBy("customer_account", "bucket").agg(F.sum("amount_accounting_currency").alias("open_amount"),
                                                        F.count(F.lit(1)).alias("items"))


def sales_monthly(t) -> DataFrame:
    so = S.sales_order(t)
    return (so.groupBy(F.date_format("order_date", "yyyy-MM").alias("order_month"), "sales_status")
            .agg(F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").alias("total_amount"),
                 (F.sum("total_amount").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_order_amount"),
                 F.count_distinct("customer_account").alias("distinct_customers")))


def access_log(t) -> DataFrame:
    """The events table read as an access log (user, action, object)."""
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(F.col("ts").alias("event_time"), F.col("user_id").alias("user_name"),
                           F.col("event_type").alias("action_name"),
                           F.concat(F.lit("gold.table_"), k.cast("string")).alias("table_full_name"),
                           (k >= PROTECTED_FROM_K).alias("is_protected"))


def access_top(t) -> DataFrame:
    a = access_log(t)
    g = a.groupBy("table_full_name").agg(F.count(F.lit(1)).alias("access_count"),
                                        F.count_distinct("user_name").alias("distinct_users"))
    return M.top_n(g, TOP_N, [F.col("access_count").desc(), F.col("table_full_name").asc()])


def protected_writes(t) -> DataFrame:
    a = access_log(t)
    return a.filter(F.col("is_protected") & F.col("action_name").isin(*WRITE_ACTIONS)).drop("is_protected")


def recent_reads(t) -> DataFrame:
    now = F.lit(ACCESS_NOW).cast("timestamp_ntz")
    a = access_log(t).filter(F.col("action_name").isin(*READ_ACTIONS)
                             & (F.col("event_time") >= now - F.expr(f"INTERVAL {RECENT_DAYS} DAYS")))
    return a.groupBy("table_full_name").agg(F.count(F.lit(1)).alias("reads"),
                                            F.count_distinct("user_name").alias("readers"))


def semi_additive_balance(t) -> DataFrame:
    """Daily balance readings per user (last of the day), summed across users per day."""
    ev = t.events.withColumn("balance", S.dec4("value"))
    return M.semi_additive(ev, ["user_id"], F.to_date("ts"), ["ts", "event_id"], "balance")


def ledger_by_layer(t) -> DataFrame:
    """Revenue always grouped by posting layer and currency (measure dictionary enforced)."""
    f = G.invoice_lines_in_full(t).withColumn(
        "posting_layer", F.when(F.col("line_cost") > 0, "Posted").otherwise("Unposted")).withColumn(
        "currency", F.concat(F.lit("CUR-"), F.col("company").cast("string")))
    measures = M.Measures().add(M.Measure("line_revenue_mst", "additive", ("posting_layer", "currency")))
    return measures.sum(f, ["posting_layer", "currency"], ["line_revenue_mst"])
