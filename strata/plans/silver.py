"""Silver tables over the fixture tables (same grain as the source, typed,
deduplicated, decoded).

The fixture stands in for the business-application export as described in
FIXTURES.md §3: ``orders`` are sales orders / invoice headers, ``lineitem``
rows are sales and invoice lines (with duplicate deliveries of one line),
``customer``/``nation``/``region`` are customer, party and address, ``part``
is the item master with a brand-under-type category hierarchy.

Every function takes a :class:`strata.sources.fixtures.Tables` and returns a
lazy DataFrame; nothing is materialised here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.functions.keys import sha_key
from strata.operators import windows

# Sales-status enumeration and the fixture's status letters.
SALES_STATUS_LABELS = {1: "Open", 2: "Delivered", 3: "Invoiced", 4: "Cancelled"}
ORDER_STATUS_CODES = {"O": 1, "P": 2, "F": 3}

# Total order that picks one delivery of a duplicated line (FIXTURES.md §3).
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate desc", "l_partkey desc", "l_suppkey desc", "l_quantity desc",
              "l_extendedprice desc", "l_discount desc", "l_tax desc", "l_returnflag", "l_linestatus"]

# Promised delivery and payment terms of the fixture (days after order date).
PROMISE_DAYS = 30
PAYMENT_DAYS = 30


def dec4(c):
    return F.col(c).cast("decimal(19,4)") if isinstance(c, str) else c.cast("decimal(19,4)")


def dec6(c):
    return F.col(c).cast("decimal(19,6)") if isinstance(c, str) else c.cast("decimal(19,6)")


def customer_company(t) -> DataFrame:
    """customer → (customer_account, company, nation_key): company = region of the nation."""
    nation = t.nation.select("n_nationkey", F.col("n_regionkey").alias("company"))
    return (t.customer.select(F.col("c_custkey").alias("customer_account"), "c_nationkey")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("customer_account", "company", F.col("c_nationkey").alias("nation_key")))


def sales_order(t) -> DataFrame:
    """L1 silver.sales_table: latest row per order, status decoded, typed."""
    o = windows.latest(t.orders, "o_orderkey", ["o_orderdate desc", "o_totalprice desc"])
    code = C.decode(F.col("o_orderstatus"), ORDER_STATUS_CODES)
    cc = customer_company(t)
    return (o.join(cc, F.col("o_custkey") == F.col("customer_account"), "left")
            .select(
                F.col("o_orderkey").alias("sales_id"),
                "company",
                "customer_account",
                "nation_key",
                code.alias("sales_status_code"),
                C.decode(code, SALES_STATUS_LABELS).alias("sales_status"),
                F.to_date("o_orderdate").alias("order_date"),
                F.date_add(F.to_date("o_orderdate"), PROMISE_DAYS).alias("delivery_date"),
                F.split("o_orderpriority", "-", 2).getItem(0).alias("delivery_mode_code"),
                dec4("o_totalprice").alias("total_amount"),
            ))


def _line_base(t) -> DataFrame:
    return windows.latest(t.lineitem, LINE_KEY, LINE_ORDER)


def lines_apart(t) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Raw lines of the usual orders, whose lines can meet in one task; lines of crowded orders; lines without an order."""
    return t.once("lines_apart", lambda: windows.apart(t.lineitem, LINE_KEY[0]))


def _line_amount():
    return (dec4("l_extendedprice") * (F.lit(1) - dec4("l_discount"))).cast("decimal(19,4)")


def sales_line(t) -> DataFrame:
    """L2 silver.sales_line: one row per (order, line) after dedup of deliveries."""
    return _line_base(t).select(*sales_columns())


def sales_columns() -> list:
    amount = _line_amount()
    is_open = F.col("l_linestatus") == "O"
    return [
        F.col("l_orderkey").alias("sales_id"),
        F.col("l_linenumber").alias("line_num"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("supplier_id"),
        dec6("l_quantity").alias("sales_qty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        amount.alias("line_amount"),
        F.when(is_open, dec6("l_quantity")).otherwise(F.lit(0).cast("decimal(19,6)")).alias("remain_qty_physical"),
        F.when(is_open, amount).otherwise(F.lit(0).cast("decimal(19,4)")).alias("remain_amount_financial"),
        F.to_date("l_shipdate").alias("line_ship_date"),
        F.col("l_returnflag"), F.col("l_linestatus"),
    ]


def line_tax():
    return (_line_amount() * dec4("l_tax")).cast("decimal(19,4)")


def invoice_line(t, kept: DataFrame | None = None) -> DataFrame:
    """L4 silver.cust_invoice_trans: invoice lines (same dedup as sales lines, or the deliveries that one has ``kept``)."""
    return (_line_base(t) if kept is None else kept).select(*invoice_columns())


def invoice_columns() -> list:
    amount = _line_amount()
    return [
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_linenumber").alias("line_num"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("supplier_id"),
        dec6("l_quantity").alias("invoiced_qty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        amount.alias("line_revenue"),
        (dec4("l_extendedprice") * dec4("l_discount")).cast("decimal(19,4)").alias("line_discount_amount"),
        line_tax().alias("line_tax"),
        F.to_date("l_shipdate").alias("ship_date"),
        F.col("l_returnflag").alias("department"),
        F.col("l_linestatus").alias("cost_center"),
    ]


def invoice_header(t) -> DataFrame:
    """L3 silver.cust_invoice_jour: order as invoice header; tax = sum of line tax.

    The line tax is pre-aggregated to one row per invoice (partial + final
    hash aggregate) before it meets the header, so the join stays 1:1.
    """
    tax = (invoice_line(t).groupBy("invoice_id")
           .agg(F.sum("line_tax").cast("decimal(19,4)").alias("total_tax")))
    so = sales_order(t)
    return (so.join(tax, so.sales_id == tax.invoice_id, "left")
            .select(
                so.sales_id.alias("invoice_id"),
                "company",
                F.col("customer_account").alias("invoice_account"),
                "nation_key",
                F.col("order_date").alias("invoice_date"),
                F.date_add("order_date", PAYMENT_DAYS).alias("due_date"),
                F.col("total_amount").alias("invoice_amount"),
                F.coalesce("total_tax", F.lit(0).cast("decimal(19,4)")).alias("total_tax"),
                "sales_status",
            ))


def untaxed_header(t, customers: DataFrame | None = None) -> DataFrame:
    """Invoice headers without what has to be read from their lines, lying by invoice (hashed on the order's key).

    Only the two keys of an order go to its customer, and come back with company and nation; the order itself stays where the
    choice of its latest row has put it.  ``customers`` (keyed by c_account and c_company) add their columns, NULL where none fits.
    """
    # rows that are equal in date and price differ in the customer only, and only its side reads that
    o = windows.latest(t.orders.filter(F.col("o_orderkey").isNotNull()), "o_orderkey", ["o_orderdate desc", "o_totalprice desc", "o_custkey desc"])
    owner = (o.select(F.col("o_orderkey").alias("w_order"), F.col("o_custkey").alias("w_customer"))
             .join(customer_company(t), F.col("w_customer") == F.col("customer_account")).drop("w_customer"))
    if customers is not None:
        owner = owner.join(customers, (F.col("customer_account") == F.col("c_account")) & F.col("company").eqNullSafe(F.col("c_company")), "left")
    return (o.join(owner.repartition("w_order"), F.col("o_orderkey") == F.col("w_order"), "left")
            .select(F.col("o_orderkey").alias("h_invoice_id"), "company", F.col("customer_account").alias("invoice_account"), "nation_key",
                    F.to_date("o_orderdate").alias("invoice_date"), dec4("o_totalprice").alias("invoice_amount"), *(customers.columns if customers is not None else [])))


def _price(t) -> DataFrame:
    return t.part.select("p_partkey", "p_retailprice")


def priced_lines(t, lines: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """Surviving deliveries as the source has them, with the price of their part (and ``products``, keyed by p_item): what is computed from them waits for the last join."""
    out = (_line_base(t) if lines is None else lines).join(_price(t), F.col("l_partkey") == F.col("p_partkey"), "left")
    return out if products is None else out.join(products, F.col("l_partkey") == F.col("p_item"), "left")


def taxed_lines_together(t, near: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """``priced_lines`` with the tax of their whole invoice, of lines that can be brought together by order: they move once, all of them.

    Their tax is added up where they lie, and only the keys of a line go to its part and come back with the price.
    """
    kept = windows.latest(near.repartition(LINE_KEY[0]), LINE_KEY, LINE_ORDER)
    priced = priced_lines(t, kept.select(*LINE_KEY, "l_partkey"), products).drop("l_partkey", "p_partkey").repartition(LINE_KEY[0])
    total = F.sum(line_tax()).over(Window.partitionBy(LINE_KEY[0])).cast("decimal(19,4)")
    return windows.beside(kept.withColumn("total_tax", total), priced, *LINE_KEY)


def taxed_lines_apart(t, crowded: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """The same of lines whose order has too many of them for one task: at most one row per line and map task moves, sums meet the lines by a join."""
    kept = windows.latest(crowded, LINE_KEY, LINE_ORDER)
    tax = (kept.groupBy(F.col(LINE_KEY[0]).alias("x_order")).agg(F.sum(line_tax()).cast("decimal(19,4)").alias("total_tax")))
    return priced_lines(t, kept, products).drop("p_partkey").join(tax, F.col(LINE_KEY[0]) == F.col("x_order"), "left").drop("x_order")


def cost_columns() -> dict:
    """Posted and adjustment cost of a priced line."""
    cost = dec4("p_retailprice") * dec6("l_quantity")
    adjustment = (cost * F.lit(0.05).cast("decimal(3,2)")).cast("decimal(19,4)")
    zero = F.lit(0).cast("decimal(19,4)")
    return {"posted": (cost * F.lit(0.7).cast("decimal(3,2)")).cast("decimal(19,4)"),
            "adjustment": F.when(F.col("l_returnflag") == "R", F.when(cost.isNotNull(), zero)).otherwise(adjustment)}


def lines_with_cost(t) -> DataFrame:
    """Surviving deliveries (one per order and line) with the posted and adjustment cost of that delivery.

    Cost follows the delivery that the line's dedup keeps, never one that it discards.  A returned line takes no
    adjustment.  A part without a price leaves both amounts NULL.
    """
    return priced_lines(t).withColumns(cost_columns())


def invent_trans(t) -> DataFrame:
    """Physical inventory rows: a posted row with the quantity and an adjustment row without one, per kept delivery."""
    kinds = F.array(
        F.struct(F.lit("posted").alias("kind"), dec6("l_quantity").alias("qty"), F.col("posted").alias("cost_posted"),
                 F.lit(0).cast("decimal(19,4)").alias("cost_adjustment")),
        F.struct(F.lit("adjustment").alias("kind"), F.lit(0).cast("decimal(19,6)").alias("qty"),
                 F.lit(0).cast("decimal(19,4)").alias("cost_posted"), F.col("adjustment").alias("cost_adjustment")))
    return lines_with_cost(t).filter(F.col("posted").isNotNull()).select(
        F.col("l_orderkey").alias("trans_invoice_id"), F.col("l_linenumber").alias("trans_line_num"),
        F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("supplier_id"), F.inline(kinds))


def cost_per_trans(t) -> DataFrame:
    """The physical rows of a transaction summed to one cost row."""
    return (invent_trans(t).groupBy("trans_invoice_id", "trans_line_num")
            .agg(F.max("item_id").alias("item_id"),
                 F.sum("cost_posted").cast("decimal(19,4)").alias("cost_amount_posted"),
                 F.sum("cost_adjustment").cast("decimal(19,4)").alias("cost_amount_adjustment"),
                 F.sum(F.col("cost_posted") + F.col("cost_adjustment")).cast("decimal(19,4)").alias("total_cost"),
                 F.sum("qty").cast("decimal(19,6)").alias("inventory_qty")))


def receivable(t) -> DataFrame:
    """L6 silver.cust_trans: orders as receivables; settled when status F."""
    so = sales_order(t)
    return so.select(
        F.col("sales_id").alias("trans_id"),
        "customer_account", "company",
        F.col("order_date").alias("transaction_date"),
        F.col("total_amount").alias("amount_accounting_currency"),
        F.date_add("order_date", PAYMENT_DAYS).alias("due_date"),
        F.when(F.col("sales_status_code") == 3, F.date_add("order_date", PAYMENT_DAYS)).alias("settlement_date"),
    )


def customer(t) -> DataFrame:
    """L8 silver.customer: typed customer with company and credit limit."""
    cc = customer_company(t)
    c = windows.latest(t.customer, "c_custkey", ["c_acctbal desc"])
    return (c.join(cc, c.c_custkey == cc.customer_account, "left")
            .select(
                "customer_account", "company", "nation_key",
                F.col("c_name").alias("customer_name"),
                F.upper(F.trim("c_mktsegment")).alias("customer_group"),
                dec4("c_acctbal").alias("credit_limit"),
                F.when(F.col("c_acctbal") < 0, "Blocked").otherwise("No").alias("blocked_status"),
            ))


def party(t) -> DataFrame:
    """L7 silver.party: customers and suppliers as parties; persons / organisations.

    Table inheritance: the party row is re-joined to its person or
    organisation child; the subtype is whichever child matched (D4).
    """
    parties = (t.customer.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("party_id"),
                                 F.col("c_name").alias("party_name"), F.col("c_custkey").alias("num"),
                                 F.col("c_nationkey").alias("nation_key"))
               .unionByName(t.supplier.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("party_id"),
                                              F.col("s_name").alias("party_name"), F.col("s_suppkey").alias("num"),
                                              F.col("s_nationkey").alias("nation_key"))))
    person = parties.filter(F.col("num") % 2 == 0).select(
        F.col("party_id").alias("person_party"),
        F.concat(F.lit("First "), F.col("num").cast("string")).alias("first_name"))
    org = parties.filter(F.col("num") % 2 == 1).select(
        F.col("party_id").alias("org_party"),
        F.concat(F.lit("ORG-"), F.lpad(F.col("num").cast("string"), 6, "0")).alias("organization_number"))
    return (parties.join(person, parties.party_id == person.person_party, "left")
            .join(org, parties.party_id == org.org_party, "left")
            .select("party_id", "party_name", "nation_key",
                    F.when(F.col("person_party").isNotNull(), "Person")
                     .when(F.col("org_party").isNotNull(), "Organization").otherwise("Unknown").alias("party_type"),
                    "first_name", "organization_number"))


def address_history(t) -> DataFrame:
    """Effective-dated addresses / rates: nation × calendar year, ``[Jan 1, next Jan 1)``.

    One version per (nation, year) in which that nation's customers placed
    orders, so the table is derived from the data and every order date has a
    covering version.  Bounded by 25 nations × years of history.
    """
    years = (t.orders.select("o_custkey", F.year("o_orderdate").alias("yr"))
             .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
             .groupBy("c_nationkey", "yr").agg(F.count(F.lit(1)).alias("_n")))
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return years.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "inner").select(
        F.col("n_nationkey").alias("nation_key"),
        F.make_date("yr", F.lit(1), F.lit(1)).alias("valid_from"),
        F.make_date(F.col("yr") + 1, F.lit(1), F.lit(1)).alias("valid_to"),
        F.concat(F.lit("CITY-"), F.col("n_name"), F.lit("-"), F.col("yr").cast("string")).alias("city"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region_name"),
        (F.lit(1) + F.col("n_nationkey").cast("decimal(10,4)") / F.lit(100)).cast("decimal(10,4)").alias("rate"),
    )


def item(t) -> DataFrame:
    """L11/L12 silver.invent_table: item with category (brand) and parent (type)."""
    p = windows.latest(t.part, "p_partkey", ["p_retailprice desc"])
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit("P-"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("product_number"),
        F.col("p_type").alias("item_group"),
        sha_key("p_type", "p_brand").alias("category_id"),
        "p_size", dec4("p_retailprice").alias("list_price"),
    )


def category(t) -> DataFrame:
    """Category table with a self reference: brand-under-type leaves, types as roots."""
    leaves = (t.part.select("p_type", "p_brand").groupBy("p_type", "p_brand").agg(F.count(F.lit(1)).alias("_n"))
              .select(sha_key("p_type", "p_brand").alias("category_id"),
                      F.col("p_brand").alias("name"),
                      sha_key("p_type").alias("parent_category_id")))
    roots = (t.part.select("p_type").groupBy("p_type").agg(F.count(F.lit(1)).alias("_n"))
             .select(sha_key("p_type").alias("category_id"), F.col("p_type").alias("name"),
                     F.lit(None).cast("string").alias("parent_category_id")))
    return leaves.unionByName(roots)
