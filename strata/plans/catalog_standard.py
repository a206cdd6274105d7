"""Named queries of the standard Silver tables that are kept by increments: contact, sales order, the dimension and the fact on them.

A table's first load and its increment come from the fixture by a rule, so that the increment holds new rows, changes and deletes.
Both go through the same column rules, the increment through the watermark and a keyed merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import decode
from strata.functions.keys import sha_key
from strata.operators import changes as CH
from strata.operators import resolve as R
from strata.plans import silver as S
from strata.plans.oracle import cte, skey, sql
from strata.plans.registry import query
from strata.sources import ingest

# Labels of the order status.
STATUS = {"O": "Active", "F": "Invoiced", "P": "In Progress", "X": "Cancelled"}
SPLIT = "1996-01-01"


def merged(raw: DataFrame, columns: dict[str, Column], key: str, first_batch: int = 1) -> DataFrame:
    """The live rows after a first load (``batch`` = ``first_batch``) and an increment above that watermark; ``raw`` has batch and gone."""
    payload = [c for c in columns if c != key]
    shaped = raw.select("batch", "gone", *(v.alias(k) for k, v in columns.items())).withColumn("at", F.lit(None).cast("timestamp"))
    norm = lambda df: CH.normalise(df, key, payload, "batch", "gone", "at")
    state = CH.apply_scd1(None, norm(shaped.filter(F.col("batch") <= first_batch)), key)
    new = ingest.incremental_scan(shaped, "batch", F.lit(first_batch))
    return CH.live(CH.apply_scd1(state, norm(new), key)).drop(CH.EFFECTIVE).withColumnRenamed(CH.VERSION, "version_number")


cte("contact", """SELECT s_suppkey AS contact_id, s_suppkey * 7 % 2000 AS account_id,
  CASE WHEN s_suppkey % 3 = 0 OR s_suppkey % 5 = 0 THEN upper(trim(s_name)) ELSE trim(s_name) END AS full_name, lower(replace(trim(s_name), '#', '.')) || '@contact' AS email,
  CASE WHEN s_acctbal < 0 THEN 'Collections' ELSE 'Sales' END AS department, CASE WHEN s_suppkey % 3 = 0 OR s_suppkey % 5 = 0 THEN 2 ELSE 1 END AS version_number
FROM supplier WHERE s_suppkey % 35 <> 0""")


def contacts(t) -> DataFrame:
    s = t.supplier
    one = s.filter("s_suppkey % 3 <> 0").withColumns({"batch": F.lit(1).cast("long"), "gone": F.lit(False), "name": F.trim("s_name")})
    two = s.filter("s_suppkey % 3 = 0 or s_suppkey % 5 = 0").withColumns({"batch": F.lit(2).cast("long"), "gone": F.col("s_suppkey") % 35 == 0, "name": F.upper(F.trim("s_name"))})
    return merged(one.unionByName(two), {
        "contact_id": F.col("s_suppkey"), "account_id": F.col("s_suppkey") * 7 % 2000, "full_name": F.col("name"),
        "email": F.concat(F.lower(F.regexp_replace(F.trim("s_name"), "#", ".")), F.lit("@contact")), "department": F.when(F.col("s_acctbal") < 0, "Collections").otherwise("Sales")}, "contact_id")


@query("silver_contact", sql("SELECT c.*, NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = account_id) AS account_id_missing FROM contact c", "contact"))
def silver_contact(t):
    """Contacts by first load and increment, with the check of their account."""
    return R.check_parents(contacts(t), {"account_id": (t.customer, "c_custkey")})


@query("dim_contact", sql(f"SELECT {skey('contact_id')} AS contact_sk, contact_id, account_id, full_name, email, department FROM contact UNION ALL SELECT '-1', -1, NULL, 'Unknown', NULL, NULL", "contact"))
def dim_contact(t):
    """Contact dimension with its surrogate key and the unknown member."""
    return R.finish_dimension(contacts(t).drop("version_number"), ["contact_id"], "contact_sk", {"contact_id": -1, "full_name": "Unknown"})


cte("ordered", f"""SELECT sales_id AS sales_order_id, customer_account AS account_id, total_amount, order_date,
  CASE WHEN order_date < DATE '{SPLIT}' AND sales_id % 10 = 0 THEN 'Cancelled' ELSE concat(label, '') END AS status,
  CASE WHEN order_date >= DATE '{SPLIT}' OR sales_id % 10 = 0 THEN 2 ELSE 1 END AS version_number
FROM so JOIN (SELECT o_orderkey, any_value(CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Invoiced' WHEN 'P' THEN 'In Progress' ELSE 'Unknown' END) AS label FROM orders GROUP BY 1) s
  ON o_orderkey = sales_id WHERE sales_id % 70 <> 0""", "so")


def sales_orders(t) -> DataFrame:
    code = t.orders.groupBy(F.col("o_orderkey").alias("s_id")).agg(F.min("o_orderstatus").alias("code"))
    so = S.sales_order(t).join(code, F.col("sales_id") == F.col("s_id"))
    early = F.col("order_date") < F.lit(SPLIT).cast("date")
    one = so.filter(early).withColumns({"batch": F.lit(1).cast("long"), "gone": F.lit(False)})
    changed = F.col("sales_id") % 10 == 0
    two = so.filter(~early | changed).withColumns({"batch": F.lit(2).cast("long"), "gone": F.col("sales_id") % 70 == 0, "code": F.when(early, "X").otherwise(F.col("code"))})
    return merged(one.unionByName(two), {"sales_order_id": F.col("sales_id"), "account_id": F.col("customer_account"), "total_amount": F.col("total_amount"),
                                         "order_date": F.col("order_date"), "status": decode(F.col("code"), STATUS)}, "sales_order_id")


@query("silver_salesorder", sql("SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM ordered", "ordered"))
def silver_salesorder(t):
    """Orders by first load and increment; the increment brings later orders, cancellations and deletes."""
    return sales_orders(t)


@query("fact_salesorder_merged", sql("""SELECT sales_order_id, account_id, order_date, CAST(total_amount AS DOUBLE) AS total_amount, status,
  (SELECT CAST(CAST(sum(line_amount) AS DECIMAL(19,4)) AS DOUBLE) FROM sl WHERE sl.sales_id = sales_order_id) AS net_amount,
  account_id % 10 = 0 AS account_id_missing FROM ordered""", "ordered", "sl"))
def fact_salesorder_merged(t):
    """The order fact on the merged table: net amount of the lines, check of the account."""
    net = S.sales_line(t).groupBy(F.col("sales_id").alias("n_id")).agg(F.sum("line_amount").cast("decimal(19,4)").alias("net_amount"))
    f = sales_orders(t).select("sales_order_id", "account_id", "order_date", "total_amount", "status").join(net, F.col("sales_order_id") == F.col("n_id"), "left").drop("n_id")
    return R.check_parents(f, {"account_id": (t.customer.filter("c_custkey % 10 <> 0"), "c_custkey")})


@query("opportunity", """SELECT event_id AS opportunity_id, user_id AS account_id, event_type AS stage, CAST(ts AS DATE) AS created_on, CAST(CAST(value AS DECIMAL(19,4)) AS DOUBLE) AS estimated_value,
  NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND c_custkey % 2 = 0) AS account_id_missing FROM events WHERE event_type IN ('click', 'signup', 'purchase')""")
def opportunity(t):
    """The standard table pattern on opportunities, with the check of their account."""
    table = R.standard_table(t.events, ["event_id"], ["ts desc"], {"opportunity_id": "event_id", "account_id": "user_id", "stage": "event_type", "created_on": F.to_date("ts"),
                                                                 "estimated_value": S.dec4("value")}, F.col("event_type").isin("click", "signup", "purchase"))
    return R.check_parents(table, {"account_id": (t.customer.filter("c_custkey % 2 = 0"), "c_custkey")})
