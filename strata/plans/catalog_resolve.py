"""Named queries of label, currency, parent and dimension resolution, and of the incremental Silver and Gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import changes as CH
from strata.operators import resolve as R
from strata.plans import feeds as FD
from strata.plans import gold as G
from strata.plans import silver as S
from strata.plans.catalog import dbl
from strata.plans.oracle import rhash, skey, sql
from strata.plans.registry import query

# Option sets (set, code, language, label); some codes have no label, and one only in another language.
OPTIONS = (("priority", 1, 1033, "Urgent"), ("priority", 2, 1033, "High"), ("priority", 3, 1033, "Medium"), ("priority", 4, 1036, "Faible"),
           ("size", 0, 1033, "Tiny"), ("size", 1, 1033, "Small"), ("size", 2, 1033, "Middle"), ("size", 5, 1033, "Large"), ("size", 5, 1036, "Grand"))
_OPTIONS_SQL = "(VALUES " + ", ".join(str(o) for o in OPTIONS) + ") v(option_set, code, lang, label)"
REPORTING_RATE = 10     # reporting currency: one tenth more per region number
PROBABILITY = {"view": 10, "click": 25, "signup": 60, "purchase": 100}


def options(t):
    return t.spark.createDataFrame(list(OPTIONS), "option_set string, code int, language int, label string")


@query("option_label", f"""SELECT o_orderkey, CAST(o_orderpriority[1] AS INTEGER) AS code,
  (SELECT label FROM {_OPTIONS_SQL} WHERE option_set = 'priority' AND lang = 1033 AND code = CAST(o_orderpriority[1] AS INTEGER)) AS label FROM orders""")
def option_label(t):
    """Priority codes with their English labels; codes 4 and 5 have none."""
    o = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("code"))
    return R.resolve_label(o, options(t), "priority", "code", "label")


_CODES = "CASE WHEN p_size % 11 = 0 THEN NULL ELSE (p_size % 5) || ',' || (p_size % 7) || CASE WHEN p_size % 3 = 0 THEN ', none' ELSE '' END END"


@query("multi_option_label", f"""WITH x AS (SELECT p_partkey, {_CODES} AS codes FROM part),
y AS (SELECT p_partkey, TRY_CAST(trim(unnest(string_split(codes, ','))) AS INTEGER) AS code FROM x WHERE codes IS NOT NULL
      UNION ALL SELECT p_partkey, NULL FROM x WHERE codes IS NULL)
SELECT y.*, label FROM y LEFT JOIN (SELECT * FROM {_OPTIONS_SQL} WHERE option_set = 'size' AND lang = 1033) o USING (code)""")
def multi_option_label(t):
    """D3: a comma list of size codes, one row per code; without codes, no number and without label included."""
    p = t.part.select("p_partkey", F.expr(_CODES).alias("codes"))
    return R.resolve_multi_label(p, options(t), "size", "codes", "code", "label").select("p_partkey", "code", "label")


@query("posted_lines", """SELECT l_orderkey, l_linenumber, l_linestatus IS NOT DISTINCT FROM 'F' AS posted, count(*) AS deliveries
FROM lineitem GROUP BY ALL""")
def posted_lines(t):
    """Posted and unposted deliveries per line."""
    posted, unposted = R.split_posted(t.lineitem.select("l_orderkey", "l_linenumber", "l_linestatus"), "l_linestatus", ["F"])
    both = posted.withColumn("posted", F.lit(True)).unionByName(unposted.withColumn("posted", F.lit(False)))
    return both.groupBy("l_orderkey", "l_linenumber", "posted").agg(F.count(F.lit(1)).alias("deliveries"))


@query("audit_columns", f"""SELECT o_orderkey, 'erp' AS _source_system, 'orders' AS _source_table, CAST(o_orderkey AS VARCHAR) AS _source_row_id,
  {rhash('o_orderstatus', 'o_orderpriority', 'o_custkey')} AS _record_hash, CAST(o_orderdate AS DATE) AS _ingested_at, 'b1' AS _batch_id, 'r1' AS _run_id,
  CASE WHEN o_totalprice > 100000 THEN 'WARN' ELSE 'PASS' END AS _dq_status FROM orders""")
def audit_columns(t):
    """Orders with their audit columns."""
    out = R.with_audit(t.orders, "erp", "orders", "o_orderkey", "b1", "r1", F.to_date("o_orderdate"), ["o_orderstatus", "o_orderpriority", "o_custkey"],
                       F.when(F.col("o_totalprice") > 100000, "WARN").otherwise("PASS"))
    return out.select("o_orderkey", *(c for c in out.columns if c.startswith("_")))


def _order_amounts(t):
    return S.sales_order(t).select("sales_id", "nation_key", "company", "order_date", "total_amount")


@query("convert_asof", sql("""SELECT sales_id, CAST(total_amount AS DOUBLE) AS total_amount, CAST(round(total_amount * rate, 2) AS DOUBLE) AS converted
FROM so LEFT JOIN ah ON ah.nation_key = so.nation_key AND order_date >= valid_from AND order_date < valid_to""", "so", "ah"))
def convert_asof(t):
    """Order totals at the rate of their date."""
    return R.convert(_order_amounts(t), S.address_history(t), "nation_key", "nation_key", "order_date", "total_amount", "converted").select(
        "sales_id", "total_amount", "converted")


@query("currency_triple", sql(f"""SELECT sales_id, CAST(total_amount AS DOUBLE) AS amount_transaction, CAST(round(total_amount * rate, 2) AS DOUBLE) AS amount_accounting,
  CAST(round(round(total_amount * rate, 2) * ({REPORTING_RATE} + company)::DECIMAL(10,4) / {REPORTING_RATE}, 2) AS DOUBLE) AS amount_reporting
FROM so LEFT JOIN ah ON ah.nation_key = so.nation_key AND order_date >= valid_from AND order_date < valid_to""", "so", "ah").replace(
    f"({REPORTING_RATE} + company)::DECIMAL(10,4) / {REPORTING_RATE}", "CAST((10 + company) * 0.1 AS DECIMAL(10,4))"))
def currency_triple(t):
    """Each amount in transaction, accounting and reporting currency."""
    own = S.address_history(t).select("nation_key", "valid_from", "valid_to", "rate")
    out = R.convert(_order_amounts(t), own, "nation_key", "nation_key", "order_date", "total_amount", "amount_accounting")
    region = t.nation.select(F.col("n_regionkey").alias("region")).distinct().select(
        "region", F.lit("0001-01-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
        ((F.lit(REPORTING_RATE) + F.col("region")) * F.lit(0.1)).cast("decimal(10,4)").alias("rate"))
    out = R.convert(out, region, "company", "region", "order_date", "amount_accounting", "amount_reporting")
    return out.select("sales_id", F.col("total_amount").alias("amount_transaction"), "amount_accounting", "amount_reporting")


@query("late_parent", """SELECT o_orderkey, o_custkey, CASE WHEN c_custkey % 4 < 3 THEN c_name END AS c_name,
  CASE WHEN c_custkey % 4 < 2 THEN 1 WHEN c_custkey % 4 = 2 THEN 2 END AS resolved_in FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def late_parent(t):
    """Orders whose customer came with the first batch, with the second, or not yet."""
    c = t.customer.select("c_custkey", "c_name")
    return R.resolve_late(t.orders.select("o_orderkey", "o_custkey"), [c.filter("c_custkey % 4 < 2"), c.filter("c_custkey % 4 between 1 and 2")],
                          "o_custkey", "c_custkey", "c_name")


@query("resolve_components", """SELECT l_orderkey, l_linenumber, l_suppkey, s_nationkey AS site, n_name AS warehouse_country
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal >= 0 LEFT JOIN nation ON n_nationkey = s_nationkey""")
def resolve_components(t):
    """A line's dimension id resolved to its parts; ids without a row keep their line."""
    from strata.operators import joins
    d = t.supplier.filter("s_acctbal >= 0").select("s_suppkey", "s_nationkey").dropDuplicates(["s_suppkey"])
    d = joins.lookup(d, t.nation.select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    out = joins.lookup(t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey"), d, F.col("l_suppkey") == F.col("s_suppkey"))
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("s_nationkey").alias("site"), F.col("n_name").alias("warehouse_country"))


@query("as_known_at", f"""WITH e AS (SELECT user_id, event_id, event_type, ts, date_trunc('day', ts)::DATE - CAST(event_id % 5 AS INTEGER) AS valid_from FROM events),
known AS (SELECT * FROM e WHERE ts <= TIMESTAMP '{FD.CUT}' + INTERVAL 3 DAY QUALIFY row_number() OVER (PARTITION BY user_id, valid_from ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, event_id, event_type, valid_from FROM known WHERE valid_from <= DATE '{FD.CUT}'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY valid_from DESC, ts DESC, event_id DESC) = 1""")
def as_known_at(t):
    """K3: what was valid on the cut day, as the system knew it three days later (statements reach up to four days back)."""
    e = t.events.select("user_id", "event_id", "event_type", "ts", F.expr("date_sub(to_date(ts), cast(event_id % 5 as int))").alias("valid_from"))
    said = F.struct("ts", "event_id").alias("said")     # two statements of one instant are told apart by their ids
    h = R.bitemporal(e.select("*", said), "user_id", "valid_from", "said")
    until = F.struct((F.lit(FD.CUT).cast("timestamp_ntz") + F.expr("INTERVAL 3 DAYS")).alias("ts"), F.lit((1 << 63) - 1).alias("event_id"))
    return R.as_known(h, "user_id", "valid_from", "said", F.lit(FD.CUT).cast("date"), until).select("user_id", "event_id", "event_type", "valid_from")


@query("bridge_weight", """SELECT l_partkey, l_suppkey, 1.0::DOUBLE / count(*) OVER (PARTITION BY l_partkey) AS weight
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) p""")
def bridge_weight(t):
    """Parts and their suppliers, weights summing to one per part."""
    return R.bridge(t.lineitem, "l_partkey", "l_suppkey")


@query("header_on_lines", sql("""SELECT sales_id, line_num, CAST(line_amount AS DOUBLE) AS line_amount, order_date, sales_status, company
FROM sl LEFT JOIN so USING (sales_id)""", "sl", "so"))
def header_on_lines(t):
    """Lines with their header's date, status and company."""
    lines = S.sales_line(t).select("sales_id", "line_num", "line_amount")
    return R.header_attributes(lines, S.sales_order(t).withColumnRenamed("sales_id", "h"), "sales_id", "h", ["order_date", "sales_status", "company"])


query("silver_receivable", sql("""SELECT sales_id AS trans_id, customer_account, company, order_date AS transaction_date,
  CAST(total_amount AS DOUBLE) AS amount_accounting_currency, order_date + 30 AS due_date,
  CASE sales_status WHEN 'Invoiced' THEN order_date + 30 END AS settlement_date FROM so""", "so"))(S.receivable)


@query("open_balance", sql("""SELECT trans_id, amount, settled_amount, amount - settled_amount AS open_amount FROM (
  SELECT sales_id AS trans_id, total_amount AS amount, coalesce((SELECT sum(line_revenue) FROM il WHERE invoice_id = sales_id AND cost_center = 'F'), 0) AS settled_amount
  FROM so) q""", "so", "il").replace("SELECT trans_id, amount, settled_amount, amount - settled_amount AS open_amount",
    "SELECT trans_id, CAST(amount AS DOUBLE) AS amount, CAST(settled_amount AS DOUBLE) AS settled_amount, CAST(amount - settled_amount AS DOUBLE) AS open_amount"))
def open_balance(t):
    """Receivables less their settled lines."""
    paid = S.invoice_line(t).filter(F.col("cost_center") == "F").select("invoice_id", "line_revenue")
    r = S.receivable(t).select("trans_id", F.col("amount_accounting_currency").alias("amount"))
    return R.open_balance(r, paid, "trans_id", "invoice_id", "amount", "line_revenue")


@query("silver_account_incremental", sql("""SELECT s.user_id AS account_id, upper(s.event_type) AS state_label, s.value, s._version AS version, c.c_custkey IS NULL AS is_orphan
FROM st_all s LEFT JOIN customer c ON c.c_custkey = s.user_id AND c.c_custkey % 3 <> 0 WHERE NOT s._deleted""", "st_all"))
def silver_account_incremental(t):
    """What is newer than the watermark, decoded, merged into the earlier state, checked for accounts without a customer."""
    from strata.functions.columns import decode
    from strata.sources import ingest
    labels = {e: e.upper() for e in ("view", "click", "signup", "purchase", "error")}

    def silver(feed):
        return CH.normalise(feed.withColumn("state_label", decode(F.col("event_type"), labels)).withColumnRenamed("user_id", "account_id"),
                            "account_id", ["state_label", "value"], "event_id", "is_delete", "ts")

    earlier = CH.apply_scd1(None, silver(FD.first_half(t)), "account_id")
    new = ingest.incremental_scan(FD.feed(t), "ts", F.lit(FD.CUT).cast("timestamp_ntz") - F.expr("INTERVAL 1 MICROSECOND"))
    state = CH.live(CH.apply_scd1(earlier, silver(new), "account_id"))
    known = t.customer.filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("known")).distinct()
    return (state.join(known, F.col("account_id") == F.col("known"), "left")
            .select("account_id", "state_label", "value", F.col(CH.VERSION).alias("version"), F.col("known").isNull().alias("is_orphan")))


@query("silver_product", """SELECT p_partkey AS product_id, trim(p_name) AS product_name, upper(p_brand) AS brand, CAST(p_size AS INTEGER) AS size,
  CAST(CAST(p_retailprice AS DECIMAL(19,4)) AS DOUBLE) AS list_price FROM part WHERE p_size > 5""")
def silver_product(t):
    """The standard table pattern on the item master."""
    return R.standard_table(t.part, ["p_partkey"], ["p_retailprice desc"], {
        "product_id": "p_partkey", "product_name": F.trim("p_name"), "brand": F.upper("p_brand"), "size": F.col("p_size").cast("int"),
        "list_price": S.dec4("p_retailprice")}, F.col("p_size") > 5)


@query("reference_delivery_mode", """SELECT DISTINCT CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS code, lower(split_part(o_orderpriority, '-', 2)) AS name FROM orders""")
def reference_delivery_mode(t):
    """The standard table pattern on a reference list."""
    parts = F.split("o_orderpriority", "-", 2)
    source = t.orders.select(parts.getItem(0).cast("int").alias("code"), parts.getItem(1).alias("name")).distinct()
    return R.standard_table(source, ["code"], ["name"], {"code": "code", "name": F.lower("name")})


@query("dim_account", f"""SELECT {skey('c_custkey')} AS account_sk, c_custkey AS account_id,
  CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN lower(c_name) ELSE c_name END AS name,
  CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 2 ELSE 1 END AS version FROM customer WHERE c_custkey % 35 <> 0""")
def dim_account(t):
    """Account dimension kept by increments: a first load, then new, changed and deleted accounts."""
    c = t.customer.select("c_custkey", "c_name")
    shape = lambda d, v: d.select(F.col("c_custkey").alias("account_id"), "name", F.lit(v).alias("ver"), (F.col("c_custkey") % 35 == 0).alias("gone"), F.lit(None).cast("timestamp").alias("at"))
    norm = lambda d: CH.normalise(d, "account_id", ["name"], "ver", "gone", "at")
    one = shape(c.filter("c_custkey % 3 <> 0").withColumn("name", F.col("c_name")), 1).withColumn("gone", F.lit(False))
    two = shape(c.filter("c_custkey % 3 = 0 or c_custkey % 5 = 0").withColumn("name", F.lower("c_name")), 2)
    state = CH.live(CH.apply_scd1(CH.apply_scd1(None, norm(one), "account_id"), norm(two), "account_id"))
    from strata.functions.keys import sha_key
    return state.select(sha_key("account_id").alias("account_sk"), "account_id", "name", F.col(CH.VERSION).alias("version"))


@query("fact_salesorder", sql(dbl("""SELECT so.sales_id, so.customer_account, so.order_date, so.total_amount, net_amount,
  so.customer_account % 10 = 0 AS customer_account_missing FROM so LEFT JOIN (SELECT sales_id, CAST(sum(line_amount) AS DECIMAL(19,4)) AS net_amount FROM sl GROUP BY sales_id) n
  ON n.sales_id = so.sales_id""", "total_amount", "net_amount"), "so", "sl"))
def fact_salesorder(t):
    """Orders with net amount and a check of the customer key."""
    net = S.sales_line(t).groupBy(F.col("sales_id").alias("n_id")).agg(F.sum("line_amount").cast("decimal(19,4)").alias("net_amount"))
    f = S.sales_order(t).select("sales_id", "customer_account", "order_date", "total_amount").join(net, F.col("sales_id") == F.col("n_id"), "left").drop("n_id")
    return R.check_parents(f, {"customer_account": (t.customer.filter("c_custkey % 10 <> 0"), "c_custkey")})


@query("fact_opportunity", f"""SELECT user_id AS account_id, count(*) AS steps, CAST(max(CASE event_type {' '.join(f"WHEN '{k}' THEN {v}" for k, v in PROBABILITY.items())} END) AS INTEGER) AS probability,
  CAST(sum(CAST(value AS DECIMAL(19,4))) AS DOUBLE) AS estimated_value, NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND c_custkey % 2 = 0) AS account_id_missing
FROM events WHERE event_type <> 'error' GROUP BY user_id""")
def fact_opportunity(t):
    """One opportunity per account from its steps, with a check of the account key."""
    from strata.functions.columns import decode
    f = (t.events.filter(F.col("event_type") != "error").groupBy(F.col("user_id").alias("account_id"))
         .agg(F.count(F.lit(1)).alias("steps"), F.max(decode(F.col("event_type"), PROBABILITY)).cast("int").alias("probability"), F.sum(S.dec4("value")).alias("estimated_value")))
    return R.check_parents(f, {"account_id": (t.customer.filter("c_custkey % 2 = 0"), "c_custkey")})


@query("dim_with_unknown", sql(f"""SELECT {skey('item_id')} AS item_sk, item_id, product_name, product_category, product_category_parent, product_type FROM dim_product
UNION ALL SELECT '-1', -1, 'Unknown', NULL, NULL, 'Unknown'""", "dim_product"))
def dim_with_unknown(t):
    """Product dimension with surrogate keys, its two hierarchy levels, reporting class and the unknown member."""
    d = G.dim_product(t).select("item_id", "product_name", "product_category", "product_category_parent", "product_type")
    return R.finish_dimension(d, ["item_id"], "item_sk", {"item_id": -1, "product_name": "Unknown", "product_type": "Unknown"})
