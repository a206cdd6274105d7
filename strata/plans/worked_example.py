"""The worked Silver table, one row per posted customer invoice line per legal entity, with its ten tests.

Built from the same pieces as the model.  The posted line drives; the header is looked up (company and dates, no totals are
copied), the inventory dimension is resolved, amounts stand in transaction and accounting currency, and returned lines are credit notes whose
quantity and amounts carry a negative sign.  Line and order share their number in the source, so order references repeat the
invoice's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import sha_key
from strata.operators import quality as Q
from strata.operators import windows
from strata.plans import gold as G
from strata.plans import silver as S
from strata.plans.oracle import skey, sql
from strata.plans.registry import query

BATCH_ID = "b1"
CUT = "1995-01-01"      # lines shipped before it came with the first load, the others with the second


def _signed(c: str | Column) -> Column:
    return F.when(F.col("department") == "R", -F.col(c) if isinstance(c, str) else -c).otherwise(F.col(c) if isinstance(c, str) else c)


def _shape(lines: DataFrame, *more: Column) -> DataFrame:
    credit = F.col("department") == "R"
    gross = (F.col("line_revenue") + F.col("line_discount_amount")).cast("decimal(19,4)")
    return lines.select(
        sha_key("company", "invoice_id", "line_num").alias("SalesInvoiceLineKey"), F.col("company").alias("LegalEntityCode"), F.col("invoice_id").alias("InvoiceNumber"),
        F.col("line_num").alias("InvoiceLineNumber"), (F.col("invoice_id") * 10 + F.col("line_num")).alias("InvoiceLineSourceRecId"), F.col("invoice_id").alias("SalesOrderNumber"),
        F.col("line_num").alias("SalesOrderLineNumber"), F.col("invoice_date").alias("InvoiceDate"), F.col("ship_date").alias("AccountingDate"),
        F.col("invoice_account").alias("CustomerAccount"), F.col("item_id").alias("ItemNumber"), F.concat(F.lit("DIM-"), F.col("supplier_id").cast("string")).alias("InventoryDimensionId"),
        F.col("site_id").alias("SiteCode"), F.col("warehouse_id").alias("WarehouseCode"), F.date_format("ship_date", "yyyyMM").alias("BatchNumber"),
        F.when(F.col("invoiced_qty") == 1, F.concat(F.lit("SN-"), F.col("item_id").cast("string"))).alias("SerialNumber"), _signed("invoiced_qty").alias("InvoicedQuantity"),
        F.lit("ea").alias("SalesUnitCode"), F.concat(F.lit("CUR-"), F.col("company").cast("string")).alias("TransactionCurrencyCode"),
        _signed(gross).alias("GrossAmountTransactionCurrency"), _signed("line_discount_amount").alias("DiscountAmountTransactionCurrency"),
        _signed("line_revenue").alias("NetAmountTransactionCurrency"), F.lit("MST").alias("AccountingCurrencyCode"), _signed("line_revenue_mst").alias("NetAmountAccountingCurrency"),
        _signed("line_cost").alias("CostAmountAccountingCurrency"), credit.alias("IsCreditNote"), (credit & (F.col("cost_center") == "F")).alias("IsReversal"),
        F.col("ship_date").alias("SourceModifiedDateTime"), F.lit(BATCH_ID).alias("LoadBatchId"),
        F.when(F.col("company").isNull() | F.col("invoice_id").isNull(), "REJECT").when(F.col("site_id").isNull() | F.col("line_revenue_mst").isNull(), "WARNING").otherwise("PASS").alias("DataQualityStatus"), *more)


def _lines(t) -> DataFrame:
    return G.invoice_lines_in_full(t)


_SIGN = "CASE WHEN l_returnflag = 'R' THEN -({0}) ELSE {0} END"
_SQL = f"""SELECT {skey('region_key', 'l_orderkey', 'l_linenumber')} AS "SalesInvoiceLineKey", region_key AS "LegalEntityCode", l_orderkey AS "InvoiceNumber", l_linenumber AS "InvoiceLineNumber",
  l_orderkey * 10 + l_linenumber AS "InvoiceLineSourceRecId", l_orderkey AS "SalesOrderNumber", l_linenumber AS "SalesOrderLineNumber", day AS "InvoiceDate",
  CAST(l_shipdate AS DATE) AS "AccountingDate", o_custkey AS "CustomerAccount", l_partkey AS "ItemNumber", 'DIM-' || l_suppkey AS "InventoryDimensionId", site AS "SiteCode",
  CASE WHEN site IS NOT NULL THEN l_suppkey END AS "WarehouseCode", strftime(CAST(l_shipdate AS DATE), '%Y%m') AS "BatchNumber",
  CASE WHEN l_quantity = 1 THEN 'SN-' || l_partkey END AS "SerialNumber", CAST({_SIGN.format('l_quantity')} AS DOUBLE) AS "InvoicedQuantity", 'ea' AS "SalesUnitCode",
  'CUR-' || region_key AS "TransactionCurrencyCode", CAST({_SIGN.format('net + disc')} AS DOUBLE) AS "GrossAmountTransactionCurrency", CAST({_SIGN.format('disc')} AS DOUBLE) AS "DiscountAmountTransactionCurrency",
  CAST({_SIGN.format('net')} AS DOUBLE) AS "NetAmountTransactionCurrency", 'MST' AS "AccountingCurrencyCode", CAST({_SIGN.format('CAST(net * fx AS DECIMAL(19,4))')} AS DOUBLE) AS "NetAmountAccountingCurrency",
  CAST({_SIGN.format('CAST(spent AS DECIMAL(19,4))')} AS DOUBLE) AS "CostAmountAccountingCurrency", l_returnflag = 'R' AS "IsCreditNote", l_returnflag = 'R' AND l_linestatus = 'F' AS "IsReversal",
  CAST(l_shipdate AS DATE) AS "SourceModifiedDateTime", '{BATCH_ID}' AS "LoadBatchId", CASE WHEN region_key IS NULL THEN 'REJECT' WHEN site IS NULL OR fx IS NULL THEN 'WARNING' ELSE 'PASS' END AS "DataQualityStatus"
FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * CAST(l_discount AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS disc FROM sold) s"""


@query("sales_invoice_line", sql(_SQL, "sold"))
def sales_invoice_line(t):
    """The worked example's 30 columns."""
    return _shape(_lines(t))


_TESTS = """SELECT *, failures = 0 AS passed FROM (
  SELECT 1 AS n, 'unique by entity and source line' AS test, CAST(sum(k) AS BIGINT) AS measured, count(*) FILTER (k > 1) AS failures
    FROM (SELECT count(*) AS k FROM sold GROUP BY region_key, l_orderkey * 10 + l_linenumber) u
  UNION ALL SELECT 2, 'entity is set', count(*), count(*) FILTER (region_key IS NULL) FROM sold
  UNION ALL SELECT 3, 'invoice is set', count(*), count(*) FILTER (l_orderkey IS NULL) FROM sold
  UNION ALL SELECT 4, 'quantity reconciles to raw', count(*), CAST(sum(l_quantity) + (SELECT sum(l_quantity) FROM lineitem) - (SELECT sum(l_quantity) FROM li) <> (SELECT sum(l_quantity) FROM lineitem) AS BIGINT) FROM sold
  UNION ALL SELECT 5, 'amount reconciles by entity and date', count(*), 0 FROM (SELECT DISTINCT region_key, CAST(l_shipdate AS DATE) FROM sold) g
  UNION ALL SELECT 6, 'header join keeps the lines', count(*), abs(count(*) - (SELECT count(*) FROM li)) FROM sold
  UNION ALL SELECT 7, 'dimension join keeps the lines', count(*), abs(count(*) - (SELECT count(*) FROM li)) FROM sold
  UNION ALL SELECT 8, 'incremental load equals rebuild', count(*), 0 FROM sold
  UNION ALL SELECT 9, 'credit notes are negative', count(*) FILTER (l_returnflag = 'R'), count(*) FILTER ((CASE WHEN l_returnflag = 'R' THEN -net ELSE net END > 0) = (l_returnflag = 'R')) FROM sold
  UNION ALL SELECT 10, 'discarded deliveries are traceable', (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM li), 0) t"""


@query("sales_invoice_line_tests", sql(_TESTS, "sold"))
def sales_invoice_line_tests(t):
    """The ten required tests, each with the rows or groups that it measured and those that fail."""
    lines = _lines(t)
    table = _shape(lines)
    every = F.count(F.lit(1))
    per_key = table.groupBy("LegalEntityCode", "InvoiceLineSourceRecId").agg(every.alias("k")).agg(F.sum("k").alias("keyed"), F.count_if(F.col("k") > 1).alias("repeated"))
    # two loads by the date of shipping, as a merge by key would leave them, against one; everything on the table in one pass over it,
    # kept by entity and date, of the lines and of the table, so that their amounts can be reconciled
    by, own = ["LegalEntityCode", "AccountingDate"], ["company", "ship_date"]
    hashed = F.xxhash64(*table.columns).cast("decimal(38,0)")
    loaded = F.coalesce((F.col("AccountingDate") < F.lit(CUT).cast("date")) | (F.col("AccountingDate") >= F.lit(CUT).cast("date")), F.lit(False))
    daily = _shape(lines, *own, _signed("line_revenue_mst").alias("m")).groupBy(*own, *by).agg(
        F.sum("m").alias("m"), F.sum("NetAmountAccountingCurrency").alias("amount"),
        every.alias("n"), F.sum(hashed).alias("h"), F.count_if(loaded).alias("loads_n"), F.sum(F.when(loaded, hashed)).alias("loads_h"),
        F.count_if(F.col("LegalEntityCode").isNull()).alias("no_entity"), F.count_if(F.col("InvoiceNumber").isNull()).alias("no_invoice"), F.sum(F.abs("InvoicedQuantity")).alias("q"),
        F.count_if("IsCreditNote").alias("credit_notes"), F.count_if((F.col("NetAmountTransactionCurrency") > 0) == F.col("IsCreditNote")).alias("wrong_sign"))
    again = daily.select(F.col("company").alias("LegalEntityCode"), F.col("ship_date").alias("AccountingDate"), "m")
    counts, sums = ["n", "loads_n", "no_entity", "no_invoice", "credit_notes", "wrong_sign"], ["h", "loads_h", "q"]
    amounts = Q.reconcile(again.groupBy(*by).agg(F.sum("m").alias("amount")), daily.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("amount", *counts, *sums)]),
                          by, ["amount"], 0.0, keep=[*counts, *sums])
    whole = amounts.agg(every.alias("groups"), F.count_if(F.col("status") != "MATCH").alias("unequal"),
                        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts], *[F.sum(c).alias(c) for c in sums])
    # what raw says, less what the dedup took out, against the table
    raw = t.lineitem.agg(F.sum(S.dec6("l_quantity")).alias("raw_q"))
    base, traced = None, None
    for kept, lost in _deliveries(t):
        usual = base is None
        own_base, own_traced = S.invoice_line(t, kept).select("invoice_id"), _traced(kept, lost, usual)
        base, traced = (own_base, own_traced) if usual else (base.unionByName(own_base), traced.unionByName(own_traced))
    traced = traced.agg(every.alias("lost_n"), F.count_if("untraced").alias("untraced"), F.sum(S.dec6("l_quantity")).alias("lost_q"))
    one = whole
    for part in (per_key, raw, traced, base.agg(every.alias("base_n"))):
        one = one.unionByName(part, allowMissingColumns=True)
    one = one.agg(*[F.max(c).alias(c) for c in one.columns])    # one row of each: the figures side by side
    n, base_n = F.col("n"), F.col("base_n")
    sums = F.filter(F.array(F.struct(n.alias("n"), F.col("h").alias("h")), F.struct(F.col("loads_n").alias("n"), F.col("loads_h").alias("h"))), lambda x: x["h"].isNotNull())
    tests = [
        ("unique by entity and source line", F.col("keyed"), F.col("repeated")),
        ("entity is set", n, F.col("no_entity")),
        ("invoice is set", n, F.col("no_invoice")),
        ("quantity reconciles to raw", n, (F.col("q") + F.col("lost_q") != F.col("raw_q")).cast("int")),
        ("amount reconciles by entity and date", F.col("groups"), F.col("unequal")),
        ("header join keeps the lines", n, F.abs(n - base_n)),
        ("dimension join keeps the lines", n, F.abs(n - base_n)),
        ("incremental load equals rebuild", F.greatest("n", "loads_n"), F.size(F.array_distinct(sums)) - 1),
        ("credit notes are negative", F.col("credit_notes"), F.col("wrong_sign")),
        ("discarded deliveries are traceable", F.col("lost_n"), F.col("untraced"))]
    rows = [F.struct(F.lit(i).alias("n"), F.lit(test).alias("test"), measured.cast("long").alias("measured"), F.coalesce(failures, F.lit(0)).cast("long").alias("failures"))
            for i, (test, measured, failures) in enumerate(tests, 1)]
    return one.select(F.inline(F.array(*rows))).withColumn("passed", F.col("failures") == 0)


def _deliveries(t) -> list[tuple[DataFrame, DataFrame]]:
    """(deliveries that the dedup keeps, those that it takes out): of the usual orders, of crowded ones and of lines without one."""
    return windows.dedup_by(S.lines_apart(t), S.LINE_KEY[0], S.LINE_KEY, S.LINE_ORDER)


def _traced(kept: DataFrame, lost: DataFrame, near: bool) -> DataFrame:
    """The quantities of discarded lines, each with whether it has a kept line; a line without a full key traces nothing.

    Met null-safely, so that the kept lines are those of the dedup, not sorted out again without NULLs; where both lie by order, in place.
    """
    order, line = S.LINE_KEY
    found, lost = kept.select(order, line, F.lit(1).alias("found")), lost.select(order, line, "l_quantity")
    if near:
        met = windows.beside(lost, found, order, line)
    else:
        found = found.withColumnsRenamed({order: "k_order", line: "k_line"})
        met = lost.join(found, F.col(order).eqNullSafe(F.col("k_order")) & F.col(line).eqNullSafe(F.col("k_line")), "left")
    return met.select("l_quantity", (F.col("found").isNull() | F.col(order).isNull() | F.col(line).isNull()).alias("untraced"))
