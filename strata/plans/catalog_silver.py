"""Named queries of the Silver column operators (2.B), keys (2.I), lookups (2.D) and governance (2.P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.functions import governance as GV
from strata.functions.keys import date_key, md5_key, row_hash, sha_key
from strata.operators import joins
from strata.plans import gold as G
from strata.plans import silver as S
from strata.plans.catalog import dbl
from strata.plans.oracle import dkey, rhash, skey, sql
from strata.plans.registry import query

# Fixed values of the fixture rules.
SENTINEL_DATES = ("1900-01-01", "1995-01-01", "9999-12-31")
LOCAL_ZONE = "Europe/Amsterdam"
TEXT_LIMIT = 4000
STATUS_LABELS = {"O": "Open", "F": "Invoiced", "P": "Delivered"}
TOKEN_SECRET = "strata-fixture-secret"


@query("column_whitelist", "SELECT event_id, user_id, value, ts FROM events")
def column_whitelist(t):
    """B1: whitelist (user_id, value) plus key and system columns, after positional mapping."""
    from strata.sources import ingest
    return ingest.select_columns(t.events, ["user_id", "value"], key=["event_id"], system=["ts"])


@query("active_records", "SELECT * FROM events WHERE NOT coalesce(event_type = 'error', false)")
def active_records(t):
    """Null-safe active-row filter (NULL flag = active)."""
    from strata.operators import cleanse
    return cleanse.active_records(t.events.withColumn("is_delete", F.col("event_type") == "error"),
                                  "is_delete").drop("is_delete")


@query("decode_enum", """SELECT o_orderkey, o_orderstatus,
  CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Invoiced' WHEN 'P' THEN 'Delivered' ELSE 'Unknown' END AS status_label
FROM orders""")
def decode_enum(t):
    """Option-set decode with caller default; code kept beside the label."""
    return t.orders.select("o_orderkey", "o_orderstatus",
                           C.decode(F.col("o_orderstatus"), STATUS_LABELS, "Unknown").alias("status_label"))


@query("standardise_text", """SELECT c_custkey, trim(c_name) AS name_std, upper(trim(c_mktsegment)) AS segment_std,
  lower(trim(replace(c_name, '#', '.') || '@Example.COM')) AS email_std FROM customer""")
def standardise_text(t):
    """Trim, upper-case codes, lower-case e-mail."""
    return t.customer.select("c_custkey", F.trim("c_name").alias("name_std"),
                             C.trim_upper("c_mktsegment").alias("segment_std"),
                             C.trim_lower(F.concat(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")),
                                                   F.lit("@Example.COM"))).alias("email_std"))


@query("safe_cast_report", """SELECT 'o_orderpriority' AS column_name, count(*) AS rows,
  count(*) FILTER (WHERE o_orderpriority IS NOT NULL AND trim(o_orderpriority) <> '' AND TRY_CAST(o_orderpriority AS INTEGER) IS NULL) AS failed
FROM orders
UNION ALL SELECT 'priority_code', count(*),
  count(*) FILTER (WHERE TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) IS NULL) FROM orders
UNION ALL SELECT 'props', count(*),
  count(*) FILTER (WHERE props IS NOT NULL AND trim(props) <> '' AND TRY_CAST(props AS INTEGER) IS NULL) FROM events""")
def safe_cast_report(t):
    """Invalid values counted, never silently lost (try_cast + failure flag)."""
    o = t.orders
    a = o.agg(F.lit("o_orderpriority").alias("column_name"), F.count(F.lit(1)).alias("rows"),
              F.count_if(C.cast_failed(F.col("o_orderpriority"), "int")).alias("failed"))
    code = F.split("o_orderpriority", "-", 2).getItem(0)
    b = o.agg(F.lit("priority_code").alias("column_name"), F.count(F.lit(1)).alias("rows"),
              F.count_if(C.safe_cast(code, "int").isNull()).alias("failed"))
    c = t.events.agg(F.lit("props").alias("column_name"), F.count(F.lit(1)).alias("rows"),
                     F.count_if(C.cast_failed(F.col("props"), "int")).alias("failed"))
    return a.unionByName(b).unionByName(c)


@query("blank_to_null", """SELECT c_custkey, nullif(substr(c_name, CAST(12 + c_custkey % 9 AS INTEGER)), '') AS name_suffix FROM customer""")
def blank_to_null(t):
    """Declared blank → NULL rule (what follows a varying place of the name, blank past its end)."""
    suffix = F.expr("substr(c_name, cast(12 + c_custkey % 9 as int))")
    return t.customer.select("c_custkey", C.blank_to_null(suffix).alias("name_suffix"))


@query("sentinel_dates", """SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) IN (DATE '1900-01-01', DATE '1995-01-01',
  DATE '9999-12-31') THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date FROM orders""")
def sentinel_dates(t):
    """Sentinel dates become NULL by rule."""
    return t.orders.select("o_orderkey", C.sentinel_to_null(F.to_date("o_orderdate"),
                                                            [F.lit(d).cast("date") for d in SENTINEL_DATES])
                           .alias("order_date"))


@query("utc_local", f"""SELECT event_id, ts AS ts_utc, (ts AT TIME ZONE 'UTC') AT TIME ZONE '{LOCAL_ZONE}' AS ts_local,
  CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE '{LOCAL_ZONE}' AS DATE) AS date_local FROM events""")
def utc_local(t):
    """UTC, local wall-clock time and local date (DST-safe zone rules)."""
    utc, local, d = C.utc_local(F.col("ts"), LOCAL_ZONE)
    return t.events.select("event_id", utc.alias("ts_utc"), local.cast("timestamp_ntz").alias("ts_local"),
                           d.alias("date_local"))


@query("flag_to_bool", """SELECT doc_id, CASE WHEN quality = 1 THEN true WHEN quality = 0 THEN false END AS is_quality,
  CASE WHEN toxic = 1 THEN true WHEN toxic = 0 THEN false END AS is_toxic FROM labels""")
def flag_to_bool(t):
    """Numeric flags to booleans."""
    return t.labels.select("doc_id", C.flag_to_bool("quality").alias("is_quality"),
                           C.flag_to_bool("toxic").alias("is_toxic"))


@query("scope_company", sql("""SELECT customer_account, company, company IN (1, 3) AS in_scope FROM cust""", "cust"))
def scope_company(t):
    """Tag rows with their company and whether it is in the scoped set."""
    c = S.customer(t)
    return c.select("customer_account", "company", F.col("company").isin(1, 3).alias("in_scope"))


@query("default_with_flag", sql("""SELECT c.customer_account, coalesce(a.city, 'UNKNOWN') AS primary_city,
  a.city IS NULL AS city_was_missing
FROM cust c LEFT JOIN (SELECT * FROM ah WHERE valid_from <= DATE '1995-06-30' AND (valid_to IS NULL OR DATE '1995-06-30' < valid_to)) a
  ON c.nation_key = a.nation_key""", "cust", "ah"))
def default_with_flag(t):
    """Default for a missing value plus a separate was-missing flag (address valid mid-1995)."""
    c = S.customer(t)
    a = joins.valid_at(S.address_history(t), F.lit("1995-06-30").cast("date")).select(
        F.col("nation_key").alias("a_nation"), "city")
    j = c.join(a, c.nation_key == a.a_nation, "left")
    v, missing = C.default_with_flag(F.col("city"), "UNKNOWN")
    return j.select("customer_account", v.alias("primary_city"), missing.alias("city_was_missing"))


@query("by_precedence", sql("""SELECT c.customer_account, coalesce(a.city, n.n_name) AS location,
  CASE WHEN a.city IS NOT NULL THEN 'address' WHEN n.n_name IS NOT NULL THEN 'nation' END AS source_used
FROM cust c LEFT JOIN (SELECT * FROM ah WHERE valid_from <= DATE '1995-06-30' AND (valid_to IS NULL OR DATE '1995-06-30' < valid_to)) a
  ON c.nation_key = a.nation_key LEFT JOIN nation n ON c.nation_key = n.n_nationkey""", "cust", "ah"))
def by_precedence(t):
    """Attribute from the first source that has it, with the source used."""
    c = S.customer(t)
    a = joins.valid_at(S.address_history(t), F.lit("1995-06-30").cast("date")).select(
        F.col("nation_key").alias("a_nation"), "city")
    n = t.nation.select("n_nationkey", "n_name")
    j = c.join(a, c.nation_key == a.a_nation, "left").join(n, c.nation_key == n.n_nationkey, "left")
    v, used = C.by_precedence([("address", F.col("city")), ("nation", F.col("n_name"))])
    return j.select("customer_account", v.alias("location"), used.alias("source_used"))


# The mapping rows (silver column, raw table, raw column, rule) of the invoice line.
LINE_MAPPING = [
    ("invoice_id", "lineitem", "l_orderkey", "l_orderkey"),
    ("line_num", "lineitem", "l_linenumber", "l_linenumber"),
    ("item_id", "lineitem", "l_partkey", "l_partkey"),
    ("qty", "lineitem", "l_quantity", "CAST(l_quantity AS DECIMAL(19,6))"),
    ("gross_amount", "lineitem", "l_extendedprice", "CAST(l_extendedprice AS DECIMAL(19,4))"),
    ("return_flag", "lineitem", "l_returnflag", "upper(trim(l_returnflag))"),
]


@query("mapping_projection", "SELECT " + ", ".join(f"{rule} AS {name}" for name, _, _, rule in LINE_MAPPING)
       + " FROM lineitem")
def mapping_projection(t):
    """Projection generated from mapping rows (the mapping doubles as lineage)."""
    from strata.operators import cleanse
    return cleanse.from_mapping(t.lineitem, LINE_MAPPING)


@query("truncated_flags", f"""SELECT doc_id AS record_id, length(text) AS text_length, length(text) >= {TEXT_LIMIT} AS is_truncated
FROM documents""")
def truncated_flags(t):
    """Normalise the id column name and flag values at the export length limit."""
    d = t.documents
    return d.select(F.col("doc_id").alias("record_id"), F.length("text").alias("text_length"),
                    C.truncated(F.col("text"), TEXT_LIMIT).alias("is_truncated"))


@query("sha_key", f"""SELECT c_custkey, {skey('c_custkey', 'n_regionkey')} AS customer_key
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def sha_key_q(t):
    """2.I: delimited SHA-256 business key with null token."""
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return c.select("c_custkey", sha_key("c_custkey", "n_regionkey").alias("customer_key"))


@query("md5_key", """SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR) || CAST(n_regionkey AS VARCHAR)) AS customer_md5
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def md5_key_q(t):
    """2.I: parity MD5(CONCAT()) key."""
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return c.select("c_custkey", md5_key("c_custkey", "n_regionkey").alias("customer_md5"))


@query("date_key", f"SELECT o_orderkey, {dkey('o_orderdate')} AS order_date_key FROM orders")
def date_key_q(t):
    """2.I: yyyyMMdd integer date key."""
    return t.orders.select("o_orderkey", date_key("o_orderdate").alias("order_date_key"))


@query("row_hash", f"""SELECT c_custkey, {rhash('c_name', 'c_nationkey', 'CAST(c_acctbal AS DECIMAL(19,4))', 'c_mktsegment')} AS row_hash
FROM customer""")
def row_hash_q(t):
    """2.I: null-safe row hash for change detection."""
    return t.customer.select("c_custkey", row_hash("c_name", "c_nationkey", S.dec4("c_acctbal"),
                                                   "c_mktsegment").alias("row_hash"))


@query("lookup_join", sql("""SELECT o.o_orderkey, o.o_custkey, c.customer_name, c.customer_group
FROM orders o LEFT JOIN cust c ON o.o_custkey = c.customer_account""", "cust"))
def lookup_join(t):
    """Lookup left join by foreign key."""
    c = S.customer(t).select("customer_account", "customer_name", "customer_group")
    return joins.lookup(t.orders.select("o_orderkey", "o_custkey"), c,
                        F.col("o_custkey") == F.col("customer_account")).drop("customer_account")


@query("unknown_member", f"""SELECT o.o_orderkey, coalesce(CAST(p.o_custkey_parent AS VARCHAR), '-1') AS customer_key,
  p.o_custkey_parent IS NULL AS unmatched
FROM orders o LEFT JOIN (SELECT c_custkey AS o_custkey_parent FROM customer WHERE c_acctbal >= 0) p
  ON o.o_custkey = p.o_custkey_parent""")
def unknown_member(t):
    """Unmatched lookups map to the unknown member (-1) and are flagged."""
    parent = t.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey_parent"))
    out = joins.lookup(t.orders.select("o_orderkey", "o_custkey"), parent,
                       F.col("o_custkey") == F.col("o_custkey_parent"), unmatched_key=joins.UNKNOWN_KEY,
                       key_col="o_custkey_parent", flag_col="unmatched")
    return out.select("o_orderkey", F.col("o_custkey_parent").alias("customer_key"), "unmatched")


@query("valid_at", sql("""SELECT * FROM ah WHERE valid_from <= DATE '2001-08-31' AND (valid_to IS NULL OR DATE '2001-08-31' < valid_to)""",
                       "ah") .replace("SELECT * FROM ah", "SELECT * REPLACE (CAST(rate AS DOUBLE) AS rate) FROM ah"))
def valid_at(t):
    """Versions valid at an as-of date (parameter, not the clock)."""
    return joins.valid_at(S.address_history(t), F.lit(G.AS_OF).cast("date"))


@query("role_lookup", sql("""SELECT o.o_orderkey, sold.customer_name AS sold_to_name, ship.party_name AS ship_from_name
FROM orders o LEFT JOIN (SELECT l_orderkey, arg_min(l_suppkey, l_linenumber) AS l_suppkey FROM li GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
LEFT JOIN cust sold ON o.o_custkey = sold.customer_account
LEFT JOIN party ship ON 'S' || CAST(l.l_suppkey AS VARCHAR) = ship.party_id""", "li", "cust", "party"))
def role_lookup(t):
    """The same party lookup joined twice under different roles (sold-to customer, ship-from supplier)."""
    p = S.party(t)
    sold = S.customer(t).select(F.col("customer_account").alias("sold_acct"), F.col("customer_name").alias("sold_to_name"))
    ship = p.select(F.col("party_id").alias("ship_id"), F.col("party_name").alias("ship_from_name"))
    lines = S._line_base(t).groupBy("l_orderkey").agg(F.min_by("l_suppkey", "l_linenumber").alias("l_suppkey"))   # the order's first line
    j = t.orders.select("o_orderkey", "o_custkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    j = joins.lookup(j, sold, F.col("o_custkey") == F.col("sold_acct"))
    j = joins.lookup(j, ship, F.concat(F.lit("S"), F.col("l_suppkey").cast("string")) == F.col("ship_id"))
    return j.select("o_orderkey", "sold_to_name", "ship_from_name")


@query("mask_email", """SELECT c_custkey, lower(replace(c_name, '#', '.') || '@example.com') AS email_privileged,
  left(lower(replace(c_name, '#', '.') || '@example.com'), 2) || '***@masked' AS email_masked FROM customer""")
def mask_email(t):
    """E-mail masking for non-privileged readers."""
    email = F.lower(F.concat(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")), F.lit("@example.com")))
    return t.customer.select("c_custkey", GV.mask_email(email, True).alias("email_privileged"),
                             GV.mask_email(email, False).alias("email_masked"))


@query("tokenise", f"""SELECT c_custkey, sha256('{TOKEN_SECRET}' || '|' || c_name) AS name_token, c_mktsegment FROM customer""")
def tokenise(t):
    """Sensitive column replaced by a keyed token; the raw name is dropped."""
    c = t.customer.withColumn("name_token", GV.tokenise(F.col("c_name"), TOKEN_SECRET))
    return GV.drop_sensitive(c, ["c_name", "c_acctbal", "c_nationkey"]).select("c_custkey", "name_token", "c_mktsegment")


def _entitled(t):
    """(user_name, nation) of each region's analyst, and (o_orderkey, nation) of the orders."""
    ent = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select(F.concat(F.lit("analyst_"), F.col("r_name")).alias("user_name"), F.col("n_nationkey").alias("nation")))
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_nationkey").alias("nation"))
    return ent, o


@query("row_filter", """SELECT o.o_orderkey, c.c_nationkey AS nation FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE EXISTS (SELECT 1 FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey = c_nationkey AND r_name IN ('ASIA', 'EUROPE'))""")
def row_filter(t):
    """Existence-based row security — the orders that a reader with two regions (each granted twice) may see, each once."""
    ent, o = _entitled(t)
    mine = ent.filter(F.col("user_name").isin("analyst_ASIA", "analyst_EUROPE"))
    return GV.row_filter(o, mine.unionByName(mine), ["nation"])


@query("visible_rows", """SELECT 'analyst_' || r.r_name AS user_name, o.o_orderkey
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")
def visible_rows(t):
    """For every regional analyst the orders they may see."""
    ent, o = _entitled(t)
    return GV.visible_rows(o, ent, ["nation"], "user_name").select("user_name", "o_orderkey")


@query("classify_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{p}' AS pattern, count(*) FILTER (WHERE regexp_matches(CAST({c} AS VARCHAR), '{rx}')) AS matches, "
    f"count(*) AS rows, CAST(count(*) FILTER (WHERE regexp_matches(CAST({c} AS VARCHAR), '{rx}')) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS match_rate, "
    f"CAST(count(*) FILTER (WHERE regexp_matches(CAST({c} AS VARCHAR), '{rx}')) AS DOUBLE) / CAST(count(*) AS DOUBLE) > 0.0 AS is_sensitive "
    f"FROM documents" for c in ("text", "source") for p, rx in GV.PATTERNS.items()))
def classify_columns(t):
    """Sensitive-column classification by pattern match rates."""
    return GV.classify(t.documents, ["text", "source"])
