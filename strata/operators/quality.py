"""Data quality and reconciliation operators.

Rules are ``(name, severity, condition)`` with the condition in SQL text, so
the same rule list is evaluated by Spark (``F.expr``) and can be stated in
any SQL engine.  A rule *fails* when its condition is not TRUE (NULL fails).
All rules of a frame are evaluated in one projection (one pass, inside
whole-stage codegen); counts come from one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import checksum

# Dispositions in increasing severity.
SEVERITY = {"pass": 0, "warn": 1, "quarantine": 2, "reject": 3}
DISPOSITION = {0: "PASS", 1: "WARNING", 2: "QUARANTINE", 3: "REJECT"}


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    condition: str

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Array of the names of the rules a row fails (evaluated once per row)."""
    return F.filter(F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())


def severity_of(rules: Sequence[Rule]) -> Column:
    """Highest severity code among failing rules (0 = pass)."""
    return F.greatest(F.lit(0), *[F.when(~r.passed(), F.lit(SEVERITY[r.severity])).otherwise(0) for r in rules])


def expect(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per-rule pass/fail counts (rows are kept); one aggregate over the frame."""
    aggs = []
    for r in rules:
        aggs += [F.count_if(~r.passed()).alias(f"{r.name}__failed"), F.count_if(r.passed()).alias(f"{r.name}__passed")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{r.name}', '{r.severity}', `{r.name}__failed`, `{r.name}__passed`" for r in rules)
    return wide.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, severity, failed, passed)")


def expect_or_drop(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows passing every rule."""
    cond = F.lit(True)
    for r in rules:
        cond = cond & r.passed()
    return df.filter(cond)


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(passed, quarantined).  Warn-only failures stay in ``passed``.

    ``passed ⊎ quarantined = df``; the quarantined rows carry the failing rule
    names and their disposition.
    """
    tagged = df.withColumn("_sev", severity_of(rules)).withColumn("failed_rules", failed_rules(rules))
    passed = tagged.filter(F.col("_sev") <= SEVERITY["warn"]).drop("_sev")
    held = tagged.filter(F.col("_sev") > SEVERITY["warn"]).withColumn(
        "disposition", _disp(F.col("_sev"))).drop("_sev")
    return passed, held


def _disp(code: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in sorted(DISPOSITION.items(), reverse=True):
        out = F.when(code == k, F.lit(v)).otherwise(out)
    return out


def disposition(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """PASS / WARNING / QUARANTINE / REJECT per record."""
    return df.withColumn("disposition", _disp(severity_of(rules)))


def grain_unique(df: DataFrame, key) -> DataFrame:
    """One row — rows, distinct keys, duplicated keys, passed."""
    keys = _cols(key)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return (per_key.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                        F.count_if(F.col("_n") > 1).alias("duplicate_keys"))
            .withColumn("passed", F.col("duplicate_keys") == 0))


def grain_not_null(df: DataFrame, key) -> DataFrame:
    """One row — rows, rows with any key part NULL, passed."""
    keys = _cols(key)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return (df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(any_null).alias("null_keys"))
            .withColumn("passed", F.col("null_keys") == 0))


def key_profile(df: DataFrame, key, reuse_col: str, ts: str) -> DataFrame:
    """Per business key — rows, distinct values of ``reuse_col`` (reuse), first / last seen."""
    keys = _cols(key)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(reuse_col).alias("n_distinct_" + reuse_col),
        F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"),
    ).withColumn("is_duplicate", F.col("n_rows") > 1)


def key_usage(df: DataFrame, key, company: str, reuse_col: str, ts: str) -> DataFrame:
    """How a business key is used: one row per key with its rows, companies, distinct values of ``reuse_col``, first and last
    use and what that makes of it; and one row of NULL keys, with the rows that have a NULL in the key.

    ``finding``: ``missing`` (the NULL row), ``reused`` (several values of ``reuse_col`` in one company), ``shared``
    (several companies), ``duplicate`` (several rows), ``unique``.
    """
    keys = _cols(key)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    own = [F.when(whole, F.col(k)).alias(k) for k in keys]
    per = (df.select(*own, F.when(whole, F.col(company)).alias("_company"), F.col(reuse_col).alias("_value"), F.col(ts).alias("_ts"), whole.alias("_whole"))
           .groupBy(*keys, "_company", "_whole").agg(F.count(F.lit(1)).alias("_n"), F.count_distinct("_value").alias("_v"), F.min("_ts").alias("_a"), F.max("_ts").alias("_b")))
    out = per.groupBy(*keys, "_whole").agg(F.sum("_n").alias("n_rows"), F.count("_company").alias("companies"), F.max("_v").alias("values_in_company"),
                                           F.min("_a").alias("first_seen"), F.max("_b").alias("last_seen"))
    finding = (F.when(~F.col("_whole"), "missing").when(F.col("values_in_company") > 1, "reused").when(F.col("companies") > 1, "shared")
               .when(F.col("n_rows") > 1, "duplicate").otherwise("unique"))
    return out.withColumn("finding", finding).drop("_whole")


def load_evidence(df: DataFrame, key, company: str, amount: str, deleted: Column, rejected: Column) -> DataFrame:
    """The evidence of one load as one row per company: rows delivered, deletes, rejects, rows without a key, duplicate
    deliveries of a key, rows and amount that are left, and an order-free checksum of the keys and amounts left.

    A row counts once, by the first that holds of: no key, rejected, deleted, a key's further delivery.  The checksum separates its
    parts, so that ("1", "23") and ("12", "3") differ.
    """
    keys = _cols(key)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    state = F.when(~whole, "unkeyed").when(F.coalesce(rejected, F.lit(False)), "rejected").when(F.coalesce(deleted, F.lit(False)), "deleted").otherwise("kept")
    per = (df.select(*keys, F.col(company).alias("company"), F.col(amount).alias("_amount"), state.alias("_state"))
           .groupBy(*keys, "company", "_state").agg(F.count(F.lit(1)).alias("_n"), F.max("_amount").alias("_amount")))
    one = lambda s, c: F.sum(F.when(F.col("_state") == s, c).otherwise(0))
    digest = F.when(F.col("_state") == "kept", checksum(*keys, "_amount"))
    return per.groupBy("company").agg(F.sum("_n").alias("delivered"), *(one(s, F.col("_n")).alias(s) for s in ("unkeyed", "rejected", "deleted")),
                                      one("kept", F.col("_n") - 1).alias("duplicates"), one("kept", F.lit(1)).cast("long").alias("kept"),
                                      F.sum(F.when(F.col("_state") == "kept", F.col("_amount"))).alias("amount"), F.sum(digest).alias("checksum"))


def control_totals(df: DataFrame, by: Sequence[str], key: Sequence[str], amounts: Sequence[str],
                   date: str | None = None, checksum_cols: Sequence[str] | None = None) -> DataFrame:
    """Reconciliation control totals per group, one aggregate.

    rows, duplicate rows (rows beyond the first of each key), sums, min/max
    date and an order-free checksum (sum of a per-row 32-bit digest).
    """
    keys = list(key)
    per_key = df.groupBy(*by, *keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(a).alias(f"_s_{a}") for a in amounts],
        *([F.min(date).alias("_dmin"), F.max(date).alias("_dmax")] if date else []),
        F.sum(checksum(*(checksum_cols or df.columns))).alias("_ck"))
    out = per_key.groupBy(*by).agg(
        F.sum("_n").alias("rows"),
        F.sum(F.col("_n") - 1).alias("duplicate_rows"),
        *[F.sum(f"_s_{a}").alias(f"sum_{a}") for a in amounts],
        *([F.min("_dmin").alias("min_date"), F.max("_dmax").alias("max_date")] if date else []),
        F.sum("_ck").alias("checksum"))
    return out


def reconcile(source: DataFrame, target: DataFrame, by: Sequence[str], measures: Sequence[str],
              tolerance: float = 0.0, excluded: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Per group: source, target, excluded, difference and status.

    ``source`` / ``target`` / ``excluded`` are control-total frames keyed by
    ``by``; a group missing on one side is a difference, not dropped.
    Further columns of ``target`` that ``keep`` names are returned as they are.
    """
    by = list(by)
    s = source.select(*by, *[F.col(m).alias(f"src_{m}") for m in measures])
    t = target.select(*by, *[F.col(m).alias(f"tgt_{m}") for m in measures], *keep)
    j = s.join(t, by, "full_outer")
    if excluded is not None:
        e = excluded.select(*by, *[F.col(m).alias(f"excl_{m}") for m in measures])
        j = j.join(e, by, "full_outer")     # a group that only ``excluded`` has is a difference, too
    else:
        for m in measures:
            j = j.withColumn(f"excl_{m}", F.lit(0))
    ok = F.lit(True)
    for m in measures:
        diff = (F.coalesce(F.col(f"src_{m}"), F.lit(0)) - F.coalesce(F.col(f"tgt_{m}"), F.lit(0))
                - F.coalesce(F.col(f"excl_{m}"), F.lit(0)))
        j = j.withColumn(f"diff_{m}", diff)
        ok = ok & (F.abs(F.col(f"diff_{m}")) <= F.lit(tolerance))
    return j.withColumn("status", F.when(ok, "MATCH").otherwise("BREAK"))


def fk_rate(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Children, null FKs, orphans and the referential-integrity rate (null FKs reported apart)."""
    p = parent.select(F.col(pk).alias("_pk")).groupBy("_pk").agg(F.count(F.lit(1)).alias("_c"))
    j = child.select(fk).join(p, F.col(fk) == F.col("_pk"), "left")
    return (j.agg(F.count(F.lit(1)).alias("children"),
                  F.count_if(F.col(fk).isNull()).alias("null_fk"),
                  F.count_if(F.col(fk).isNotNull() & F.col("_pk").isNull()).alias("orphans"))
            .withColumn("integrity_rate",
                        F.when(F.col("children") - F.col("null_fk") > 0,
                               (F.col("children") - F.col("null_fk") - F.col("orphans")).cast("double")
                               / (F.col("children") - F.col("null_fk")).cast("double"))))


def sync_lag(df: DataFrame, by: str, ts: str, now: Column) -> DataFrame:
    """Latest sync per group and lag in minutes against an injected 'now'."""
    return (df.groupBy(by).agg(F.max(ts).alias("last_sync"))
            .withColumn("lag_minutes",
                        F.floor((F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_sync").cast("timestamp")))
                                / F.lit(60_000_000)).cast("bigint")))


def scorecard(df: DataFrame, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``(column, dimension, condition)`` → rate of rows meeting it, unpivoted."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (_, _, cond) in enumerate(checks):
        aggs.append(F.count_if(F.coalesce(F.expr(cond), F.lit(False))).alias(f"_c{i}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', '{d}', `_c{i}`" for i, (c, d, _) in enumerate(checks))
    return (wide.selectExpr("_rows", f"stack({len(checks)}, {stack}) AS (column_name, dimension, meeting)")
            .select("column_name", "dimension", "meeting", F.col("_rows").alias("rows"),
                    (F.col("meeting").cast("double") / F.col("_rows").cast("double")).alias("rate")))


def header_line_check(header: DataFrame, lines: DataFrame, key: str, header_total: str, line_amount: str,
                      tolerance: float) -> DataFrame:
    """Headers whose total differs from the sum of their lines by more than ``tolerance``."""
    s = lines.groupBy(key).agg(F.sum(line_amount).alias("line_total"))
    j = header.select(key, F.col(header_total).alias("header_total")).join(s, key, "left")
    j = j.withColumn("difference", F.col("header_total") - F.coalesce(F.col("line_total"), F.lit(0)))
    return j.filter(F.abs(F.col("difference")) > F.lit(tolerance))


def undecoded(df: DataFrame, code: str, labels: DataFrame, label_code: str) -> DataFrame:
    """Codes present in the data with no label, with their row counts."""
    counts = df.filter(F.col(code).isNotNull()).groupBy(code).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(labels.select(F.col(label_code).alias(code)), code, "left_anti")


def readiness(checks: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Union of single-row check results into ``(check, passed, observed)``."""
    out = None
    for name, df in checks:
        row = df.select(F.lit(name).alias("check"), F.col("passed"), F.col("observed").cast("string"))
        out = row if out is None else out.unionByName(row)
    return out


def assert_rebuild_equal(incremental: DataFrame, rebuild: DataFrame) -> DataFrame:
    """C17: sizes of both multiset differences (both 0 when incremental = rebuild)."""
    a = incremental.exceptAll(rebuild).agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("inc"))
    b = rebuild.exceptAll(incremental).agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("reb"))
    u = a.unionByName(b)
    return u.groupBy().agg(F.max(F.when(F.col("side") == "inc", F.col("n"))).alias("only_incremental"),
                           F.max(F.when(F.col("side") == "reb", F.col("n"))).alias("only_rebuild"))


def profile(df: DataFrame, name: str, deleted: Column | None, synced: str) -> DataFrame:
    """Rows, soft-deleted rows and latest sync of a raw table, one aggregate."""
    dele = F.count_if(deleted) if deleted is not None else F.lit(0).cast("bigint")
    return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                  dele.alias("soft_deleted"), F.max(synced).cast("timestamp_ntz").alias("latest_sync"))


def layer_counts(frames: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """H1: row count per layer/table, stacked with ``unionByName``."""
    out = None
    for name, df in frames:
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer_table"), "rows")
        out = row if out is None else out.unionByName(row)
    return out
