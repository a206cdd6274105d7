"""Join operators: lookups, effective-dated (as-of) joins, unknown members,
orphans, fan-out guards.

No join here carries a broadcast hint unless the small side is bounded by
construction (a fixed enumeration).  Everything else is left to the planner
and AQE, which broadcast a side only after measuring it under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise run a
shuffled join whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN_KEY = "-1"


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def lookup(left: DataFrame, right: DataFrame, on, how: str = "left",
           unmatched_key: str | None = None, key_col: str | None = None,
           flag_col: str | None = None) -> DataFrame:
    """Left lookup join; optionally map unmatched rows to the unknown member.

    ``on`` is a list of shared column names or a join condition.  With
    ``unmatched_key``, ``key_col`` (a column of ``right``) is coalesced to
    that key and ``flag_col`` marks the rows that found no partner.
    """
    if unmatched_key is not None and key_col:
        right = right.withColumn("_matched", F.lit(True))
    out = left.join(right, on, how)
    if unmatched_key is not None and key_col:
        out = out.withColumn(key_col, F.coalesce(F.col(key_col).cast("string"), F.lit(unmatched_key)))
        out = out.withColumn(flag_col or "unmatched", F.col("_matched").isNull()).drop("_matched")
    return out


def valid_at(history: DataFrame, as_of: Column, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Versions whose interval contains ``as_of``: ``start <= as_of < coalesce(end, ∞)``."""
    return history.filter((F.col(start) <= as_of) & (F.col(end).isNull() | (as_of < F.col(end))))


def resolve_version(fact: DataFrame, history: DataFrame, fact_key: Sequence[str], hist_key: Sequence[str],
                    at: str, start: str = "valid_from", end: str = "valid_to",
                    unit: str = "year") -> DataFrame:
    """As-of join: attach the history version whose ``[start, end)`` contains ``fact.at``.

    Exact, and without comparing a fact with every version of its key:

    * ``unit`` only sets the size of the buckets, never which rows match;
    * closed versions are listed once per ``unit`` bucket (year/month/day)
      they overlap, and facts meet them by an equi join on ``(key, bucket)``
      with the range as a residual predicate;
    * the open-ended version (at most one per key) is met by an equi join on
      the key alone with ``at >= start``.

    Intervals of a key are disjoint, so each fact finds at most one partner
    across both joins; both are left joins and the fact's row count is
    unchanged.  History columns are returned once (coalesced over the two
    joins).  History column names must not clash with fact column names.
    """
    fk, hk = _cols(fact_key), _cols(hist_key)
    payload = list(history.columns)  # keys included: NULL when no version matched
    trunc_f = (lambda c: c) if unit == "day" else (lambda c: F.trunc(c, unit))
    opened = history.filter(F.col(end).isNull()).select(
        *[F.col(c).alias(f"_o_{c}") for c in history.columns])
    # an empty interval holds no instant; the last bucket is that of the last instant before the end
    last = F.to_date(F.col(f"_c_{end}").cast("timestamp_ntz") - F.expr("INTERVAL 1 MICROSECOND"))
    closed = (history.filter(F.col(start) < F.col(end))
              .select(*[F.col(c).alias(f"_c_{c}") for c in history.columns])
              .withColumn("_c_bucket", F.explode(F.sequence(
                  trunc_f(F.to_date(F.col(f"_c_{start}"))),
                  trunc_f(last),
                  F.expr(f"interval 1 {unit}")))))
    at_c = F.col(at)
    f = fact.withColumn("_f_bucket", trunc_f(F.to_date(at_c)))
    c1 = at_c >= F.col(f"_o_{start}")
    for a, b in zip(fk, hk):
        c1 = c1 & (F.col(a) == F.col(f"_o_{b}"))
    c2 = (F.col("_f_bucket") == F.col("_c_bucket")) & (at_c >= F.col(f"_c_{start}")) & (at_c < F.col(f"_c_{end}"))
    for a, b in zip(fk, hk):
        c2 = c2 & (F.col(a) == F.col(f"_c_{b}"))
    j = f.join(opened, c1, "left").join(closed, c2, "left")
    out = [F.col(c) for c in fact.columns]
    out += [F.coalesce(F.col(f"_c_{c}"), F.col(f"_o_{c}")).alias(c) for c in payload]
    return j.select(*out)


def orphans(child: DataFrame, parent: DataFrame, fk: Sequence[str], pk: Sequence[str]) -> DataFrame:
    """Children whose non-null foreign key has no parent (NULL FKs are not orphans)."""
    fk, pk = _cols(fk), _cols(pk)
    not_null = F.lit(True)
    for c in fk:
        not_null = not_null & F.col(c).isNotNull()
    p = parent.select(*[F.col(a).alias(f"_p{i}") for i, a in enumerate(pk)])
    cond = [F.col(a) == F.col(f"_p{i}") for i, a in enumerate(fk)]
    c = cond[0]
    for x in cond[1:]:
        c = c & x
    return child.filter(not_null).join(p, c, "left_anti")


def dated_chain(first: DataFrame, hops: Sequence[tuple[DataFrame, str, str]], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Rows joined through several dated hops, each with the period in which the whole chain held.

    ``first`` and every hop have the columns ``start`` and ``end`` (open if NULL, half-open).  A hop is (frame, column of the
    rows so far, column of the hop): an equi-join whose rows also have to overlap in time; the period is cut down to what both
    sides share.  Where a hop has a gap the chain has one, where it has overlapping rows the chain has several.
    """
    out = first
    for i, (hop, left, right) in enumerate(hops):
        own = hop.select(F.col(right).alias(f"_right{i}"), F.col(start).alias("_from"), F.col(end).alias("_to"), *[c for c in hop.columns if c not in (right, start, end, *out.columns)])
        meets = (F.col(left) == F.col(f"_right{i}")) & (F.col("_to").isNull() | (F.col(start) < F.col("_to"))) & (F.col(end).isNull() | (F.col("_from") < F.col(end)))
        out = out.join(own, meets).withColumn(start, F.greatest(start, "_from")).withColumn(end, F.least(end, "_to")).drop(f"_right{i}", "_from", "_to")
    return out


def fanout_check(left: DataFrame, joined: DataFrame, measure: str | None = None) -> DataFrame:
    """Row count (and total of ``measure``) before and after a join, as one row."""
    def side(df, tag):
        aggs = [F.count(F.lit(1)).alias("rows")]
        aggs.append(F.sum(measure).cast("double").alias("total") if measure else F.lit(None).cast("double").alias("total"))
        return df.agg(*aggs).withColumn("side", F.lit(tag))
    both = side(left, "before").unionByName(side(joined, "after"))
    out = both.groupBy().agg(
        F.max(F.when(F.col("side") == "before", F.col("rows"))).alias("rows_before"),
        F.max(F.when(F.col("side") == "after", F.col("rows"))).alias("rows_after"),
        F.max(F.when(F.col("side") == "before", F.col("total"))).alias("total_before"),
        F.max(F.when(F.col("side") == "after", F.col("total"))).alias("total_after"))
    return out.withColumn("fanout", F.col("rows_after") > F.col("rows_before"))
