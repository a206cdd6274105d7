"""Keyed window operators: latest-per-key, dedup with evidence, duplicates.

All of them are written so that a single hot key (say a third of all rows)
never ends up as one task holding the whole group:

* top-1 per key is ``row_number() = 1``; Spark plans it with a *partial*
  ``WindowGroupLimit`` before the shuffle, so each map task forwards at most
  one row per key;
* duplicate counts are a partially-aggregated ``groupBy(key).count()`` joined
  back (AQE splits a skewed join partition), not ``count(*) over (key)``;
* dedup evidence is computed on the multiset ``(row, copies)`` which is
  itself a map-side combined aggregate;
* ``apart`` tells the rows whose key is small enough to be brought together
  in one task, whole, from the others; ``dedup_by`` uses one exchange for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Keys of hash buckets with more rows than this are not brought together in one task.
TOGETHER_ROWS = 4_096
BUCKETS = 1 << 20


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def order_spec(df: DataFrame, order: Sequence) -> list[Column]:
    """Order expressions; strings ending in ' desc'/' asc' are parsed."""
    out = []
    for o in order:
        if isinstance(o, Column):
            out.append(o)
            continue
        name, _, direction = o.partition(" ")
        c = F.col(name)
        out.append(c.desc_nulls_last() if direction.strip().lower() == "desc" else c.asc_nulls_first())
    return out


def total_order(df: DataFrame, key, order: Sequence) -> list[Column]:
    """Append every remaining column so ties are broken deterministically."""
    used = set(_cols(key))
    for o in order:
        if isinstance(o, str):
            used.add(o.split(" ")[0])
    rest = [c for c in df.columns if c not in used]
    return order_spec(df, list(order) + rest)


def latest(df: DataFrame, key, order: Sequence, rank_col: str = "_rn") -> DataFrame:
    """One row per key: the first under ``order`` (e.g. ``['version desc']``)."""
    w = Window.partitionBy(*_cols(key)).orderBy(*order_spec(df, order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def dedup(df: DataFrame, key, order: Sequence) -> tuple[DataFrame, DataFrame]:
    """Keep the first row per key under a total order; return (kept, discarded).

    ``kept ⊎ discarded = df`` as multisets.  ``discarded`` is produced from the
    multiset form of ``df`` (identical rows collapsed map-side with a count),
    so an enormous duplicate group costs one aggregate row, not one task.
    """
    keys = _cols(key)
    kept = latest(df, keys, [o for o in total_order(df, keys, order)])
    cols = df.columns
    copies = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    winner = kept.select(*[F.col(c).alias(f"_w_{c}") for c in cols])
    same_key = [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in keys]
    cond = same_key[0]
    for c in same_key[1:]:
        cond = cond & c
    is_winner = F.lit(True)
    for c in cols:
        is_winner = is_winner & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    discarded = (copies.join(winner, cond, "left")
                 .withColumn("_n", F.col("_copies") - F.when(is_winner, 1).otherwise(0))
                 .filter(F.col("_n") > 0)
                 # long counts, given out a thousand at a time: no array grows with a group
                 .withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(1000))))
                 .withColumn("_j", F.explode(F.sequence(F.col("_i"), F.least(F.col("_i") + 999, F.col("_n") - 1))))
                 .select(*cols))
    return kept, discarded


def apart(df: DataFrame, key: str, most: int | None = None) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(rows whose key can be brought together in one task, rows of crowded keys or None, rows without a key or None).

    A job counts the rows of each hash bucket of ``key``, at most ``BUCKETS`` of them.  A bucket with more than ``most`` rows is
    crowded, so no key of the first frame has more; how many keys share a bucket decides about the way only, never about results.
    """
    most = TOGETHER_ROWS if most is None else most
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS))
    counts = df.groupBy(F.when(F.col(key).isNotNull(), bucket).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    found = [r.bucket for r in counts.filter(F.col("bucket").isNull() | (F.col("n") > most)).collect()]
    full = sorted(b for b in found if b is not None)
    keyed = df.filter(F.col(key).isNotNull())
    return (keyed.filter(~bucket.isin(full)) if full else keyed, keyed.filter(bucket.isin(full)) if full else None,
            df.filter(F.col(key).isNull()) if None in found else None)


def dedup_by(parts: Sequence[DataFrame | None], by: str, key, order: Sequence) -> list[tuple[DataFrame, DataFrame]]:
    """``dedup`` of each part of ``apart(df, by)`` that there is; ``by`` is one of the keys.

    The first part is brought together by ``by`` alone: kept and discarded rows come out of one exchange, which everything else
    that needs the rows by that column can share.
    """
    near, *others = parts
    rows = near.repartition(by)
    order = total_order(rows, key, order)
    rank = F.row_number().over(Window.partitionBy(*_cols(key)).orderBy(*order))
    discarded = rows.withColumn("_rn", rank).filter(F.col("_rn") > 1).drop("_rn")
    return [(latest(rows, key, order), discarded), *(dedup(x, key, order) for x in others if x is not None)]


def beside(rows: DataFrame, other: DataFrame, by: str, key: str) -> DataFrame:
    """Left join on ``by`` and (null-safely) ``key`` of frames that lie by ``by`` already, with few rows to a value of it (``apart``).

    A join on both columns would move both frames again.  So ``by`` alone is what they are joined on, and the rows of one value
    are compared in place, a comparison of numbers for each pair: at most ``TOGETHER_ROWS`` for a row.
    """
    other = other.withColumnsRenamed({by: "_by", key: "_key"})
    same = ((F.col(key) <= F.col("_key")) & (F.col(key) >= F.col("_key"))) | (F.col(key).isNull() & F.col("_key").isNull())
    return rows.join(other, (F.col(by) == F.col("_by")) & same, "left").drop("_by", "_key")


def duplicates(df: DataFrame, key, count_col: str = "dup_count") -> DataFrame:
    """Rows whose key occurs more than once, each with its key's row count."""
    keys = _cols(key)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)
    return df.join(counts, keys, "inner")


def with_key_count(df: DataFrame, key, count_col: str) -> DataFrame:
    keys = _cols(key)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    return df.join(counts, keys, "left")
