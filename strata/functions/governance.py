"""Governance expressions and operators: masking, tokenisation, row filters,
sensitive-column classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What stands for the hidden part of an address unless the caller says otherwise.
EMAIL_MASK = "***@masked"

# Detection patterns for sensitive-column classification.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+?[0-9][0-9 ()-]{7,}[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}",
}


def mask_email(email: Column, privileged: Column | bool, mask: str = EMAIL_MASK) -> Column:
    """Privileged readers see the value; others the first two characters and ``mask``."""
    priv = privileged if isinstance(privileged, Column) else F.lit(privileged)
    return F.when(priv, email).otherwise(F.concat(F.left(email, F.lit(2)), F.lit(mask)))


def tokenise(c: Column, secret: str) -> Column:
    """Keyed, deterministic token (SHA-256 of secret + value); NULL stays NULL."""
    return F.when(c.isNotNull(), F.sha2(F.concat(F.lit(secret), F.lit("|"), c.cast("string")), 256))


def drop_sensitive(df: DataFrame, sensitive: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Drop sensitive columns unless explicitly requested."""
    return df.drop(*[c for c in sensitive if c not in keep])


def row_filter(df: DataFrame, entitlements: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows for which an entitlement exists (``EXISTS`` as a left-semi join)."""
    return df.join(entitlements, list(on), "left_semi")


def visible_rows(df: DataFrame, entitlements: DataFrame, on: Sequence[str], user_col: str) -> DataFrame:
    """Row security for every user at once: ``(user, row)`` pairs the entitlements allow."""
    return df.join(entitlements.select(*on, user_col), list(on), "inner")


def classify(df: DataFrame, columns: Sequence[str], patterns: Mapping[str, str] = PATTERNS,
             threshold: float = 0.0) -> DataFrame:
    """Share of rows per column matching each pattern; class = best pattern above ``threshold``."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        for p, rx in patterns.items():
            aggs.append(F.count_if(F.col(c).cast("string").rlike(rx)).alias(f"{c}__{p}"))
    wide = df.agg(*aggs)
    items = ", ".join(f"'{c}', '{p}', `{c}__{p}`" for c in columns for p in patterns)
    long = wide.selectExpr("_rows", f"stack({len(columns) * len(patterns)}, {items}) AS (column_name, pattern, matches)")
    return long.select("column_name", "pattern", "matches", F.col("_rows").alias("rows"),
                       (F.col("matches").cast("double") / F.col("_rows").cast("double")).alias("match_rate"),
                       (F.col("matches").cast("double") / F.col("_rows").cast("double") > threshold).alias("is_sensitive"))
