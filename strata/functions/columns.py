"""Column-level cleansing expressions used by Silver projections.

Each helper returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen.  Table-level wrappers live in
``strata.operators.cleanse``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(code, mapping: Mapping, default=None) -> Column:
    """Map a code to its label with a literal map; unmapped → ``default`` (NULL by default).

    A NULL code stays NULL whatever the default (a missing code is not an
    unknown one).
    """
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    m = F.create_map(*items)
    label = F.element_at(m, _c(code)) if mapping else F.lit(None)
    if default is not None:
        label = F.when(_c(code).isNull(), F.lit(None)).otherwise(F.coalesce(label, F.lit(default)))
    return label


def blank_to_null(c) -> Column:
    return F.when(F.trim(_c(c)) == "", F.lit(None)).otherwise(_c(c))


def trim_upper(c) -> Column:
    return F.upper(F.trim(_c(c)))


def trim_lower(c) -> Column:
    return F.lower(F.trim(_c(c)))


def safe_cast(c, to: str) -> Column:
    """``try_cast`` (NULL on failure instead of an error under ANSI mode)."""
    return _c(c).try_cast(to)


def cast_failed(c, to: str) -> Column:
    """True where a non-blank value does not convert."""
    return _c(c).isNotNull() & (F.trim(_c(c).cast("string")) != "") & _c(c).try_cast(to).isNull()


def sentinel_to_null(c, sentinels: Sequence) -> Column:
    return F.when(_c(c).isin(*[F.lit(s) for s in sentinels]), F.lit(None)).otherwise(_c(c))


def flag_to_bool(c) -> Column:
    """Numeric / textual flag → boolean: 1/0, true/false, yes/no, y/n (case-insensitive)."""
    s = F.lower(F.trim(_c(c).cast("string")))
    return (F.when(s.isin("1", "true", "yes", "y", "t"), F.lit(True))
            .when(s.isin("0", "false", "no", "n", "f"), F.lit(False)))


def default_with_flag(c, default) -> tuple[Column, Column]:
    """(value with default, was-missing flag)."""
    return F.coalesce(_c(c), F.lit(default)), _c(c).isNull()


def by_precedence(sources: Sequence[tuple[str, Column]]) -> tuple[Column, Column]:
    """First non-null value in precedence order, and the name of the source used."""
    value = F.coalesce(*[_c(col) for _, col in sources])
    used = F.lit(None).cast("string")
    for name, col in reversed(list(sources)):
        used = F.when(_c(col).isNotNull(), F.lit(name)).otherwise(used)
    return value, used


def utc_local(ts, zone: str) -> tuple[Column, Column, Column]:
    """(UTC timestamp, local wall-clock timestamp, local date) from a UTC instant."""
    utc = _c(ts)
    local = F.from_utc_timestamp(utc.cast("timestamp"), zone)
    return utc, local, F.to_date(local)


def truncated(c, limit: int) -> Column:
    """True where a text value is at (or over) the export length limit."""
    return F.length(_c(c)) >= F.lit(limit)
