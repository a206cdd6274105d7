"""Key and hash expressions (all JVM-side built-ins).

Default key form is a delimited SHA-256 over canonicalised parts with an
explicit null token.  Backslash and separator inside a part are escaped by a
backslash, so no two different lists of parts have one text: ``('a', NULL)``,
``(NULL, 'a')``, ``('a|', '')``, ``('a', '|')`` and the text ``\\N`` all hash
differently.  ``md5_key`` keeps the plain
``MD5(CONCAT(...))`` form for parity with existing models (NULL in ⇒ NULL out).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the key format.
NULL_TOKEN = "\\N"
SEPARATOR = "|"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def part(s: Column) -> Column:
    """A part's unambiguous text: escaped, or the null token (which no escaped text equals)."""
    s = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    return F.coalesce(F.replace(s, F.lit(SEPARATOR), F.lit("\\" + SEPARATOR)), F.lit(NULL_TOKEN))


def canonical(c, upper: bool = True) -> Column:
    """Trimmed (and upper-cased) text form of a value; NULL becomes the null token.

    Callers pass numbers as integral or decimal types (a double's text form is
    engine-specific) and dates as DATE.
    """
    s = F.trim(_c(c).cast("string"))
    if upper:
        s = F.upper(s)
    return part(s)


def sha_key(*cols, upper: bool = True) -> Column:
    """SHA-256 hex of the delimited canonical parts."""
    return F.sha2(F.concat_ws(SEPARATOR, *[canonical(c, upper) for c in cols]), 256)


def md5_key(*cols) -> Column:
    """Parity form ``md5(concat(...))``: no delimiter, NULL if any part is NULL."""
    return F.md5(F.concat(*[_c(c).cast("string") for c in cols]))


def date_key(c) -> Column:
    """``yyyyMMdd`` integer key of a date/timestamp."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def row_hash(*cols) -> Column:
    """Order-sensitive, null-safe hash of a row's values (change detection)."""
    return F.sha2(F.concat_ws(SEPARATOR, *[part(_c(c).cast("string")) for c in cols]), 256)


def checksum(*cols) -> Column:
    """Per-row 32-bit checksum: first 8 hex digits of md5 as a bigint.

    Summing it gives an order-free table checksum that DuckDB reproduces.
    """
    body = F.concat_ws(SEPARATOR, *[part(_c(c).cast("string")) for c in cols])
    return F.conv(F.substring(F.md5(body), 1, 8), 16, 10).cast("bigint")
