"""Amounts against amounts: running totals, allocation with remainder, reversals paired with originals, bitemporal segments.

Allocation and pairing order the rows of a key in one window, after one exchange, as long as it has up to ``KEY_ROWS`` rows.
Larger keys are spread: running totals and pairings order rows inside (key, period) and take over the totals of earlier
periods from one row per key and period, allocation orders inside (key, remainder class).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Keys with more rows than this are spread over several tasks.
KEY_ROWS = 200_000


def by_size(df: DataFrame, key: Sequence[str], most: int) -> Callable[[DataFrame, bool], DataFrame]:
    """A function that keeps, of a frame with ``key``, the rows of keys with more than ``most`` rows in ``df`` (True) or those of the others.

    There is at most one such key in ``most`` rows: their list is bounded by construction, and broadcast.
    """
    many = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > most)
    many = F.broadcast(many.select(*[F.col(k).alias(f"_big{i}") for i, k in enumerate(key)]))
    same = F.lit(True)
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_big{i}"))
    return lambda rows, large: rows.join(many, same, "left_semi" if large else "left_anti")


def running_total(df: DataFrame, key: Sequence[str], period: Column, order: Sequence[str], amount: str, before: str) -> DataFrame:
    """``before``: the sum of ``amount`` over the rows of the key that come earlier by (period, order).

    ``period`` must not decrease with ``order``.
    """
    rows = df.withColumn("_period", period)
    sums = rows.groupBy(*key, "_period").agg(F.sum(amount).alias("_sum"))
    ahead = Window.partitionBy(*key).orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_ahead", F.sum("_sum").over(ahead)).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col("_period").alias("_p"), "_ahead")
    on = F.col("_period") == F.col("_p")
    for i, k in enumerate(key):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    own = Window.partitionBy(*key, "_period").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(df.schema[amount].dataType)
    out = rows.withColumn("_own", F.sum(amount).over(own)).join(sums, on)
    return out.withColumn(before, F.coalesce("_own", zero) + F.coalesce("_ahead", zero)).drop("_period", "_own", "_p", "_ahead", *[f"_k{i}" for i in range(len(key))])


def allocate(lines: DataFrame, header: Sequence[str], line: Sequence[str], weight: str, total: str, out: str, scale: int = 2, most: int = KEY_ROWS) -> DataFrame:
    """The header's ``total`` (on each of its lines) dealt out by ``weight``, to the last digit.

    Every line gets its share cut off to ``scale`` digits, and the digits that are left go, one each, to the lines with the
    largest remainders (ties: by ``line``).  So the lines add up to the total, also a negative one.  Weights add up with
    their signs; a header whose weights add up to 0 gives its total to its lines in equal parts.  All in decimals.

    A header of up to ``most`` lines is dealt out in windows over its lines.  Of a larger one, only the lines of one remainder
    class (a 256th) have to be ordered: those of higher classes all get a digit, those of lower ones none.
    """
    of = by_size(lines, header, most)
    own = Window.partitionBy(*header)
    rows = of(lines, False).withColumns({"_w": F.sum(weight).over(own), "_n": F.count(F.lit(1)).over(own)})
    rows = _shares(rows, weight, total, scale).filter(F.col("_class").isNotNull())
    rows = rows.withColumn("_room", (F.col("_digits") - F.sum("_q").over(own)).cast("long"))
    rows = rows.withColumn("_more", (F.row_number().over(own.orderBy(F.desc("_r"), *line)) <= F.col("_room")).cast("int"))
    share = ((F.col("_q") + F.col("_more")) / 10 ** scale).cast(f"decimal(19,{scale})").alias(out)
    return rows.select(*lines.columns, share).unionByName(_shares_by_class(of(lines, True), header, line, weight, total, scale).select(*lines.columns, share))


def _shares(rows: DataFrame, weight: str, total: str, scale: int) -> DataFrame:
    """Adds a line's share cut off to whole digits (_q), the remainder (_r) and its class, and the header's digits; _w and _n are the header's."""
    digits = F.round(F.col(total) * 10 ** scale).cast("decimal(20,0)")
    # share = digits * weight / whole as quotient and remainder of whole numbers
    w = F.when(F.col("_w") == 0, F.lit(1)).otherwise(F.round(F.col(weight) * 10_000)).cast("decimal(18,0)")
    all_ = F.when(F.col("_w") == 0, F.col("_n")).otherwise(F.round(F.col("_w") * 10_000)).cast("decimal(18,0)")
    rows = rows.withColumn("_a", F.abs(all_)).withColumn("_x", (digits * w * F.signum(all_).cast("int")).cast("decimal(38,0)"))
    rows = rows.withColumn("_q", F.expr("(_x - pmod(_x, _a)) div _a").cast("decimal(20,0)")).withColumn("_r", F.pmod("_x", "_a").cast("decimal(18,0)"))
    return rows.withColumn("_class", F.floor(F.col("_r") * 256 / F.col("_a")).cast("int")).withColumn("_digits", digits)


def _shares_by_class(lines: DataFrame, header: Sequence[str], line: Sequence[str], weight: str, total: str, scale: int) -> DataFrame:
    """Lines of large headers with _q and _more, the digit that a line gets on top."""
    whole = lines.groupBy(*header).agg(F.sum(weight).alias("_w"), F.count(F.lit(1)).alias("_n"))
    on = [F.col(h).alias(f"_h{i}") for i, h in enumerate(header)]
    same = F.lit(True)
    for i, h in enumerate(header):
        same = same & F.col(h).eqNullSafe(F.col(f"_h{i}"))
    rows = _shares(lines.join(whole.select(*on, "_w", "_n"), same), weight, total, scale)
    classes = rows.groupBy(*header, "_class").agg(F.count(F.lit(1)).alias("_in"), F.sum("_q").alias("_sum"), F.first("_digits").alias("_all"))
    above = Window.partitionBy(*header).orderBy(F.desc("_class")).rowsBetween(Window.unboundedPreceding, -1)
    left = (F.first("_all").over(Window.partitionBy(*header)) - F.sum("_sum").over(Window.partitionBy(*header))).cast("long")
    classes = classes.withColumn("_room", left - F.coalesce(F.sum("_in").over(above), F.lit(0)))
    classes = classes.select(*[F.col(h).alias(f"_c{i}") for i, h in enumerate(header)], F.col("_class").alias("_cl"), "_in", "_room")
    same = F.col("_class") == F.col("_cl")
    for i, h in enumerate(header):
        same = same & F.col(h).eqNullSafe(F.col(f"_c{i}"))
    rows = rows.join(classes, same)
    sure = rows.filter((F.col("_room") <= 0) | (F.col("_room") >= F.col("_in"))).withColumn("_more", (F.col("_room") > 0).cast("int"))
    nth = F.row_number().over(Window.partitionBy(*header, "_class").orderBy(F.desc("_r"), *line))
    edge = rows.filter((F.col("_room") > 0) & (F.col("_room") < F.col("_in"))).withColumn("_more", (nth <= F.col("_room")).cast("int"))
    return sure.unionByName(edge)


def pair_reversals(originals: DataFrame, reversals: DataFrame, key: Sequence[str], order: Sequence[str], period: str, amount: str, step: int, most: int = KEY_ROWS) -> DataFrame:
    """K7: reversals matched to originals of their key, first to first, by running amounts.

    Both sides have ``key``, ``order``, ``period`` (a date that does not decrease with the order) and a positive ``amount``.  Laid
    end to end, originals and reversals cover stretches of the same axis; where two overlap, the reversal takes back that
    much of the original.  So one reversal may take back several originals, an original may be taken back by several,
    and what has no partner stays.  Rows: key, o_<order>, r_<order>, matched; an unmatched rest has NULLs on the other
    side.

    Keys of up to ``most`` rows are walked along their axis in one window.  For larger ones it is cut every ``step`` units, and
    stretches meet by (key, cut): such a key is not one task.
    """
    rows = [*key, *order, F.col(period).alias("_period"), F.col(amount).alias("_amount")]
    both = [df.filter(F.col(amount) > 0).select(*rows, F.lit(back).alias("_back")) for df, back in ((originals, False), (reversals, True))]
    both = both[0].unionByName(both[1])
    of = by_size(both, key, most)
    large = _pairs_by_cut(of(originals, True), of(reversals, True), key, order, period, amount, step)
    return _pairs_in_order(of(both, False), key, order).unionByName(large)


def _pairs_in_order(both: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Pairs and rests of rows (_amount, _back) whose keys fit a window each.

    Every start of a stretch, of either side, begins a piece of the axis that lies in the last stretch begun on each side; it
    ends with the next start or with the shorter of the two.  What a stretch has outside of the other side has no partner.
    Rows without a period come first and only take up their part of the axis.
    """
    keys, back, dated = list(key), F.col("_back"), F.col("_period").isNotNull()
    of_key = Window.partitionBy(*keys)
    laid = Window.partitionBy(*keys, "_back").orderBy("_period", *order).rowsBetween(Window.unboundedPreceding, -1)

    def others(which: Column) -> Column:
        """The sum of the other side's amounts where ``which`` holds."""
        o, r = (F.coalesce(F.sum(F.when((back == side) & which, F.col("_amount"))).over(of_key), F.lit(0)) for side in (False, True))
        return F.when(back, o).otherwise(r)
    rows = both.withColumns({"_from": F.coalesce(F.sum("_amount").over(laid), F.lit(0)), "_start": others(~dated), "_end": others(F.lit(True))})
    rows = rows.withColumn("_to", F.col("_from") + F.col("_amount")).withColumn("_own", F.struct(*order, "_period", "_to"))
    walk = of_key.orderBy("_from", "_back")
    o, r = (F.last(F.when(back == side, F.col("_own")), ignorenulls=True).over(walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)) for side in (False, True))
    rows = rows.withColumns({"_o": o, "_r": r, "_next": F.lead("_from").over(walk)})
    piece = F.least("_next", "_o._to", "_r._to") - F.col("_from")
    # a row with a NULL in its key or order has a rest as large as itself, and no key that is NULL has pairs
    keyed = named = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    for c in order:
        named = named & F.col(c).isNotNull()
    met = F.greatest(F.least("_to", "_end") - F.greatest("_from", "_start"), F.lit(0))
    rest = F.when(dated, F.when(keyed & named, F.col("_amount") - met).otherwise(F.col("_amount")))

    def row(left: dict, right: dict, matched: Column, is_matched: bool) -> Column:
        return F.struct(*[left[c].alias(f"o_{c}") for c in order], *[right[c].alias(f"r_{c}") for c in order], matched.alias("matched"), F.lit(is_matched).alias("is_matched"))
    own = {c: F.col(c) for c in order}
    pair = row({c: F.col("_o")[c] for c in order}, {c: F.col("_r")[c] for c in order}, F.when(keyed & F.col("_o._period").isNotNull() & F.col("_r._period").isNotNull(), piece), True)
    left = row({c: F.when(~back, own[c]) for c in order}, {c: F.when(back, own[c]) for c in order}, rest, False)
    return rows.select(*keys, F.inline(F.filter(F.array(pair, left), lambda x: x["matched"] > 0)))


def _pairs_by_cut(originals: DataFrame, reversals: DataFrame, key: Sequence[str], order: Sequence[str], period: str, amount: str, step: int) -> DataFrame:
    """Pairs and rests of keys of any size: stretches meet by (key, cut of the axis)."""
    keys = list(key)

    def laid(df: DataFrame, name: str) -> DataFrame:
        rows = running_total(df.filter(F.col(amount) > 0), keys, F.col(period), order, amount, "_from").withColumn("_to", F.col("_from") + F.col(amount))
        return rows.select(*keys, *[F.col(c).alias(f"{name}_{c}") for c in order], F.col("_from").alias(f"_{name}_from"), F.col("_to").alias(f"_{name}_to"))

    def cut(df: DataFrame, name: str) -> DataFrame:
        at = lambda c: F.floor(c / step).cast("long")
        last = F.ceil(F.col(f"_{name}_to") / step).cast("long") - 1
        return df.withColumn("_cut", F.explode(F.sequence(at(F.col(f"_{name}_from")), last)))

    o, r = laid(originals, "o"), laid(reversals, "r")
    both = cut(o, "o").join(cut(r, "r"), [*keys, "_cut"])
    low, high = F.greatest("_o_from", "_r_from"), F.least("_o_to", "_r_to")
    # a pair that meets in several cuts counts in the first
    both = both.withColumn("matched", high - low).filter((F.col("matched") > 0) & (F.col("_cut") == F.floor(low / step)))
    left, right = [f"o_{c}" for c in order], [f"r_{c}" for c in order]
    pairs = both.select(*keys, *left, *right, "matched")

    def rest(df: DataFrame, name: str, own: list[str]) -> DataFrame:
        used = pairs.groupBy(*keys, *own).agg(F.sum("matched").alias("_used"))
        return (df.join(used, [*keys, *own], "left").withColumn("matched", F.col(f"_{name}_to") - F.col(f"_{name}_from") - F.coalesce("_used", F.lit(0)))
                .filter(F.col("matched") > 0).select(*keys, *own, "matched"))
    out = pairs.withColumn("is_matched", F.lit(True))
    for name, df, own in (("o", o, left), ("r", r, right)):
        out = out.unionByName(rest(df, name, own).withColumn("is_matched", F.lit(False)), allowMissingColumns=True)
    return out


def bitemporal_segments(rows: DataFrame, key: Sequence[str], valid_from: str, valid_to: str, system_from: str, order: str, unit: str = "month") -> DataFrame:
    """K3: what was in force when, as far as the system knew: one row per key, stretch of validity and stretch of knowledge.

    A row states that its values hold in [valid_from, valid_to) (open if NULL), from ``system_from`` on, until a later row
    (by system_from, then ``order``) states something else about a part of that time.  So a correction cuts earlier rows:
    the axis of validity is split at all bounds of the key, and on each stretch the rows that cover it follow each other.
    Stretches and rows meet by (key, ``unit`` of the calendar); columns system_to and is_current are added, validity is
    that of the stretch.
    """
    keys = list(key)
    bounds = rows.select(*keys, F.explode(F.array(valid_from, valid_to)).alias("_at")).filter("_at IS NOT NULL").distinct()
    stretch = bounds.withColumn("_until", F.lead("_at").over(Window.partitionBy(*keys).orderBy("_at")))
    end = F.lit("9999-12-31").cast("date")
    first = lambda c: F.trunc(c, unit)
    # an open end meets stretches by the calendar as well, so it is closed at the key's last bound: the stretch from there on is open
    last = bounds.groupBy(*keys).agg(F.max("_at").alias("_last"))
    own = rows.join(last, keys).withColumn("_end", F.coalesce(F.col(valid_to), F.date_add("_last", 1)))
    own = own.filter(F.col(valid_from) < F.col("_end"))
    step = F.expr(f"INTERVAL 1 {unit}")
    own = own.withColumn("_unit", F.explode(F.sequence(first(F.col(valid_from)), first(F.date_sub("_end", 1)), step)))
    met = stretch.withColumn("_unit", first(F.col("_at"))).join(own, [*keys, "_unit"]).filter((F.col("_at") >= F.col(valid_from)) & (F.col("_at") < F.col("_end")))
    met = met.filter(F.col("_until").isNull() | F.col(valid_to).isNull() | (F.col("_until") <= F.col(valid_to)))
    w = Window.partitionBy(*keys, "_at").orderBy(system_from, order)
    met = met.withColumn("system_to", F.lead(system_from).over(w)).withColumn("is_current", F.col("system_to").isNull())
    others = [c for c in rows.columns if c not in (*keys, valid_from, valid_to)]
    return met.select(*keys, F.col("_at").alias(valid_from), F.when(F.coalesce("_until", end) < end, F.col("_until")).alias(valid_to), *others, "system_to", "is_current")


def as_known_grid(segments: DataFrame, key: Sequence[str], valid_from: str, valid_to: str, system_from: str, valid_at: Sequence[str], known_at: Sequence[str], values: Sequence[str]) -> DataFrame:
    """K3: per key and pair of two short lists (dates valid_at, times known_at) what was valid then, as known then."""
    def of(dates: Sequence[str], kind: str, start: str, end: str) -> Column:
        return F.explode(F.filter(F.array(*(F.lit(d).cast(kind) for d in dates)), lambda d: (d >= F.col(start)) & (F.col(end).isNull() | (d < F.col(end)))))

    kind = segments.schema[system_from].dataType.simpleString()
    inside = segments.withColumn("valid_at", of(valid_at, "date", valid_from, valid_to))
    return inside.withColumn("known_at", of(known_at, kind, system_from, "system_to")).select(*key, "valid_at", "known_at", *values)
