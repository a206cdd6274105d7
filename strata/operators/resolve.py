"""Resolution of codes, amounts and parents: option labels, effective-dated conversion, late parents, bridges,
bitemporal history, dimension finishing, and the pattern of a plain Silver table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.keys import row_hash, sha_key
from strata.operators import joins, windows


def resolve_label(df: DataFrame, options: DataFrame, option_set: str, code: str, label: str, language: int = 1033) -> DataFrame:
    """The label of ``code`` in one option set and language (NULL where there is none).

    ``options``: (option_set, code, language, label); set and language are filtered before the join.
    """
    names = (options.filter((F.col("option_set") == option_set) & (F.col("language") == language))
             .groupBy(F.col("code").alias("_code")).agg(F.min("label").alias(label)))
    return df.join(names, F.col(code) == F.col("_code"), "left").drop("_code")


def resolve_multi_label(df: DataFrame, options: DataFrame, option_set: str, codes: str, code: str, label: str, language: int = 1033) -> DataFrame:
    """D3: one row per code of a comma list, with its label; a row without codes stays as one row, a part that is no number has NULL for a code."""
    parts = df.withColumn(code, F.explode_outer(F.split(codes, ","))).withColumn(code, F.trim(code).try_cast("int"))
    return resolve_label(parts, options, option_set, code, label, language)


def with_audit(df: DataFrame, system: str, table: str, row_id: str, batch_id: str, run_id: str, loaded_at: Column, payload: Sequence[str],
               quality: Column | None = None) -> DataFrame:
    """Where a row comes from, what it held and which run loaded it."""
    return df.select("*", F.lit(system).alias("_source_system"), F.lit(table).alias("_source_table"), F.col(row_id).cast("string").alias("_source_row_id"),
                     row_hash(*payload).alias("_record_hash"), loaded_at.alias("_ingested_at"), F.lit(batch_id).alias("_batch_id"),
                     F.lit(run_id).alias("_run_id"), (F.lit("PASS") if quality is None else quality).alias("_dq_status"))


def split_posted(df: DataFrame, status: str, posted: Sequence) -> tuple[DataFrame, DataFrame]:
    """(posted, unposted) rows; a NULL status is not posted."""
    yes = F.coalesce(F.col(status).isin(*posted), F.lit(False))
    return df.filter(yes), df.filter(~yes)


def convert(df: DataFrame, rates: DataFrame, key: str, rate_key: str, at: str, amount: str, out: str, scale: int = 2, rate: str = "rate") -> DataFrame:
    """``amount`` times the rate in force at ``at``, rounded half up to ``scale`` (NULL without a rate)."""
    own = rates.select(F.col(rate_key).alias("_rate_key"), F.col("valid_from").alias("_rate_from"), F.col("valid_to").alias("_rate_to"), F.col(rate).alias("_rate"))
    found = joins.resolve_version(df, own, [key], ["_rate_key"], at=at, start="_rate_from", end="_rate_to")
    return found.withColumn(out, F.round(F.col(amount) * F.col("_rate"), scale).cast(f"decimal(19,{scale})")).drop("_rate_key", "_rate_from", "_rate_to", "_rate")


def resolve_late(children: DataFrame, parents: Sequence[DataFrame], fk: str, pk: str, attribute: str) -> DataFrame:
    """Children with the parent's attribute and the batch (from 1) in which the parent came; unresolved ones stay, with NULLs."""
    every = None
    for i, p in enumerate(parents):
        own = p.select(F.col(pk).alias("_pk"), F.col(attribute).alias(attribute), F.lit(i + 1).alias("resolved_in"))
        every = own if every is None else every.unionByName(own)
    first = every.groupBy("_pk").agg(F.min(F.struct("resolved_in", attribute)).alias("_p"))
    return (children.join(first, F.col(fk) == F.col("_pk"), "left")
            .select(*children.columns, F.col(f"_p.{attribute}").alias(attribute), F.col("_p.resolved_in").alias("resolved_in")))


def bridge(df: DataFrame, left: str, right: str) -> DataFrame:
    """Distinct pairs, each with the weight 1 / (pairs of its left member)."""
    pairs = df.select(left, right).distinct()
    n = pairs.groupBy(F.col(left).alias("_left")).agg(F.count(F.lit(1)).alias("_n"))
    return pairs.join(n, F.col(left) == F.col("_left")).select(left, right, (F.lit(1.0) / F.col("_n")).alias("weight"))


def bitemporal(rows: DataFrame, key: str, valid_from: str, system_from: str) -> DataFrame:
    """K3: a statement (key, valid_from) is in force in the system until the next one about the same."""
    w = Window.partitionBy(key, valid_from).orderBy(system_from)
    return rows.withColumn("system_to", F.lead(system_from).over(w))


def as_known(history: DataFrame, key: str, valid_from: str, system_from: str, valid_at: Column, known_at: Column) -> DataFrame:
    """K3: per key what was valid at ``valid_at`` as the system knew it at ``known_at``."""
    seen = history.filter((F.col(system_from) <= known_at) & (F.col("system_to").isNull() | (known_at < F.col("system_to"))) & (F.col(valid_from) <= valid_at))
    return windows.latest(seen, key, [f"{valid_from} desc", f"{system_from} desc"])


def header_attributes(lines: DataFrame, headers: DataFrame, fk: str, pk: str, attributes: Sequence[str]) -> DataFrame:
    """The named header attributes on each line.  Amounts of the header are not among them, so no sum repeats them."""
    own = headers.select(F.col(pk).alias("_pk"), *attributes)
    return lines.join(own, F.col(fk) == F.col("_pk"), "left").drop("_pk")


def open_balance(receivables: DataFrame, settlements: DataFrame, key: str, settled_key: str, amount: str, settled: str) -> DataFrame:
    """Posted amount less what has been settled, per transaction."""
    paid = settlements.groupBy(F.col(settled_key).alias("_key")).agg(F.sum(settled).alias("settled_amount"))
    out = receivables.join(paid, F.col(key) == F.col("_key"), "left").drop("_key")
    out = out.withColumn("settled_amount", F.coalesce("settled_amount", F.lit(0).cast("decimal(19,4)")).cast("decimal(19,4)"))
    return out.withColumn("open_amount", (F.col(amount) - F.col("settled_amount")).cast("decimal(19,4)"))


def finish_dimension(dim: DataFrame, key: Sequence[str], surrogate: str, unknown: Mapping[str, object]) -> DataFrame:
    """Surrogate key and one row for the unknown member (key -1; columns that ``unknown`` does not name are NULL)."""
    keyed = dim.select(sha_key(*key).alias(surrogate), *dim.columns)
    row = dim.sparkSession.range(1).select(F.lit(joins.UNKNOWN_KEY).alias(surrogate),
                                           *(F.lit(unknown.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields))
    return keyed.unionByName(row)


def standard_table(source: DataFrame, key: Sequence[str], order: Sequence[str], columns: Mapping[str, Column | str], where: Column | None = None) -> DataFrame:
    """The pattern of a plain Silver table: filter, one row per key, named and typed columns."""
    rows = source if where is None else source.filter(where)
    rows = windows.dedup(rows, list(key), list(order))[0]
    return rows.select(*((F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()))


def check_parents(fact: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """A flag per foreign key (``<column>_missing``): set, but without a parent row."""
    for i, (fk, (parent, pk)) in enumerate(parents.items()):
        own = parent.select(F.col(pk).alias(f"_p{i}")).distinct()
        fact = fact.join(own, F.col(fk) == F.col(f"_p{i}"), "left")
        fact = fact.withColumn(f"{fk}_missing", F.col(fk).isNotNull() & F.col(f"_p{i}").isNull()).drop(f"_p{i}")
    return fact
