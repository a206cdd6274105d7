"""Manifest schemas, type mapping, key resolution and schema drift — metadata as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type → Spark type (STRING fallback for anything else).
TYPE_MAP = {
    "string": "string", "memo": "string", "nvarchar": "string",
    "integer": "int", "int32": "int", "int64": "bigint", "bigint": "bigint",
    "double": "double", "float": "double",
    "money": "decimal(19,4)", "boolean": "boolean",
    "datetime": "timestamp", "datetimeoffset": "timestamp", "date": "date", "time": "timestamp",
    "guid": "string", "uniqueidentifier": "string", "lookup": "string",
    "picklist": "int", "state": "int", "status": "int", "multiselect_picklist": "string",
    "image": "string", "file": "string", "binary": "string", "json": "string",
}
DEFAULT_DECIMAL = (28, 10)
# System columns appended when the manifest lacks them.
SYSTEM_COLUMNS = [("versionnumber", "bigint"), ("modifiedon", "timestamp"), ("createdon", "timestamp"),
                  ("IsDelete", "string")]
# Type widenings that are additive (safe) changes.
WIDENINGS = {("int", "bigint"), ("float", "double"), ("int", "double"), ("bigint", "double"),
             ("date", "timestamp"), ("int", "string"), ("bigint", "string")}


def spark_type(source_type: str | None, precision: int | None = None, scale: int | None = None) -> str:
    """A2: Spark type name of a source type; decimals honour the manifest precision."""
    t = (source_type or "").strip().lower()
    if t == "decimal":
        p, s = (precision, scale) if precision is not None else DEFAULT_DECIMAL
        return f"decimal({p},{s if s is not None else 0})"
    return TYPE_MAP.get(t, "string")


def type_column(dtype, precision, scale):
    """Column form of ``spark_type`` (for manifest frames)."""
    t = F.lower(F.trim(dtype))
    expr = F.lit("string")
    for k, v in TYPE_MAP.items():
        expr = F.when(t == k, F.lit(v)).otherwise(expr)
    dec = F.concat(F.lit("decimal("), F.coalesce(precision, F.lit(DEFAULT_DECIMAL[0])).cast("string"), F.lit(","),
                   F.coalesce(scale, F.when(precision.isNull(), F.lit(DEFAULT_DECIMAL[1])).otherwise(0)).cast("string"),
                   F.lit(")"))
    return F.when(t == "decimal", dec).otherwise(expr)


#: What is read of a manifest; fields that it leaves out are NULL.
MANIFEST = ("entities array<struct<name: string, attributes: array<struct<name: string, dataType: string, "
            "traits: struct<precision: int, scale: int>>>>>")


def manifest_columns(spark: SparkSession, path: str) -> DataFrame:
    """A1: manifest JSON → ``(table_name, position, column_name, source_type, spark_type)``.

    Entity names are trimmed and lower-cased; unnamed entities and
    attributes are dropped; missing system columns are appended.
    """
    m = spark.read.schema(MANIFEST).option("multiLine", True).json(path)
    ent = m.select(F.explode("entities").alias("e")).select(
        F.lower(F.trim(F.col("e.name"))).alias("table_name"), F.col("e.attributes").alias("attrs"))
    ent = ent.filter(F.col("table_name").isNotNull() & (F.col("table_name") != ""))
    cols = ent.select("table_name", F.posexplode("attrs").alias("position", "a"))
    prec, scale = F.col("a.traits.precision"), F.col("a.traits.scale")
    cols = cols.select("table_name", "position", F.col("a.name").alias("column_name"),
                       F.col("a.dataType").alias("source_type"),
                       type_column(F.col("a.dataType"), prec, scale).alias("spark_type"))
    cols = cols.filter(F.col("column_name").isNotNull() & (F.trim("column_name") != ""))
    # system columns the manifest lacks, after the last position
    last = cols.groupBy("table_name").agg(F.max("position").alias("_last"),
                                          F.collect_set(F.lower("column_name")).alias("_names"))
    sys_rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(n).alias("n"), F.lit(t).alias("t"))
                         for i, (n, t) in enumerate(SYSTEM_COLUMNS)])
    extra = (last.select("table_name", "_last", "_names", F.inline(sys_rows))
             .filter(~F.array_contains("_names", F.lower("n")))
             .select("table_name", (F.col("_last") + 1 + F.col("i")).alias("position"), F.col("n").alias("column_name"),
                     F.lit("system").alias("source_type"), F.col("t").alias("spark_type")))
    # positions of appended columns are dense after the manifest's own
    w_extra = extra.withColumn("position", F.col("position"))
    return cols.unionByName(w_extra)


def struct_of(columns: DataFrame, table: str) -> T.StructType:
    """Fold one table's (small, metadata-only) column rows into a StructType."""
    rows = columns.filter(F.col("table_name") == table).orderBy("position").collect()
    return T.StructType([T.StructField(r.column_name, T._parse_datatype_string(r.spark_type), True) for r in rows])


def resolve_key(columns: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """B2: primary key per table: override → ``<table>id`` → id / recid / entityid → first column."""
    c = columns.withColumn("_lc", F.lower("column_name"))
    rank = (F.when(F.col("_lc") == F.concat(F.col("table_name"), F.lit("id")), 1)
            .when(F.col("_lc").isin("id", "recid", "entityid"), 2)
            .when(F.col("position") == 0, 3))
    cand = c.withColumn("_rank", rank).filter(F.col("_rank").isNotNull())
    best = cand.groupBy("table_name").agg(F.min_by("column_name", F.struct("_rank", "position")).alias("key_column"))
    if overrides is not None:
        best = (best.join(overrides.select("table_name", F.col("key_column").alias("_ov")), "table_name", "left")
                .select("table_name", F.coalesce("_ov", "key_column").alias("key_column")))
    return best


def schema_frame(spark: SparkSession, table: str, df: DataFrame) -> DataFrame:
    """H4: ``(table_name, column_name, data_type)`` rows of a DataFrame's schema."""
    return spark.createDataFrame([(table, f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                 "table_name string, column_name string, data_type string")


def drift(previous: DataFrame, current: DataFrame) -> DataFrame:
    """H2: added / removed / type-changed columns between two schema frames."""
    p = previous.select("table_name", F.lower("column_name").alias("column"), F.col("data_type").alias("old_type"))
    c = current.select("table_name", F.lower("column_name").alias("column"), F.col("data_type").alias("new_type"))
    j = p.join(c, ["table_name", "column"], "full_outer")
    change = (F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed")
              .when(F.col("old_type") != F.col("new_type"), "type_changed"))
    return j.withColumn("change", change).filter(F.col("change").isNotNull())


def classify_drift(d: DataFrame, previous_tables: DataFrame, current_tables: DataFrame) -> DataFrame:
    """H3: drift class and required action; widening vs narrowing; new / missing tables."""
    widen = F.lit(False)
    for a, b in WIDENINGS:
        widen = widen | ((F.col("old_type") == a) & (F.col("new_type") == b))
    digits = {side: [F.regexp_extract(f"{side}_type", r"^decimal\((\d+),(\d+)\)$", g).try_cast("int") for g in (1, 2)] for side in ("old", "new")}
    (op, os_), (np_, ns) = digits["old"], digits["new"]
    # a wider decimal keeps every digit before and after the point
    widen = widen | F.coalesce((np_ - ns >= op - os_) & (ns >= os_), F.lit(False))
    cls = (F.when(F.col("change") == "added", "additive")
           .when(F.col("change") == "removed", "column_gone")
           .when(widen, "widening").otherwise("breaking_type"))
    action = (F.when(cls == "additive", "evolve schema; backfill if needed")
              .when(cls == "column_gone", "keep column null-filled; confirm with source")
              .when(cls == "widening", "evolve type")
              .otherwise("stop load; rebuild table"))
    cols = d.select("table_name", "column", "old_type", "new_type", cls.alias("drift_class"), action.alias("action"))
    pt = previous_tables.select("table_name").distinct()
    ct = current_tables.select("table_name").distinct()
    new_t = ct.join(pt, "table_name", "left_anti").select("table_name", F.lit(None).cast("string").alias("column"),
                                                         F.lit(None).cast("string").alias("old_type"),
                                                         F.lit(None).cast("string").alias("new_type"),
                                                         F.lit("new_table").alias("drift_class"),
                                                         F.lit("create table; full load").alias("action"))
    gone_t = pt.join(ct, "table_name", "left_anti").select("table_name", F.lit(None).cast("string").alias("column"),
                                                          F.lit(None).cast("string").alias("old_type"),
                                                          F.lit(None).cast("string").alias("new_type"),
                                                          F.lit("missing_table").alias("drift_class"),
                                                          F.lit("alert; keep last state").alias("action"))
    return cols.unionByName(new_t).unionByName(gone_t)


def name_collisions(manifests: DataFrame) -> DataFrame:
    """Table names that appear for more than one environment."""
    return (manifests.groupBy("table_name").agg(F.count_distinct("environment").alias("environments"))
            .filter(F.col("environments") > 1))


def backfill_needed(selected_now: DataFrame, selected_before: DataFrame) -> DataFrame:
    """Columns selected now but not at the previous run (need a backfill)."""
    return selected_now.join(selected_before, ["table_name", "column_name"], "left_anti")


#: Whole-number types by size, and the digits that a decimal needs for them.
_INTEGERS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """H3: the narrowest type that holds every value of both; None if there is none without a loss.

    Whole numbers widen to larger ones, to decimals with room for their digits and (up to int) to double; float to double;
    decimals to one with room for the digits of both before and after the point (at most 38); dates to timestamps;
    arrays, maps and structs by their parts.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    names = {a.simpleString(), b.simpleString()}
    if names <= set(_INTEGERS):
        return max((a, b), key=lambda t: _INTEGERS[t.simpleString()])
    if names <= {"float", "double"} or names <= {"tinyint", "smallint", "int", "double"}:
        return T.DoubleType()
    if names == {"tinyint", "float"} or names == {"smallint", "float"}:
        return T.FloatType()
    if any(isinstance(t, T.DecimalType) for t in (a, b)):
        digits = []
        for t in (a, b):
            if isinstance(t, T.DecimalType):
                digits.append((t.precision - t.scale, t.scale))
            elif t.simpleString() in _INTEGERS:
                digits.append((_INTEGERS[t.simpleString()], 0))
            else:
                return None
        whole, scale = (max(x) for x in zip(*digits, strict=True))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if names == {"date", "timestamp"}:
        return T.TimestampType()
    if names == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = common_type(a.elementType, b.elementType)
        return inner and T.ArrayType(inner)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType)
        return T.MapType(key, value) if key and value else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        own, other = {f.name.lower(): f for f in a.fields}, {f.name.lower(): f for f in b.fields}
        if list(own) != list(other):
            return None
        parts = [common_type(own[n].dataType, other[n].dataType) for n in own]
        return T.StructType([T.StructField(own[n].name, p) for n, p in zip(own, parts, strict=True)]) if all(parts) else None
    return None


class IncompatibleTypes(ValueError):
    """Columns whose types have no common type without a loss."""


def promoted(old: T.StructType, new: T.StructType, coerce: bool = False) -> T.StructType:
    """H6: the schema after ``new``: old columns in their order, then new ones; shared columns (whatever their case) in their common type.

    Columns without a common type stop the load (``IncompatibleTypes`` names them all), or become strings with ``coerce``.
    """
    later = {f.name.lower(): f for f in new.fields}
    fields, bad = [], []
    for f in old.fields:
        g = later.pop(f.name.lower(), None)
        kind = f.dataType if g is None else common_type(f.dataType, g.dataType)
        if kind is None and not coerce:
            bad.append(f"{f.name}: {f.dataType.simpleString()} and {g.dataType.simpleString()}")
        fields.append(T.StructField(f.name, kind or T.StringType()))
    if bad:
        raise IncompatibleTypes("; ".join(bad))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new.fields if f.name.lower() in later])


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` read in ``schema``: columns matched whatever their case, cast, missing ones NULL."""
    own = {f.name.lower(): f for f in df.schema.fields}
    return df.select(*((F.col(f"`{own[f.name.lower()].name}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


def evolve(old: DataFrame, new: DataFrame, coerce: bool = False) -> DataFrame:
    """H6: both frames as one, in the promoted schema: new columns NULL in old rows, widened types on read, narrowing stops or coerces."""
    both = promoted(old.schema, new.schema, coerce)
    return as_schema(old, both).unionByName(as_schema(new, both))
