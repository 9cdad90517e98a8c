"""Constraints as data checks: each returns schema_name, table_name, constraint, kind, violations, ok.

Violations count rows for p, c, f, n and x, and keys that stand more than once (plus null keys of p) for p and u.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.catalog import quoted, tables
from .intervals import overlapping_pairs, overlapping_rows

VERDICTS = "schema_name string, table_name string, constraint string, kind string, violations long, ok boolean"


def _verdict(violations: DataFrame, schema: str, table: str, constraint: str | Column, kind: str) -> DataFrame:
    name = F.lit(constraint) if isinstance(constraint, str) else constraint
    n = F.coalesce(F.col("violations"), F.lit(0)).cast("long")
    return violations.select(F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"), name.alias("constraint"), F.lit(kind).alias("kind"), n.alias("violations"), (n == 0).alias("ok"))


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys without nulls that stand more than once, with their number."""
    return df.dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique(df: DataFrame, key: list[str], schema: str, table: str, constraint: str) -> DataFrame:
    """Keys with a null never clash."""
    return _verdict(duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("violations")), schema, table, constraint, "u")


def primary_key(df: DataFrame, key: list[str], schema: str, table: str, constraint: str) -> DataFrame:
    """Duplicated keys plus keys with a null, from one aggregation by key."""
    by = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    empty = F.coalesce(*(F.when(F.col(k).isNull(), 1) for k in key), F.lit(0)) == 1
    return _verdict(by.agg(F.sum(F.when(empty, F.col("n")).when(F.col("n") > 1, 1).otherwise(0)).alias("violations")), schema, table, constraint, "p")


def predicate(df: DataFrame, condition: str, schema: str, table: str, constraint: str) -> DataFrame:
    """Only a row for which the condition is false violates it."""
    return _verdict(df.agg(F.count_if(~F.coalesce(F.expr(condition), F.lit(True))).alias("violations")), schema, table, constraint, "c")


def orphans(df: DataFrame, key: list[str], parent: DataFrame, parent_key: list[str]) -> DataFrame:
    """Rows whose key has no null and no parent. Keys are grouped first, so a hot key is joined once."""
    known = parent.select(*(F.col(p).alias(f"__{i}") for i, p in enumerate(parent_key)))
    wanted = df.dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(known, [F.col(k) == F.col(f"__{i}") for i, k in enumerate(key)], "left_anti")


def foreign_key(df: DataFrame, key: list[str], parent: DataFrame, parent_key: list[str], schema: str, table: str, constraint: str) -> DataFrame:
    return _verdict(orphans(df, key, parent, parent_key).agg(F.sum("n").alias("violations")), schema, table, constraint, "f")


def not_null(df: DataFrame, columns: list[str], schema: str, table: str) -> DataFrame:
    """One row per column, from one pass."""
    sums = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    long = sums.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in columns))).alias("x")).select("x.*")
    return _verdict(long, schema, table, F.concat(F.lit(f"{table}_"), F.col("column"), F.lit("_not_null")), "n")


def exclusion(df: DataFrame, key: str, low: str, high: str, row_id: str, schema: str, table: str, constraint: str) -> DataFrame:
    return _verdict(overlapping_rows(df, key, low, high, row_id).agg(F.count(F.lit(1)).alias("violations")), schema, table, constraint, "x")


def exclusion_pairs(df: DataFrame, key: str, low: str, high: str, row_id: str, parts: int | None = None) -> DataFrame:
    """The overlapping pairs themselves (left_id < right_id), on request: their number is the answer's own size."""
    return overlapping_pairs(df, key, low, high, row_id, parts)


def _key(df: DataFrame, columns: list[str], as_types: list | None = None) -> Column:
    """The columns as one exact key of texts, null if any of them is: equal keys are equal texts, whatever the table."""

    def text(value: Column, kind: T.DataType) -> Column:
        match kind:
            case T.BinaryType():
                return F.hex(value)
            case T.FloatType() | T.DoubleType():
                return (value + F.lit(0.0)).cast("double").cast("string")  # -0.0 is 0.0
            case T.TimestampType():
                return F.unix_micros(value).cast("string")  # an hour that the zone has twice is two hours
            case T.StringType() | T.NumericType() | T.BooleanType() | T.DateType() | T.TimestampNTZType():
                return value.cast("string")
            case _:
                return F.when(value.isNotNull(), F.to_json(F.struct(value)))

    kinds = as_types or [df.schema[c].dataType for c in columns]
    texts = [text(F.col(quoted(c)).cast(k), k) for c, k in zip(columns, kinds, strict=True)]
    return F.when(reduce(Column.__and__, (t.isNotNull() for t in texts)), F.array(*texts))


def _types(spark: SparkSession, left: DataFrame, a: list[str], right: DataFrame, b: list[str]) -> list:
    """The types that two lists of columns are compared in."""
    kinds = [(left.schema[x].dataType, right.schema[y].dataType) for x, y in zip(a, b, strict=True)]
    return [x if x == y else spark.range(0).select(F.coalesce(F.lit(None).cast(x), F.lit(None).cast(y))).schema[0].dataType for x, y in kinds]


def constraint_pass(spark: SparkSession, schema: str, constraints: DataFrame, suffix: str = "") -> DataFrame:
    """Checks a schema's tables against constraints (catalog.CONSTRAINTS, of any schema), in one pass over each table.

    A row of a table becomes one row per key that a constraint asks of it (its own, or its parent's or child's side of
    a foreign key), and one that names the predicates and null checks that it breaks, if any. Those of all tables meet
    in a single aggregation by constraint and key: a hot key, or a column full of nulls, is one row per task before the
    shuffle. Only exclusions read their table on their own, since they need its rows in order.

    The rows of `constraints` are metadata. Those of tables or columns that the schema lacks are left out; names that
    start with their table's name take the suffix behind it. Exclusions name key, low, high and row id as their columns.
    """
    frames = {t: spark.table(quoted(schema, t)) for t in tables(spark, schema)}
    there = {t: set(df.columns) for t, df in frames.items()}
    verdicts, alone, keys, broken = [], [], {}, {}

    def checked(table: str, name: str, kind: str) -> int:
        verdicts.append((len(verdicts), table, name, kind))
        return len(verdicts) - 1

    for c in constraints.collect():
        table, columns = c["table_name"], list(c["columns"] or [])
        parent, refers = c["ref_table"] or "", list(c["ref_columns"] or [])
        if table not in there or not set(columns) <= there[table]:
            continue
        df, kind = frames[table], c["kind"]
        name = table + suffix + c["name"][len(table) :] if c["name"].startswith(table) else c["name"]
        if kind in ("p", "u") and columns:
            key = _key(df, columns)
            keys.setdefault(table, []).append((checked(table, name, kind), False, key, F.lit(True) if kind == "p" else key.isNotNull()))
        elif kind == "f" and columns and parent in there and len(columns) == len(refers) and set(refers) <= there[parent]:
            i, kinds = checked(table, name, kind), _types(spark, df, columns, frames[parent], refers)
            for t, cols, is_parent in ((table, columns, False), (parent, refers, True)):
                key = _key(frames[t], cols, kinds)
                keys.setdefault(t, []).append((i, is_parent, key, key.isNotNull()))
        elif kind == "c":
            broken.setdefault(table, []).append((checked(table, name, kind), ~F.coalesce(F.expr(c["predicate"]), F.lit(True))))
        elif kind == "n":
            for column in columns:
                broken.setdefault(table, []).append((checked(table, f"{table}_{column}_not_null", kind), F.col(quoted(column)).isNull()))
        elif kind == "x":
            alone.append(exclusion(df, *columns, schema, table, name))
    if not verdicts:
        return reduce(DataFrame.unionByName, alone) if alone else spark.createDataFrame([], VERDICTS)
    asked = spark.createDataFrame(verdicts, "id int, table_name string, constraint string, kind string")
    rows = []
    for table in sorted(set(keys) | set(broken)):
        entries = [F.when(wanted, F.struct(F.lit(i).alias("id"), F.lit(is_parent).alias("parent"), key.alias("key"))) for i, is_parent, key, wanted in keys.get(table, [])]
        if table in broken:
            breaks = F.concat_ws(",", *(F.when(b, F.lit(str(i))) for i, b in broken[table]))
            entries.append(F.when(breaks != "", F.struct(F.lit(-1).alias("id"), F.lit(False).alias("parent"), F.array(breaks).alias("key"))))
        rows.append(frames[table].select(F.explode(F.array(*entries)).alias("x")).where("x is not null").select("x.*"))
    by_key = reduce(DataFrame.unionByName, rows).groupBy("id", "key").agg(F.count_if(~F.col("parent")).alias("n"), F.count_if("parent").alias("parents"))
    # A key of id -1 lists the constraints that its n rows break.
    each = by_key.select(F.explode(F.when(F.col("id") < 0, F.split(F.col("key")[0], ",").cast("array<int>")).otherwise(F.array("id"))).alias("of"), "id", "key", "n", "parents")
    sums = each.groupBy("of").agg(
        F.sum(F.when(F.col("id") < 0, F.col("n"))).alias("broken"),
        F.sum(F.when(F.col("key").isNull(), F.col("n")).when(F.col("n") > 1, 1).otherwise(0)).alias("repeated"),
        F.sum(F.when(F.col("parents") == 0, F.col("n")).otherwise(0)).alias("orphans"),
    )
    counted = F.when(F.col("kind").isin("c", "n"), F.col("broken")).when(F.col("kind") == "f", F.col("orphans")).otherwise(F.col("repeated"))
    found = asked.join(sums, asked["id"] == sums["of"], "left").withColumn("violations", F.coalesce(counted, F.lit(0)).cast("long"))
    found = found.select(F.lit(schema).alias("schema_name"), "table_name", "constraint", "kind", "violations", (F.col("violations") == 0).alias("ok"))
    return reduce(DataFrame.unionByName, alone, found)


def kept_constraints(constraints: DataFrame, kept: list[str] | Column) -> DataFrame:
    """Constraints all of whose columns are copied."""
    kept = F.array(*map(F.lit, kept)) if isinstance(kept, list) else kept
    return constraints.where(F.size(F.array_except("columns", kept)) == 0)


def new_constraints(constraints: DataFrame, existing: DataFrame) -> DataFrame:
    """Constraints that the target has not yet, by table and name."""
    return constraints.join(existing.select("table_name", "name"), ["table_name", "name"], "left_anti")


def renamed_constraints(constraints: DataFrame, source: Column, target: Column) -> DataFrame:
    """Names that start with the source table's name start with the target's."""
    new = F.when(F.startswith(F.col("name"), source), F.concat(target, F.substr(F.col("name"), F.length(source) + 1))).otherwise(F.col("name"))
    return constraints.withColumn("name", new)
