"""Schema drift between two snapshots, each of which names a column or an object once; lists are in byte order of the names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.catalog import columns_snapshot, objects_snapshot
from ..sources.jdbc import JdbcCatalog

#: Categories whose objects have no definition to compare.
NAMES_ONLY = ("sequences",)
CATEGORIES = ("indexes", "constraints", "triggers", "views", "sequences")


def _sides(source: DataFrame, target: DataFrame) -> DataFrame:
    """A row per column of either side: table_name, column_name, what each side says of it (s, t; null if nothing), and
    whether its table is on each side (in_s, in_t).

    Both sides are dealt out once, by table, and everything about tables and columns is taken from these rows in place.
    Names that are null are like no other.
    """
    a, b = (df.select("table_name", "column_name", F.lit(of).alias("of"), F.struct("type", "not_null", "default").alias("c")) for df, of in ((source, 0), (target, 1)))
    of_table = Window.partitionBy("table_name").orderBy("column_name", "of")
    every = of_table.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # The source's column comes first, and the target's of the same name is the next row.
    rows = a.unionAll(b).repartition("table_name").select(
        "*", *(F.lead(c).over(of_table).alias(f"next_{c}") for c in ("column_name", "of", "c")), *(F.lag(c).over(of_table).alias(f"last_{c}") for c in ("column_name", "of")),
        F.min("of").over(every).alias("first"), F.max("of").over(every).alias("last"),
    )
    named = F.col("table_name").isNotNull()
    pair = named & (F.col("of") == 0) & (F.col("next_of") == 1) & (F.col("next_column_name") == F.col("column_name"))
    told = named & (F.col("of") == 1) & (F.col("last_of") == 0) & (F.col("last_column_name") == F.col("column_name"))
    return rows.where(~F.coalesce(told, F.lit(False))).select(
        "table_name", "column_name", F.when(F.col("of") == 0, F.col("c")).alias("s"), F.when(F.col("of") == 1, F.col("c")).when(pair, F.col("next_c")).alias("t"),
        F.when(named, F.col("first") == 0).otherwise(F.col("of") == 0).alias("in_s"), F.when(named, F.col("last") == 1).otherwise(F.col("of") == 1).alias("in_t"),
    )


#: Of a table, and of a column of a table on both sides: the side that has it, null if both do.
_TABLE = "CASE WHEN NOT in_t THEN 'only_in_source' WHEN NOT in_s THEN 'only_in_target' END"
_COLUMN = "CASE WHEN in_s AND in_t AND t IS NULL THEN 'only_in_source' WHEN in_s AND in_t AND s IS NULL THEN 'only_in_target' END"
_DRIFTS = "s IS NOT NULL AND t IS NOT NULL AND NOT (s.type <=> t.type AND s.not_null <=> t.not_null AND s.`default` <=> t.`default`)"
_FACTS = ("type", "not_null", "default")


def _one_sided() -> list[Column]:
    return [F.expr(_COLUMN).alias("presence"), *(F.coalesce("s", "t")[c].alias(c) for c in _FACTS)]


def _two_sided() -> list[Column]:
    return [F.col(f"{side}.{c}").alias(f"{name}_{c}") for c in _FACTS for side, name in (("s", "source"), ("t", "target"))]


def _differing(sides: DataFrame) -> DataFrame:
    return sides.where(f"({_TABLE}) IS NOT NULL OR ({_COLUMN}) IS NOT NULL OR ({_DRIFTS})")


def _tables(sides: DataFrame) -> DataFrame:
    return sides.select("table_name", F.expr(_TABLE).alias("presence")).where("presence IS NOT NULL").distinct()


def _columns(sides: DataFrame) -> DataFrame:
    return sides.where(f"({_COLUMN}) IS NOT NULL").select("table_name", "column_name", *_one_sided())


def _column_drift(sides: DataFrame) -> DataFrame:
    return sides.where(_DRIFTS).select("table_name", "column_name", *_two_sided())


def tables(source: DataFrame, target: DataFrame) -> DataFrame:
    """(table_name, presence): only_in_source or only_in_target."""
    a, b = (df.select("table_name").distinct().withColumn(side, F.lit(True)) for df, side in ((source, "s"), (target, "t")))
    both = a.join(b, "table_name", "full_outer")
    return both.where("s is null or t is null").select("table_name", F.when(F.col("t").isNull(), "only_in_source").otherwise("only_in_target").alias("presence"))


def columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns on one side only, of tables on both."""
    return _columns(_sides(source, target))


def column_drift(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns on both sides with another type, nullability or default (nulls compare as values)."""
    return _column_drift(_sides(source, target))


def objects(source: DataFrame, target: DataFrame) -> DataFrame:
    """(category, parent, name, presence, source_def, target_def) of objects on one side only or with another definition.

    Constraints and triggers are known by their table as well, since two tables may have one of the same name.
    """
    of_table = F.col("category").isin("constraints", "triggers")
    key = ["category", F.when(of_table, F.coalesce("parent", F.lit(""))).otherwise("").alias("parent"), "name"]
    text = F.when(F.col("category").isin(*NAMES_ONLY), F.lit("")).otherwise(F.coalesce("def", F.lit("")))
    a, b = (df.select(*key, text.alias(f"{side}_def"), F.lit(True).alias(side)) for df, side in ((source, "source"), (target, "target")))
    # Sorting compares first bytes first: parents differ early, categories and the names made of them late.
    both = a.join(b, ["parent", "name", "category"], "full_outer")
    presence = F.when(F.col("target").isNull(), "only_in_source").when(F.col("source").isNull(), "only_in_target").otherwise("modified")
    drift = both.where("source is null or target is null or source_def <> target_def")
    return drift.select("category", "parent", "name", presence.alias("presence"), *(F.when(~F.col("category").isin(*NAMES_ONLY), F.col(f"{s}_def")).alias(f"{s}_def") for s in ("source", "target")))


def summary(sides: DataFrame, object_rows: DataFrame) -> DataFrame:
    """17 counters, diff_count (one for each object that differs) and in_sync, from _sides and objects."""
    differ = _differing(sides).select("table_name", F.coalesce(F.expr(_TABLE), F.lit("modified")).alias("presence")).distinct()
    marks = differ.select(F.concat(F.lit("tables_"), "presence").alias("mark")).unionAll(object_rows.select(F.concat("category", F.lit("_"), "presence").alias("mark")))
    return _counters(marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")))


def _counters(marks: DataFrame) -> DataFrame:
    names = [f"{c}_{p}" for c in ("tables", *CATEGORIES) for p in ("only_in_source", "only_in_target", "modified") if not (c in NAMES_ONLY and p == "modified")]
    counted = marks.agg(*(F.coalesce(F.sum(F.when(F.col("mark") == n, F.col("n"))), F.lit(0)).cast("long").alias(n) for n in names))
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return counted.withColumn("diff_count", total).withColumn("in_sync", total == 0)


def documents(sides: DataFrame, object_rows: DataFrame) -> DataFrame:
    """The comparison as JSON, (section, name, document): a summary, one row per table that differs, one per object.

    No row gathers more than the differences of one table.
    """
    keep = {"ignoreNullFields": "false"}
    listed = lambda when, fields: F.array_sort(F.collect_list(F.when(F.expr(when), F.struct("column_name", *fields))))
    lists = listed(f"({_COLUMN}) IS NOT NULL", _one_sided()).alias("columns"), listed(_DRIFTS, _two_sided()).alias("column_drift")
    by_table = _differing(sides).groupBy("table_name", F.expr(_TABLE).alias("presence")).agg(*lists)
    some = [F.when(F.size(c) > 0, F.col(c)).alias(c) for c in ("columns", "column_drift")]
    by_table = by_table.select(F.lit("tables").alias("section"), F.col("table_name").alias("name"), F.to_json(F.struct("presence", *some), keep).alias("document"))
    by_object = object_rows.select(F.col("category").alias("section"), F.concat_ws(".", F.nullif("parent", F.lit("")), "name").alias("name"), F.to_json(F.struct(*object_rows.columns), keep).alias("document"))
    # The summary counts the documents. It asks for all their columns, so both readings share one exchange and the sides
    # are compared once.
    made = by_table.unionAll(by_object).repartition("section", "name")
    mark = F.concat("section", F.lit("_"), F.coalesce(F.get_json_object("document", "$.presence"), F.lit("modified"))).alias("mark")
    totals = _counters(made.groupBy(mark).agg(F.count(F.coalesce("document", "name")).alias("n")))
    return totals.select(F.lit("summary").alias("section"), F.lit("").alias("name"), F.to_json(F.struct(*totals.columns), keep).alias("document")).unionAll(made)


@dataclass(frozen=True)
class Drift:
    """All differences of two schemas."""

    tables: DataFrame
    columns: DataFrame
    column_drift: DataFrame
    objects: DataFrame
    summary: DataFrame
    sides: DataFrame

    def documents(self) -> DataFrame:
        return documents(self.sides, self.objects)

    def document(self) -> DataFrame:
        return document(self.tables, self.columns, self.column_drift, self.objects, self.summary)


def compare(source_columns: DataFrame, target_columns: DataFrame, source_objects: DataFrame, target_objects: DataFrame) -> Drift:
    sides, object_rows = _sides(source_columns, target_columns), objects(source_objects, target_objects)
    return Drift(_tables(sides), _columns(sides), _column_drift(sides), object_rows, summary(sides, object_rows), sides)


def diff_schemas(spark: SparkSession, source: str | JdbcCatalog, target: str | JdbcCatalog, source_constraints: DataFrame | None = None, target_constraints: DataFrame | None = None) -> Drift:
    """Differences of two schemas: tables, columns, views, materialized views and, where they are given, constraints.

    A side is a schema of the catalog, by name, or one behind JDBC, whose indexes, triggers, sequences and constraints
    are compared too. The database is asked once for each kind of fact.
    """
    sides = []
    for side, constraints in ((source, source_constraints), (target, target_constraints)):
        if isinstance(side, str):
            sides.append((columns_snapshot(spark, side), objects_snapshot(spark, side, constraints)))
        else:
            sides.append((held(side.columns()), held(side.objects())))
    return compare(sides[0][0], sides[1][0], sides[0][1], sides[1][1])


def held(facts: DataFrame) -> DataFrame:
    """Facts of a catalog as rows of the session: metadata, small enough for the driver."""
    return facts.sparkSession.createDataFrame(facts.collect(), facts.schema)


def document(table_rows: DataFrame, column_rows: DataFrame, drift_rows: DataFrame, object_rows: DataFrame, totals: DataFrame) -> DataFrame:
    """The whole comparison as one JSON text. It is a report on catalogs: as long as their differences, in one row."""
    lists = []
    for name, df in (("tables", table_rows), ("columns", column_rows), ("column_drift", drift_rows), ("objects", object_rows)):
        lists.append(df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias(name)))
    out = totals.select(F.struct(*totals.columns).alias("summary"))
    for one in lists:  # one row each
        out = out.join(F.broadcast(one))
    return out.select(F.to_json(F.struct("summary", "tables", "columns", "column_drift", "objects"), {"ignoreNullFields": "false"}).alias("document"))
