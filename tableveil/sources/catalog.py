"""Tables, views and columns of a Spark catalog or a JDBC source, as DataFrames."""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = "schema_name string, table_name string, column_name string, ordinal int, type string, not_null boolean, default string"
OBJECTS = "schema_name string, category string, name string, parent string, def string"
CONSTRAINTS = "schema_name string, table_name string, name string, kind string, columns array<string>, predicate string, ref_table string, ref_columns array<string>"
MATVIEW = "tableveil.query"


def quoted(*parts: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in parts)


def databases(spark: SparkSession, exclude=("pg_%", "information_schema")) -> list[str]:
    """Names ascending, less those that equal or (with a closing %) start with an excluded one."""
    out = (d.name for d in spark.catalog.listDatabases())
    return sorted(d for d in out if not any(d.startswith(x[:-1]) if x.endswith("%") else d == x for x in exclude))


def tables(spark: SparkSession, schema: str) -> list[str]:
    """Names of a schema's tables, ascending; views and temporary ones are left out."""
    return sorted(t.name for t in spark.catalog.listTables(schema) if t.tableType != "VIEW" and not t.isTemporary)


def views(spark: SparkSession, schema: str) -> dict[str, str]:
    """Name and text of a schema's views."""
    out = {}
    for t in spark.catalog.listTables(schema):
        if t.tableType == "VIEW" and not t.isTemporary:
            rows = spark.sql(f"DESCRIBE EXTENDED {quoted(schema, t.name)}").collect()
            out[t.name] = next(r["data_type"] for r in rows if r["col_name"] == "View Text")
    return dict(sorted(out.items()))


def table_property(spark: SparkSession, schema: str, table: str, name: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(schema, table)}").collect()
    return next((r["value"] for r in rows if r["key"] == name), None)


def matview_query(spark: SparkSession, schema: str, table: str) -> str | None:
    """The query behind a table that is a materialized view."""
    return table_property(spark, schema, table, MATVIEW)


def create_matview(spark: SparkSession, schema: str, name: str, query: str, replace: bool = False) -> None:
    """A table with the query's rows that remembers the query."""
    query = query.rstrip().rstrip(";")
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(schema, name)}")
    held = query.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {quoted(schema, name)} USING parquet TBLPROPERTIES ('{MATVIEW}' = '{held}') AS {query}")


_NAME = r"(`(?:[^`]|``)+`|\w+)"
_RELATION = re.compile(rf"^[ :+-]*SubqueryAlias spark_catalog\.{_NAME}\.{_NAME}$", re.M)


def relations_read(spark: SparkSession, schema: str, query: str) -> set[str]:
    """Tables and views of a schema that a query reads, those inside its views too; empty where it does not resolve.

    Names come from the plan that Spark resolves, so CTEs, aliases and texts named like a table are none.
    """
    plan = spark.sql(f"EXPLAIN EXTENDED {query.rstrip().rstrip(';')}").first()[0]
    analyzed = plan.partition("== Analyzed Logical Plan ==")[2].partition("== Optimized Logical Plan ==")[0]
    bare = lambda name: name[1:-1].replace("``", "`") if name.startswith("`") else name
    return {bare(table) for db, table in _RELATION.findall(analyzed) if bare(db) == schema.lower()}


def in_threads(get, names: list[str]) -> list:
    """get(name) for every name; calls to the catalog wait for one another's answers at most eight at a time."""
    with ThreadPoolExecutor(8) as pool:
        return list(pool.map(get, names))


def definition(spark: SparkSession, schema: str, table: str) -> tuple[list[dict], list[str]]:
    """A table's columns (column_name, type, not_null, default) and the columns it is partitioned by."""
    described = json.loads(spark.sql(f"DESCRIBE EXTENDED {quoted(schema, table)} AS JSON").first()[0])
    kinds = {c.name: c for c in spark.catalog.listColumns(quoted(schema, table))}
    # Only this form shows bounded texts as such; columns come before what it says of partitions and defaults.
    types: dict[str, str] = {}
    for r in spark.sql(f"DESCRIBE TABLE {quoted(schema, table)}").collect():
        types.setdefault(r["col_name"], r["data_type"])
    columns = [{"column_name": c["name"], "type": types[c["name"]], "not_null": not c.get("nullable", True), "default": c.get("default")} for c in described["columns"]]
    return columns, [c for c, k in kinds.items() if k.isPartition]


def columns_snapshot(spark: SparkSession, schema: str) -> DataFrame:
    """Columns of all tables of a schema, from the catalog."""
    names = tables(spark, schema)
    found = zip(names, in_threads(lambda t: definition(spark, schema, t)[0], names), strict=True)
    rows = [(schema, t, c["column_name"], i, c["type"], c["not_null"], c["default"]) for t, columns in found for i, c in enumerate(columns, 1)]
    return spark.createDataFrame(rows, COLUMNS)


def objects_snapshot(spark: SparkSession, schema: str, constraints: DataFrame | None = None) -> DataFrame:
    """Views and materialized views of a schema, and constraints if a frame of them (CONSTRAINTS) is given.

    Definitions name no schema, so those of two schemas can be compared.
    """
    bare = re.compile(rf"(?:`?spark_catalog`?\.)?`?{re.escape(schema)}`?\.")
    names = tables(spark, schema)
    texts = views(spark, schema) | {t: q for t, q in zip(names, in_threads(lambda t: matview_query(spark, schema, t), names), strict=True) if q}
    out = spark.createDataFrame([(schema, "views", n, None, bare.sub("", q).replace("`", "")) for n, q in texts.items()], OBJECTS)
    if constraints is not None:
        own = constraints.where(F.col("schema_name") == schema)
        text = F.concat_ws(" ", "kind", F.array_join("columns", ","), "predicate", "ref_table", F.array_join("ref_columns", ","))
        out = out.unionByName(own.select("schema_name", F.lit("constraints").alias("category"), "name", F.col("table_name").alias("parent"), text.alias("def")))
    return out


def views_frame(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([(schema, v) for v in views(spark, schema)], "schema_name string, view_name string")


def read_jdbc(spark: SparkSession, url: str, table: str, *, key: str | None = None, lower: int = 0, upper: int = 0, parts: int = 1, **options: str) -> DataFrame:
    """A table behind JDBC, read in `parts` ranges of its key; give `query` text as table to mask at the source."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key is not None and parts > 1:
        reader = reader.option("partitionColumn", key).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", parts)
    return reader.load()
