"""Row counts of source and target, side by side."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.catalog import databases, quoted, tables
from ..sources.jdbc import JdbcCatalog

COUNTS = "schema_name string, table_name string, n long"


def counts(spark: SparkSession, frames: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(schema_name, table_name, n) of several frames in one job; Parquet counts come from the files' footers."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(s).alias("schema_name"), F.lit(t).alias("table_name"), "n") for (s, t), df in frames.items()]
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], COUNTS)


def catalog_counts(spark: SparkSession, schemas: list[str] | None = None, mode: str = "exact") -> DataFrame:
    """Counts of all tables of the schemas (all of them by default); mode "stats" reads what ANALYZE TABLE has left."""
    names = [(s, t) for s in (databases(spark) if schemas is None else schemas) for t in tables(spark, s)]
    if mode == "exact":
        return counts(spark, {(s, t): spark.table(quoted(s, t)) for s, t in names})
    rows = []
    for s, t in names:
        described = spark.sql(f"DESCRIBE EXTENDED {quoted(s, t)}").where("col_name = 'Statistics'").first()
        found = re.search(r"(\d+) rows", described["data_type"]) if described else None
        rows.append((s, t, int(found[1]) if found else 0))
    return spark.createDataFrame(rows, COUNTS)


def verify_copy(source: JdbcCatalog, target: str) -> DataFrame:
    """`verify` of a schema behind JDBC, counted there, against its copy in the catalog."""
    copies = catalog_counts(source.spark, [target]).withColumn("schema_name", F.lit(source.schema))
    return verify(source.counts(), copies)


def verify(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source counts left-joined to target counts by table (and schema), with a mark for each."""
    other = target.select(F.col("schema_name").alias("__s"), F.col("table_name").alias("__t"), F.col("n").alias("__n"))
    rows = source.join(other, (F.col("schema_name") == F.col("__s")) & (F.col("table_name") == F.col("__t")), "left")
    mark = F.when(F.col("__n").isNull(), "✗ (missing)").when(F.col("n") == F.col("__n"), "✓").otherwise("✗")
    return rows.select("schema_name", "table_name", F.col("n").alias("source_rows"), F.coalesce("__n", F.lit(0)).cast("long").alias("target_rows"), mark.alias("match"))
