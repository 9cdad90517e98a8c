"""Sensitive columns found by name, and a report of which are still unmasked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sensitivity import classify
from ..sources.catalog import columns_snapshot, views_frame


def sensitive_columns(columns: DataFrame) -> DataFrame:
    """Rows of a columns snapshot (table_name, column_name, ordinal, ...) whose name is sensitive, with ord, category, strategy."""
    found = columns.withColumn("__rule", classify(F.col("column_name"))).where("__rule is not null")
    return found.select(*columns.columns, "__rule.ord", "__rule.category", "__rule.strategy")


def by_table(columns: DataFrame) -> DataFrame:
    """One row per table with a sensitive column: strategies, a map from column to strategy in column order."""
    pairs = F.transform(F.array_sort(F.collect_set(F.struct("ordinal", "column_name", "strategy"))), lambda x: F.struct(x["column_name"], x["strategy"]))
    return sensitive_columns(columns).groupBy("table_name").agg(F.map_from_entries(pairs).alias("strategies"))


def as_json(columns: DataFrame) -> DataFrame:
    """by_table as one JSON object per table."""
    return by_table(columns).select("table_name", F.to_json("strategies").alias("rules"))


def masking_report(columns: DataFrame, view_names: DataFrame) -> DataFrame:
    """One row per sensitive column: masked if a view <table>_masked stands, with a recommendation.

    view_names: schema_name, view_name.
    """
    views = view_names.select(F.col("schema_name").alias("__schema"), F.col("view_name").alias("__view")).distinct()
    match = (F.col("schema_name") == F.col("__schema")) & (F.concat("table_name", F.lit("_masked")) == F.col("__view"))
    rows = sensitive_columns(columns).join(views, match, "left")
    masked = F.col("__view").isNotNull()
    return rows.select(
        "schema_name", "table_name", "column_name", F.col("category").alias("sensitivity"),
        F.when(masked, "MASKED (view)").otherwise("UNMASKED").alias("mask_status"),
        F.when(masked, F.concat(F.lit("OK - masked via "), "table_name", F.lit("_masked view"))).otherwise(F.concat(F.lit("Apply mask strategy: "), "strategy")).alias("recommendation"),
    )


def schema_report(spark: SparkSession, schema: str, policies: DataFrame | None = None) -> DataFrame:
    """masking_report of a schema in the catalog, by name.

    policies (schema_name, table_name, columns): adds column_masked, whether the table's policy masks the column itself.
    """
    report = masking_report(columns_snapshot(spark, schema), views_frame(spark, schema))
    if policies is None:
        return report
    held = policies.select(F.col("schema_name").alias("__s"), F.col("table_name").alias("__t"), F.col("columns").alias("__columns"))
    rows = report.join(held, (F.col("schema_name") == F.col("__s")) & (F.col("table_name") == F.col("__t")), "left")
    return rows.select(*report.columns, F.coalesce(F.array_contains("__columns", F.col("column_name")), F.lit(False)).alias("column_masked"))


def rules_for(columns: DataFrame) -> dict[str, dict[str, str]]:
    """Mask rules per table, ready for a clone. The snapshot of a catalog is metadata, small enough for the driver."""
    return {r["table_name"]: dict(r["strategies"]) for r in by_table(columns).collect()}
