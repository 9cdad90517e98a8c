"""Masking of tables that are there already: rewritten in place, or served through masked views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import Spark
from ..functions.masks import apply_masks, check_types, mask_sql
from ..plans.spec import CloneSpec, SpecError, read_rules
from ..sources.catalog import quoted
from .clone import Definition, _fill, new_name, recover, swap

POLICIES = "schema_name string, table_name string, view_name string, role string, columns array<string>"


def mask_in_place(spark: SparkSession, schema: str, table: str, rules) -> tuple[int, int]:
    """Rewrites the masked columns of all rows; returns rows and columns masked."""
    rules = read_rules(rules)
    recover(spark, schema, table)
    df = spark.table(quoted(schema, table))
    check_types(df.schema, rules)
    staged = new_name(table, "staged")
    n = _fill(apply_masks(df, rules), schema, staged, CloneSpec(masks=rules), Definition.of(spark, schema, table))
    swap(spark, schema, staged, table)
    return n, len(rules)


class Policies:
    """Masked views and the table that says which role may read past them.

    read_as is a convenience, not access control: enforce that where the data are stored.
    """

    def __init__(self, spark: SparkSession, schema: str, table: str = "masking_policies"):
        self.spark, self.name = spark, quoted(schema, table)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(schema)}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({POLICIES.replace(' string', ' STRING').replace('array<string>', 'ARRAY<STRING>')}, dropped BOOLEAN, at TIMESTAMP) USING parquet")

    def _log(self, schema: str, table: str, role: str | None, columns: list[str], dropped: bool) -> None:
        row = self.spark.createDataFrame([(schema, table, f"{table}_masked", role, columns, dropped)], f"{POLICIES}, dropped boolean")
        row.withColumn("at", F.current_timestamp()).write.mode("append").saveAsTable(self.name)

    def current(self) -> DataFrame:
        """The latest policy of each table, if it still stands."""
        log = self.spark.table(self.name)
        last = log.groupBy("schema_name", "table_name").agg(F.max_by(F.struct("view_name", "role", "columns", "dropped"), "at").alias("p"))
        return last.where("not p.dropped").select("schema_name", "table_name", "p.view_name", "p.role", "p.columns")

    def create(self, schema: str, table: str, rules, role: str) -> str:
        """Makes or replaces the view <table>_masked with masks over all columns."""
        rules = read_rules(rules)
        base = self.spark.table(quoted(schema, table))
        if missing := [c for c in rules if c not in base.columns]:
            raise SpecError(f"mask rules for columns that do not exist: {', '.join(missing)}")
        columns = (f"{mask_sql(rules[f.name], f.dataType, Spark())} AS {quoted(f.name)}" if f.name in rules else quoted(f.name) for f in base.schema)
        self.spark.sql(f"CREATE OR REPLACE VIEW {quoted(schema, f'{table}_masked')} AS SELECT {', '.join(columns)} FROM {quoted(schema, table)}")
        self._log(schema, table, role, sorted(rules), False)
        return f"{table}_masked"

    def drop(self, schema: str, table: str) -> None:
        """Drops the view; the data stay."""
        self.spark.sql(f"DROP VIEW IF EXISTS {quoted(schema, f'{table}_masked')}")
        self._log(schema, table, None, [], True)

    def read_as(self, role: str, schema: str, table: str, without_policy: bool = False) -> DataFrame:
        """The table for its policy's role, its masked view for every other one.

        A table without a policy is an error, unless `without_policy` says that anyone may read it.
        """
        policy = self.current().where((F.col("schema_name") == schema) & (F.col("table_name") == table)).first()
        if policy is None and not without_policy:
            raise SpecError(f"no masking policy for {schema}.{table}")
        hidden = policy is not None and policy["role"] != role
        return self.spark.table(quoted(schema, policy["view_name"] if hidden else table))
