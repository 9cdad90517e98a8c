"""Tables in versioned folders: replaced in one step, copied in ranges that a stopped run need not read again.

A version is a folder with a folder for each range (or batch). The table is the catalog's pointer to one version, so a
replacement is one change of the pointer: no moment is without a table, and readers of the old version keep its files
until `prune`. A range is committed by a row in a manifest once its files stand; a run that comes after copies only
ranges that have none, or whose input has changed since.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.masks import shape
from ..plans.spec import CloneSpec, SpecError, check_schema_name
from ..sources.catalog import quoted, table_property
from .runlog import append

VERSIONED = "tableveil.versions"
MANIFEST = "job_id long, target string, part int, parts int, input string, rows long, bytes long, path string, at timestamp"
#: Ranges that a table is copied in.
PARTS = 16


def root(spark: SparkSession, schema: str, table: str) -> str:
    """The folder that holds a table's versions, below that of its database."""
    return f"{spark.catalog.getDatabase(quoted(schema)).locationUri.rstrip('/')}/{table}__versions"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish(spark: SparkSession, schema: str, table: str, path: str, columns: str) -> None:
    """Makes schema.table the version at path, in one step. columns: DDL of its columns.

    A table that is there must be versioned and have the same columns, since a pointer cannot change these as well.
    """
    name = quoted(schema, table)
    if not spark.catalog.tableExists(name):
        # Ranges lie in folders of their own.
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (recursiveFileLookup 'true') LOCATION {_text(path)} TBLPROPERTIES ('{VERSIONED}' = 'true')")
        return
    if table_property(spark, schema, table, VERSIONED) is None:
        raise SpecError(f"{schema}.{table} is there and has no versions")
    probe = spark.createDataFrame([], columns).schema
    if [(f.name, f.dataType) for f in probe] != [(f.name, f.dataType) for f in spark.table(name).schema]:
        raise SpecError(f"{schema}.{table} has other columns")
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(path)}")


def version(spark: SparkSession, schema: str, table: str) -> str:
    """The folder that a versioned table points to."""
    rows = spark.sql(f"DESCRIBE EXTENDED {quoted(schema, table)}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")


def prune(spark: SparkSession, schema: str, table: str) -> list[str]:
    """Deletes all versions but the one pointed to; returns them. Readers of the others must have ended."""
    now = version(spark, schema, table).rpartition("/")[2]
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(root(spark, schema, table))
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = sorted(f.getPath().getName() for f in files.listStatus(top) if f.getPath().getName() != now)
    for name in gone:
        files.delete(jvm.org.apache.hadoop.fs.Path(top, name), True)
    return gone


def written(df: DataFrame, path: str) -> tuple[int, int]:
    """Writes a folder anew; returns its rows, counted on the way, and its bytes."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    sizes = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return seen.get["rows"], sizes.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def replace_table(df: DataFrame, schema: str, table: str, options=None) -> int:
    """Puts the frame's rows into a versioned table, in one step once they are written; returns their number."""
    spark = df.sparkSession
    rows = shape(df, CloneSpec.read(options))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(check_schema_name(schema))}")
    path = f"{root(spark, schema, table)}/{uuid.uuid4().hex[:12]}"
    n, _ = written(rows, f"{path}/r0")
    publish(spark, schema, table, path, rows.schema.toDDL())
    return n


def inputs(df: DataFrame, parts: int) -> dict[int, str]:
    """What each range of a frame over files reads, as one digest of its files' names, sizes and times.

    Files are dealt out by a hash of their names; Spark skips the files of other ranges before it opens them.
    """
    files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    part = F.pmod(F.xxhash64("file_path"), F.lit(parts)).cast("int")
    by = files.groupBy(part.alias("part")).agg(F.sum(F.xxhash64("file_path", "file_size", "file_modification_time").cast("decimal(38,0)")).cast("string").alias("input"))
    return {r["part"]: r["input"] for r in by.collect()}


def copy_in_ranges(
    spark: SparkSession, log_schema: str, job_id: int, source: DataFrame, schema: str, table: str, options=None, parts: int = PARTS, parallel: int = 1,
) -> tuple[int, list[int]]:
    """Copies a frame over files range by range into a versioned table; returns all rows and the ranges copied now.

    Each finished range is an event in the run log (rows and bytes so far can be watched) and a row in the manifest. Run
    again with the same job and target, it copies what is not finished and what has other input than it had. The table
    changes once, when the last range stands.
    """
    spec, target = CloneSpec.read(options), f"{schema}.{table}"
    for s in (schema, log_schema):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(check_schema_name(s))}")
    manifest = quoted(log_schema, "manifest")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {manifest} ({MANIFEST}) USING parquet")
    path = f"{root(spark, schema, table)}/job{job_id}"
    reads = inputs(source, parts)
    mine = spark.table(manifest).where((F.col("job_id") == job_id) & (F.col("target") == target) & (F.col("parts") == parts))
    last = {r["part"]: r["x"] for r in mine.groupBy("part").agg(F.max_by(F.struct("input", "rows"), "at").alias("x")).collect()}
    left = sorted(k for k, held in reads.items() if k not in last or last[k]["input"] != held)
    if gone := set(last) - set(reads):
        raise SpecError(f"ranges {sorted(gone)} of job {job_id} have lost their input; copy under another job")

    def event(phase: str, status: str, rows: int = 0, size: int | None = None, error: str | None = None) -> None:
        append(spark, log_schema, "run_log", [(job_id, None, datetime.now(), "table", schema, table, phase, status, 1, rows, size, error)])

    def one(k: int) -> int:
        rows = source.where(F.pmod(F.xxhash64("_metadata.file_path"), F.lit(parts)) == k)
        n, size = written(shape(rows, spec), f"{path}/r{k}")
        append(spark, log_schema, "manifest", [(job_id, target, k, parts, reads[k], n, size, f"{path}/r{k}", datetime.now())], MANIFEST)
        event("copying", "running", n, size)
        return n

    event("begin", "running")
    try:
        with ThreadPoolExecutor(max(1, parallel)) as pool:
            now = list(pool.map(one, left))
        if not reads:
            written(shape(source, spec), f"{path}/r0")
        publish(spark, schema, table, path, shape(source, spec).schema.toDDL())
    except Exception as e:
        event("failed", "failed", error=str(e).splitlines()[0][:500])
        raise
    event("done", "completed")
    return sum(now) + sum(last[k]["rows"] for k in reads if k not in left), left
