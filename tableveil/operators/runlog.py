"""Run log of copies: an append-only table of events, its latest state, progress, roll-up and what is left to do."""

from __future__ import annotations

from datetime import datetime
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.spec import CloneSpec
from ..sources.catalog import quoted, tables
from .clone import CloneResult, clone_schema

EVENTS = "job_id long, parent_job_id long, ts timestamp, op_type string, schema_name string, table_name string, phase string, status string, tables_total long, rows long, bytes long, error string"
WIDTH = 20
#: States that a job does not leave by itself.
ENDED = ("completed", "failed", "cancelled")


#: Appends of one driver go one by one: two at once would share the table's folder for files that are not committed yet.
_ONE = Lock()


def append(spark: SparkSession, schema: str, table: str, events: list[tuple], columns: str = EVENTS) -> None:
    """Writes events. They never carry connection options, so no password reaches the log."""
    rows = spark.createDataFrame(events, columns).coalesce(1)
    with _ONE:
        rows.write.mode("append").saveAsTable(quoted(schema, table))


def latest(events: DataFrame) -> DataFrame:
    """Last status, phase, table and error of every job."""
    state = F.max_by(F.struct("op_type", "status", "phase", "table_name", "error"), F.struct("ts", "table_name"))
    by = events.groupBy("job_id").agg(state.alias("x"), F.max("ts").alias("ts"))
    return by.select("job_id", "x.op_type", "x.status", "x.phase", "x.table_name", "x.error", "ts")


def progress(events: DataFrame, now: Column) -> DataFrame:
    """One row per job: counts, percentage, elapsed time, a bar and a line of text. now: used for jobs still running.

    A job that runs again after it had ended has no end. Tables left alone because they were there count as completed.
    """
    ended = F.col("status").isin(*ENDED)
    by = events.groupBy("job_id").agg(
        F.max_by(F.struct("op_type", "status", "phase", "schema_name", "table_name", "error"), F.struct("ts", "table_name")).alias("x"),
        F.max("tables_total").alias("tables_total"),
        F.count_if(F.col("phase").isin("done", "skipped")).alias("tables_completed"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_copied"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes_copied"),
        F.min("ts").alias("start_time"),
        F.max(F.when(ended, F.col("ts"))).alias("end_time"),
    )
    by = by.withColumn("end_time", F.when(F.col("x.status").isin(*ENDED), F.col("end_time")))
    total = F.coalesce("tables_total", F.lit(0))
    pct = F.when(total > 0, F.col("tables_completed") * F.lit(100.0) / total).otherwise(F.lit(0.0))
    by = by.withColumns({"pct_complete": pct, "elapsed_ms": F.floor((F.unix_micros(F.coalesce("end_time", now).cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / 1000)})
    filled = F.least(F.lit(WIDTH), F.floor(F.col("pct_complete") / 100 * WIDTH)).cast("int")
    bar = F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), WIDTH - filled))
    seconds = F.floor(F.col("elapsed_ms") / 1000)
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    hours = F.floor(seconds / 3600)
    clock = F.concat(F.when(hours < 10, two(hours)).otherwise(hours.cast("string")), F.lit(":"), two(F.floor(seconds / 60) % 60), F.lit(":"), two(seconds % 60))
    text = F.concat(bar, F.lit(" "), F.format_string("%.1f%%", F.col("pct_complete")), F.lit(" | "), F.col("rows_copied").cast("string"), F.lit(" rows | "), clock, F.lit(" elapsed"))
    return by.select("job_id", "x.op_type", "x.status", "x.phase", "x.schema_name", F.col("x.table_name").alias("current_table"), "tables_total", "tables_completed", "rows_copied", "bytes_copied", "start_time", "end_time", "elapsed_ms", "pct_complete", bar.alias("progress_bar"), text.alias("progress_text"), F.col("x.error").alias("error_message"), ended.alias("finished"))


def progress_json(events: DataFrame, now: Column) -> DataFrame:
    rows = progress(events, now)
    return rows.select("job_id", F.to_json(F.struct(*rows.columns)).alias("progress"))


def roll_up(events: DataFrame) -> DataFrame:
    """Parents of pooled jobs: children done, failed, cancelled and still to end, and the parent's own status and phase.

    A parent runs until the last child has ended; it has failed if a child has, and is cancelled if one was and none failed.
    """
    own = events.where("parent_job_id is not null")
    children = own.groupBy("job_id", "parent_job_id").agg(F.max_by("status", F.struct("ts", "table_name")).alias("status"))
    count = lambda state: F.count_if(F.col("status") == state)
    by = children.groupBy("parent_job_id").agg(
        F.count(F.lit(1)).alias("children"), count("completed").alias("ok"), count("failed").alias("failed"), count("cancelled").alias("cancelled"),
        F.count_if(~F.coalesce(F.col("status").isin(*ENDED), F.lit(False))).alias("running"),
    )
    status = F.when(F.col("running") > 0, "running").when(F.col("failed") > 0, "failed").when(F.col("cancelled") > 0, "cancelled").otherwise("completed")
    done = F.concat(F.col("ok").cast("string"), F.lit("/"), F.col("children").cast("string"))
    lost = F.when(F.col("failed") > 0, F.concat(F.lit(" ("), F.col("failed").cast("string"), F.lit(" failed)"))).otherwise("")
    phase = F.when(F.col("running") > 0, F.concat(done, F.lit(" tables done"), lost)).otherwise(F.concat(F.lit("completed ("), done, F.lit(" ok)")))
    return by.select(F.col("parent_job_id").alias("job_id"), "children", "ok", "failed", "cancelled", "running", status.alias("status"), phase.alias("phase"))


def pending(plan: DataFrame, events: DataFrame) -> DataFrame:
    """Tables of a plan (job_id, table_name) that no event has as done or skipped; failed ones are still to do."""
    return plan.join(events.where("phase in ('done', 'skipped')").select("job_id", "table_name"), ["job_id", "table_name"], "left_anti")


def run_schema(spark: SparkSession, log_schema: str, job_id: int, source: str, target: str, options=None, only: list[str] | None = None) -> list[CloneResult]:
    """clone_schema with an event in the run log as each table begins and as it ends, so a stopped run has left its state."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(log_schema)}")
    total = len(tables(spark, source) if only is None else only)

    def log(table: str | None, phase: str, status: str, rows: int = 0, error: str | None = None) -> None:
        append(spark, log_schema, "run_log", [(job_id, None, datetime.now(), "schema", target, table, phase, status, total, rows, None, error or None)])

    def told(table: str, result: CloneResult | None) -> None:
        if result is None:
            log(table, "copying", "running")
        else:
            log(table, result.status, "running", result.rows, result.error)

    log(None, "begin", "running")
    try:
        results = clone_schema(spark, source, target, options, only=only, told=told)
    except Exception as e:
        log(None, "end", "failed", error=str(e).splitlines()[0][:500])
        raise
    log(None, "end", "failed" if any(r.status == "failed" for r in results) else "completed")
    return results


def resume(spark: SparkSession, log_schema: str, job_id: int, source: str, target: str, options=None) -> list[CloneResult]:
    """Copies the tables that the job has not finished, failed ones included.

    A table that was being copied when the run stopped may hold rows already, so it is replaced unless the options say
    otherwise.
    """
    options = CloneSpec.read(options) if options is not None else CloneSpec(conflict="replace")
    plan = spark.createDataFrame([(job_id, t) for t in tables(spark, source)], "job_id long, table_name string")
    left = [r["table_name"] for r in pending(plan, spark.table(quoted(log_schema, "run_log"))).collect()]
    return run_schema(spark, log_schema, job_id, source, target, options, only=left)
