"""Continuous masked copy: new files of a source are filtered and masked on their way to the target, a folder or a table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.masks import shape
from ..operators.runlog import append
from ..operators.versions import publish, root, written
from ..plans.spec import CloneSpec
from ..sources.catalog import quoted


def _read(spark: SparkSession, source: str, schema: StructType, files: int | None = None) -> DataFrame:
    """New files of a folder or file pattern of Parquet; files: as many at a time."""
    folder, _, name = source.rpartition("/")
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.option("pathGlobFilter", name).parquet(folder) if name.endswith(".parquet") else reader.parquet(source)


def masked_copy(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, options=None, **trigger) -> StreamingQuery:
    """Starts the copy; a restart with the same checkpoint goes on where it stopped. The default trigger takes what is there and ends.

    source: a folder or file pattern of Parquet; target: a folder. Masks keep no state, so memory does not grow.
    """
    rows = shape(_read(spark, source, schema), CloneSpec.read(options))
    writer = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


class BatchLog(StreamingQueryListener):
    """Run-log events of one stream: its begin, every committed batch with its rows and bytes, its end or failure."""

    def __init__(self, spark: SparkSession, log_schema: str, job_id: int, schema: str, table: str):
        self.spark, self.log_schema, self.job_id, self.schema, self.table = spark, log_schema, job_id, schema, table
        # A restarted stream keeps its id, so that a run is known by its own: the name is set before it starts.
        self.name, self.run, self.sizes = f"{schema}.{table}-{uuid.uuid4().hex}", None, {}

    def event(self, phase: str, status: str, rows: int = 0, size: int | None = None, error: str | None = None) -> None:
        append(self.spark, self.log_schema, "run_log", [(self.job_id, None, datetime.now(), "stream", self.schema, self.table, phase, status, 1, rows, size, error)])

    def onQueryStarted(self, event) -> None:
        # Spark calls this before `start` returns.
        if event.name == self.name:
            self.run = str(event.runId)

    def onQueryIdle(self, event) -> None:
        """Nothing was copied."""

    def onQueryProgress(self, event) -> None:
        # A batch is told of once it is committed, so one that is repeated after a failure counts once.
        if str(event.progress.runId) == self.run and (size := self.sizes.pop(event.progress.batchId, None)):
            self.event("copying", "running", *size)

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run:
            lost = event.exception
            self.event("failed" if lost else "done", "failed" if lost else "completed", error=lost.splitlines()[0][:500] if lost else None)
            self.spark.streams.removeListener(self)


def copy_into_table(
    spark: SparkSession, source: str, source_schema: StructType, schema: str, table: str, checkpoint: str, options=None, log: tuple[str, int] | None = None,
    files: int | None = None, written_batch: Callable[[int], None] | None = None, **trigger,
) -> StreamingQuery:
    """`masked_copy` into a table of the catalog, every row exactly once.

    A batch is a folder named by its number. If a run stops after the write and before the checkpoint, the batch runs
    again with the same rows and the same number, and its folder is written anew. log (schema, job): where committed
    batches are told of. written_batch(number) is called between a batch's write and its commit.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(schema)}")
    path, name = f"{root(spark, schema, table)}/stream", quoted(schema, table)
    rows = shape(_read(spark, source, source_schema, files), CloneSpec.read(options))
    if not spark.catalog.tableExists(name):
        publish(spark, schema, table, path, rows.schema.toDDL())
    told = BatchLog(spark, *log, schema, table) if log else None

    def put(batch: DataFrame, number: int) -> None:
        size = written(batch, f"{path}/b{number}")
        spark.sql(f"REFRESH TABLE {name}")
        if told:
            told.sizes[number] = size
        if written_batch:
            written_batch(number)

    if told:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(log[0])}")
        spark.streams.addListener(told)
        told.event("begin", "running")
    writer = rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.queryName(told.name) if told else writer).trigger(**(trigger or {"availableNow": True})).start()
