"""Versioned tables, copies in ranges that go on where they stopped, and streams into tables."""

import tempfile
import threading
import time

import pytest
from pyspark.sql import functions as F

from tableveil.operators import clone, runlog, versions
from tableveil.plans.spec import SpecError
from tableveil.queries import fresh
from tableveil.streaming.masked_copy import copy_into_table


@pytest.fixture
def people(spark):
    path = tempfile.mkdtemp(prefix="spark-") + "/people"
    spark.range(1000).selectExpr("id", "concat('user', id, '@x.example') AS email").repartition(12).write.parquet(path)
    return path


def test_replacements_leave_no_moment_without_a_table(spark):
    fresh(spark, "v_swap")
    versions.replace_table(spark.range(100), "v_swap", "t")
    seen, failed, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table("v_swap.t").count())
            except Exception as e:  # noqa: BLE001
                failed.append(str(e)[:300])

    readers = [threading.Thread(target=read) for _ in range(3)]
    for r in readers:
        r.start()
    for n in (200, 300, 400, 500):
        assert versions.replace_table(spark.range(n), "v_swap", "t") == n
        time.sleep(0.3)
    stop.set()
    for r in readers:
        r.join()
    assert not failed and seen <= {100, 200, 300, 400, 500} and spark.table("v_swap.t").count() == 500
    old = spark.table("v_swap.t")
    assert len(versions.prune(spark, "v_swap", "t")) == 4 and old.count() == 500 and versions.prune(spark, "v_swap", "t") == []
    # It may read what it replaces.
    assert versions.replace_table(spark.table("v_swap.t").where("id < 7"), "v_swap", "t") == 7
    with pytest.raises(SpecError):
        versions.replace_table(spark.range(3).withColumn("x", F.lit(1)), "v_swap", "t")
    clone.clone_frame(spark.range(2), "v_swap", "plain")
    with pytest.raises(SpecError):
        versions.replace_table(spark.range(3), "v_swap", "plain")
    assert spark.table("v_swap.t").count() == 7 and spark.table("v_swap.plain").count() == 2


def test_a_stopped_copy_reads_only_what_is_missing(spark, people, monkeypatch):
    fresh(spark, "v_ranges", "v_log")
    source, options = spark.read.parquet(people), {"where": "id % 2 = 0", "mask": {"email": "email"}}
    real, seen = versions.written, []

    class Killed(BaseException):
        pass

    def stop_in_the_third(df, path):
        if len(seen) == 2:
            raise Killed
        seen.append(path)
        return real(df, path)

    monkeypatch.setattr(versions, "written", stop_in_the_third)
    with pytest.raises(Killed):
        versions.copy_in_ranges(spark, "v_log", 3, source, "v_ranges", "people", options, parts=5)
    monkeypatch.setattr(versions, "written", real)
    assert not spark.catalog.tableExists("v_ranges.people")
    line = lambda: runlog.progress(spark.table("v_log.run_log"), F.current_timestamp()).first()
    part = line()
    assert not part["finished"] and 0 < part["rows_copied"] < 500 and part["bytes_copied"] > 0
    wanted = set(versions.inputs(source, 5)) - {int(p.rpartition("/r")[2]) for p in seen}
    n, copied = versions.copy_in_ranges(spark, "v_log", 3, source, "v_ranges", "people", options, parts=5, parallel=2)
    assert n == 500 and set(copied) == wanted and spark.table("v_ranges.people").count() == 500
    assert {r["email"] for r in spark.table("v_ranges.people").collect()} == {"u***@x.example"}
    whole = line()
    assert whole["status"] == "completed" and whole["rows_copied"] == 500 and whole["bytes_copied"] > part["bytes_copied"]
    assert versions.copy_in_ranges(spark, "v_log", 3, source, "v_ranges", "people", options, parts=5) == (500, [])


def test_progress_grows_inside_a_table(spark, people):
    fresh(spark, "v_live", "v_live_log")
    seen, stop = [], threading.Event()

    def watch():
        while not stop.is_set():
            if spark.catalog.tableExists("v_live_log.run_log"):
                spark.catalog.refreshTable("v_live_log.run_log")
                row = runlog.progress(spark.table("v_live_log.run_log"), F.current_timestamp()).first()
                seen.append((row["rows_copied"], row["bytes_copied"], row["finished"]))

    watcher = threading.Thread(target=watch)
    watcher.start()
    versions.copy_in_ranges(spark, "v_live_log", 1, spark.read.parquet(people), "v_live", "people", parts=8)
    stop.set()
    watcher.join()
    running = sorted({s[:2] for s in seen if not s[2] and s[0]})
    assert len(running) >= 2 and running == sorted(running, key=lambda s: s[1])


def test_changed_input_is_copied_again(spark, people):
    fresh(spark, "v_changed", "v_changed_log")
    go = lambda: versions.copy_in_ranges(spark, "v_changed_log", 1, spark.read.parquet(people), "v_changed", "people", parts=4)
    assert go()[0] == 1000
    spark.range(1000, 1010).selectExpr("id", "'x' AS email").coalesce(1).write.mode("append").parquet(people)
    n, again = go()
    assert n == 1010 and len(again) == 1 and spark.read.table("v_changed.people").count() == 1010


def test_ranges_skip_other_files(spark, people):
    source = spark.read.parquet(people)
    rows = source.where(F.pmod(F.xxhash64("_metadata.file_path"), F.lit(4)) == 1)
    names = {r["f"] for r in source.select(F.col("_metadata.file_path").alias("f"), F.pmod(F.xxhash64("_metadata.file_path"), F.lit(4)).alias("k")).distinct().where("k = 1").collect()}
    assert names and {r[0] for r in rows.select("_metadata.file_path").distinct().collect()} == names
    assert rows.rdd.getNumPartitions() <= len(names)


def test_nothing_to_copy(spark):
    fresh(spark, "v_none", "v_none_log")
    path = tempfile.mkdtemp(prefix="spark-") + "/none"
    spark.range(0).write.parquet(path)
    assert versions.copy_in_ranges(spark, "v_none_log", 1, spark.read.parquet(path), "v_none", "t", parts=3)[0] == 0
    assert spark.table("v_none.t").count() == 0


def test_streams_write_every_row_once(spark, people):
    fresh(spark, "v_stream", "v_stream_log")
    state, schema = tempfile.mkdtemp(prefix="spark-"), spark.read.parquet(people).schema
    options = {"where": "id < 900", "mask": {"email": "hash"}}

    def lost(number):
        if number == 2:
            raise RuntimeError("lost after the write")

    run = lambda **more: copy_into_table(spark, people, schema, "v_stream", "people", state, options, ("v_stream_log", 9), files=3, **more)
    with pytest.raises(Exception, match="lost after the write"):
        run(written_batch=lost).awaitTermination()
    assert 0 < spark.table("v_stream.people").count() < 900
    run().awaitTermination()
    rows = spark.table("v_stream.people")
    assert rows.count() == rows.select("id").distinct().count() == 900 and rows.where("length(email) = 32").count() == 900
    spark.range(1000, 1005).selectExpr("id - 1000 - 5 AS id", "'x' AS email").coalesce(1).write.mode("append").parquet(people)
    run().awaitTermination()
    assert spark.table("v_stream.people").count() == 905
    for _ in range(150):  # the listener hears of the end a little later
        spark.catalog.refreshTable("v_stream_log.run_log")
        line = runlog.progress(spark.table("v_stream_log.run_log"), F.current_timestamp()).first()
        if line["finished"] and line["rows_copied"] == 905:
            break
        time.sleep(0.2)
    assert line["status"] == "completed" and line["rows_copied"] == 905
