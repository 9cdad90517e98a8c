"""Overlapping ranges against brute force: hot keys, partitions of any number, ties, long ranges, other types."""

import random

import pytest
from pyspark.sql import functions as F

from tableveil.operators import checks
from tableveil.operators.intervals import overlapping_pairs, overlapping_rows, swept


def by_force(rows):
    """Ids of rows that meet one before them, and all pairs; rows: (id, key, low, high)."""
    rows = sorted((k, lo, i, hi) for i, k, lo, hi in rows if k is not None and lo is not None and hi is not None and lo < hi)
    late, pairs = set(), set()
    for n, (k, lo, i, _) in enumerate(rows):
        for k2, _, j, hi2 in rows[:n]:
            if k2 == k and lo < hi2:
                late.add(i)
                pairs.add((min(i, j), max(i, j)))
    return late, pairs


def drawn(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lo = rng.randrange(3000)
        length = rng.choice((0, 1, 3, 9, 40)) if i % 97 else 2500
        rows.append((i, rng.choice((1, 1, 1, 2, 3, i, None)), lo, lo + length if i % 50 else None))
    return rows


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 3), (3, 16), (4, 61), (5, None)])
def test_overlaps_equal_brute_force(spark, seed, parts):
    rows = drawn(seed)
    df = spark.createDataFrame(rows, "id int, k int, lo int, hi int").repartition(5)
    late, pairs = by_force(rows)
    got = [r["id"] for r in overlapping_rows(df, "k", "lo", "hi", "id", parts).collect()]
    assert len(got) == len(set(got)) and set(got) == late
    met = [(r["left_id"], r["right_id"]) for r in overlapping_pairs(df, "k", "lo", "hi", "id", parts).collect()]
    assert len(met) == len(set(met)) and set(met) == pairs


@pytest.mark.parametrize("batch", [1, 2, 7])
def test_batches_of_any_size(spark, batch):
    rows = drawn(9, 200)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, "id int, k int, lo int, hi int")
        late, pairs = by_force(rows)
        assert {r["id"] for r in overlapping_rows(df, "k", "lo", "hi", "id", 3).collect()} == late
        assert {(r["left_id"], r["right_id"]) for r in overlapping_pairs(df, "k", "lo", "hi", "id", 3).collect()} == pairs
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("kind,key", [("date", "string"), ("timestamp", "date"), ("timestamp_ntz", "bigint"), ("decimal(12,2)", "decimal(9,1)"), ("double", "string"), ("string", "int")])
def test_types_of_ranges_and_keys(spark, kind, key):
    rows = drawn(7, 150)
    df = spark.createDataFrame(rows, "id int, k int, lo int, hi int")
    # Numbers that keep their order in every type.
    as_kind = {"date": lambda c: F.date_add(F.lit("2000-01-01").cast("date"), F.col(c)), "string": lambda c: F.lpad(F.col(c).cast("string"), 6, "0")}.get(kind, lambda c: (F.timestamp_seconds(c) if "time" in kind else F.col(c)).cast(kind))
    as_key = F.date_add(F.lit("2000-01-01").cast("date"), F.col("k")) if key == "date" else F.col("k").cast(key)
    df = df.withColumns({"lo": as_kind("lo"), "hi": as_kind("hi"), "k": as_key})
    late, pairs = by_force(rows)
    assert {r["id"] for r in overlapping_rows(df, "k", "lo", "hi", "id", 8).collect()} == late
    found = overlapping_pairs(df, "k", "lo", "hi", "id", 8)
    assert found.schema["k"].dataType == df.schema["k"].dataType and {(r["left_id"], r["right_id"]) for r in found.collect()} == pairs


def test_a_hot_key_spreads_and_is_shuffled_once(spark):
    df = spark.range(200_000).select(F.col("id"), F.lit(1).alias("k"), (F.col("id") * 2).alias("lo"), (F.col("id") * 2 + F.when(F.col("id") % 1000 == 0, 5).otherwise(1)).alias("hi"))
    parts = swept(df, "k", "lo", "hi", "id", 8).groupBy("__part").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 60_000
    rows = overlapping_rows(df, "k", "lo", "hi", "id", 8)
    assert rows.count() == 2 * 200
    plan = rows._jdf.queryExecution().executedPlan()
    rows.collect()
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert plan is not None and text.split("== Initial Plan ==")[0].count("ReusedExchange") == 1
    assert overlapping_pairs(df, "k", "lo", "hi", "id", 8).count() == 2 * 200


def test_unions_keep_partition_numbers(spark):
    df = spark.createDataFrame([(i, 1, i * 3, i * 3 + (400 if i == 0 else 1)) for i in range(100)], "id int, k int, lo int, hi int")
    both = overlapping_rows(df, "k", "lo", "hi", "id", 6).unionAll(overlapping_rows(df, "k", "lo", "hi", "id", 6))
    assert both.count() == 2 * 99


def test_nothing_to_sweep_and_clashing_names(spark):
    df = spark.createDataFrame([(1, None, 1, 2), (2, 1, 5, 5), (3, 1, 9, 4)], "id int, k int, lo int, hi int")
    assert overlapping_rows(df, "k", "lo", "hi", "id").count() == 0 and overlapping_pairs(df, "k", "lo", "hi", "id").count() == 0
    assert checks.exclusion(df, "k", "lo", "hi", "id", "s", "t", "x").first()["ok"]
    with pytest.raises(ValueError):
        overlapping_rows(df.withColumn("__part", F.lit(1)), "k", "lo", "hi", "id")
