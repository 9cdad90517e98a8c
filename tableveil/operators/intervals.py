"""Ranges [low, high) of equal keys that overlap, found by a sweep over range partitions.

Rows are dealt out by ranges of (key, low, id), so a key with very many rows spreads over many partitions, and every
partition is swept once in order. What a partition cannot see is how far the ranges before it reach. That is one row per
partition, its last key and that key's largest end, from which each partition takes what its first key carries over.
Nothing is collected: the number of partitions is the session's, and the carried table has one row for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names that the sweep adds; none may be a column of the rows.
_ADDED = ("__part", "__first", "__before")


class _Sweep:
    """Largest end among the rows before each row, of its key, batch after batch."""

    def __init__(self):
        self.key = self.end = None
        self.first = True

    def before(self, key: pa.Array, high: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Ends (null where none stands before) and whether the rows are of the first key."""
        n = len(key)
        change = np.ones(n, bool)
        change[1:] = ~pc.fill_null(pc.equal(key[1:], key[:-1]), False).to_numpy(zero_copy_only=False)
        begun = self.end is not None
        goes_on = begun and key[0].as_py() == self.key
        change[0] = not goes_on
        group = np.cumsum(change)
        ends = pa.concat_arrays([self.end, high]) if begun else high
        rank = pc.rank(ends, tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64)
        # Groups ascend, so a group's ranks are all above those of the groups before it: the maximum starts anew with each.
        most = len(ends) + 1
        at = np.concatenate([[0], group]) if begun else group
        peaks = np.maximum.accumulate(at * most + rank) % most
        place = np.empty(most + 1, np.int64)
        place[rank] = np.arange(len(ends))  # where an end of a rank stands
        running = ends.take(pa.array(place[peaks]))
        shown = running[:n] if begun else pa.concat_arrays([pa.nulls(1, high.type), running[:-1]])
        first = np.zeros(n, bool)
        if self.first:
            upto = np.flatnonzero(change[1:] if not begun else change)
            first[: n if not len(upto) else upto[0] + (not begun)] = True
            self.first = not len(upto)
        self.key, self.end = key[-1].as_py(), running[-1:]
        return pc.if_else(pa.array(change), pa.scalar(None, high.type), shown), first


def swept(df: DataFrame, key: str, low: str, high: str, row_id: str, parts: int | None = None) -> DataFrame:
    """Rows with a range and a key, with __part, __first (of the partition's first key) and __before (the largest end of
    the rows before, in the partition and of the key)."""
    if clash := {*_ADDED} & {*df.columns}:
        raise ValueError(f"columns {', '.join(sorted(clash))} are in the way")
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.where((F.col(low) < F.col(high)) & F.col(key).isNotNull())
    # The partition's number is taken right above the shuffle, where it is the range's own.
    ranged = rows.repartitionByRange(n, key, low, row_id).withColumn("__part", F.spark_partition_id()).sortWithinPartitions(key, low, row_id)
    schema = T.StructType([*ranged.schema, T.StructField("__first", T.BooleanType()), T.StructField("__before", df.schema[high].dataType)])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Sweep()
        for batch in batches:
            if not batch.num_rows:
                continue
            before, first = state.before(batch.column(key), batch.column(high))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first), before], names=[*batch.schema.names, "__first", "__before"])

    return ranged.mapInArrow(sweep, schema)


def _spans(rows: DataFrame, key: str, low: str, high: str) -> DataFrame:
    """One row per partition: its first key with that key's first start, its last key with that key's largest end."""
    by = rows.groupBy("__part").agg(F.min(F.struct(F.col(key).alias("key"), F.col(low).alias("low"))).alias("first"), F.max(F.struct(F.col(key).alias("key"), F.col(high).alias("high"))).alias("last"))
    return by.select("__part", F.col("first.key").alias("first_key"), F.col("first.low").alias("first_low"), F.col("last.key").alias("last_key"), F.col("last.high").alias("last_end"))


def _carried(spans: DataFrame) -> DataFrame:
    """(__part, __carried): the largest end that earlier partitions hold of each partition's first key, if any does."""
    line = lambda key, at, end, of: F.struct(F.col(key).alias("key"), at.alias("at"), end.alias("end"), of.alias("of"))
    asks = line("first_key", F.col("__part") * 2, F.when(F.lit(False), F.col("last_end")), F.col("__part"))
    tells = line("last_key", F.col("__part") * 2 + 1, F.col("last_end"), F.lit(None).cast("int"))
    lines = spans.select(F.explode(F.array(asks, tells)).alias("x")).select("x.*")
    so_far = F.max("end").over(Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    return lines.select("of", so_far.alias("__carried")).where("of is not null and __carried is not null").withColumnRenamed("of", "__part")


def overlapping_rows(df: DataFrame, key: str, low: str, high: str, row_id: str, parts: int | None = None) -> DataFrame:
    """Rows whose range meets that of a row before them (by low, then id) with the same key.

    Rows with a null key or an empty range meet nothing. parts: range partitions, the session's number by default; both
    uses of the swept rows read the same shuffle.
    """
    rows = swept(df, key, low, high, row_id, parts)
    carried = F.broadcast(_carried(_spans(rows, key, low, high)))
    rows = rows.join(carried, "__part", "left")
    reached = F.greatest("__before", F.when(F.col("__first"), F.col("__carried")))
    return rows.where(F.col(low) < reached).select(*df.columns)


def overlapping_pairs(df: DataFrame, key: str, low: str, high: str, row_id: str, parts: int | None = None) -> DataFrame:
    """(key, left_id, right_id) of all pairs of rows whose ranges overlap, left_id the smaller id.

    A range also goes to the later partitions of its key that it reaches into, once to each. There it only waits for the
    rows that start while it lasts, so the work is the answer's size, and a long range costs a row per partition.
    """
    narrow = df.select(F.col(key).alias("key"), F.col(low).alias("low"), F.col(high).alias("high"), F.col(row_id).alias("id"))
    rows = swept(narrow, "key", "low", "high", "id", parts).select("key", "low", "high", "id", "__part")
    spans = F.broadcast(_spans(rows, "key", "low", "high").select(F.col("__part").alias("to"), "first_key", "first_low"))
    reaches = (F.col("key") == F.col("first_key")) & (F.col("__part") < F.col("to")) & (F.col("first_low") < F.col("high"))
    guests = rows.join(spans, reaches).select("key", "low", "high", "id", F.col("to").alias("__part"), F.lit(True).alias("guest"))
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = rows.withColumn("guest", F.lit(False)).unionByName(guests).repartition(n, "__part").sortWithinPartitions("__part", "key", F.desc("guest"), "low", "id")
    kind, of = df.schema[row_id].dataType, df.schema[key].dataType
    schema = T.StructType([T.StructField(key, of), T.StructField("left_id", kind), T.StructField("right_id", kind)])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, waiting = None, []
        for batch in batches:
            kinds = [batch.schema.field(c).type for c in ("key", "id", "id")]
            keys, lows, highs, ids, part, guest = (batch.column(c).to_pylist() for c in ("key", "low", "high", "id", "__part", "guest"))
            out: tuple[list, list, list] = ([], [], [])
            for i, at in enumerate(zip(part, keys, strict=True)):
                if at != group:
                    group, waiting = at, []
                if not guest[i]:
                    # Who has ended by now meets no later row either.
                    waiting = [w for w in waiting if w[0] > lows[i]]
                    for _, other in waiting:
                        out[0].append(keys[i])
                        out[1].append(min(other, ids[i]))
                        out[2].append(max(other, ids[i]))
                    if len(out[0]) >= 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)
                        out = ([], [], [])
                waiting.append((highs[i], ids[i]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    names = schema.names
    return met.mapInArrow(pair, schema)
