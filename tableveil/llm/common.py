"""Pieces that several operators share: word columns, stored intermediates, null-safe folds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; texts of ASCII alone take the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def blank_words(text: Column) -> Column:
    """Array of the runs of anything but blanks."""
    return F.array_remove(F.split(text, BLANKS), "")


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, though body names it often or inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32(doc_id as text) mod folds; a null id counts as the empty text."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; where a local session (tests) names none, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Labels that a sample may hold, the most frequent first, and characters of its longest text.
LABELS, LONGEST = 1000, 200_000


def bounded_sample(rows: DataFrame, label: str, text: str | Column, each: int, labels: int = LABELS, longest: int = LONGEST) -> list:
    """About `each` distinct (label, text) rows of every label, the same on every run; exact copies count once.

    A count per label gives the share that a hash of the row must fall under, so nothing is sorted or gathered
    but the sample itself, whose size does not grow with the input: the `labels` most frequent labels take part, and
    texts of at most `longest` characters.
    """
    rows = rows.select(F.col(label).alias("label"), (F.col(text) if isinstance(text, str) else text).alias("text")).where(f"label is not null and length(text) <= {longest}")
    counts = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(labels).collect()
    if not counts:
        return []
    rows = rows.withColumn("h", F.xxhash64(F.col("label").cast("string"), "text"))
    share = F.create_map(*(x for r in counts for x in (F.lit(r["label"]), F.lit(min(1.0, each / r["count"])))))
    chosen = rows.where(F.pmod("h", F.lit(1 << 30)) < F.element_at(share, F.col("label")) * (1 << 30))
    return sorted(chosen.groupBy("label", "h").agg(F.first("text").alias("text")).collect(), key=lambda r: (str(r["label"]), r["h"]))


def pieces(text: str, most: int, inside=str.isalnum) -> list[str]:
    """The text in pieces of `most` characters and a little more, so that none ends inside a word (a run of characters
    that are `inside`), unless the word itself is longer than a piece."""
    out, at = [], 0
    while len(text) - at > most:
        end = at + most
        while end < len(text) and end < at + 2 * most and inside(text[end]):
            end += 1
        out.append(text[at:end])
        at = end
    return [*out, text[at:]]


def sliced(texts: list[str], most: int = 1 << 21):
    """(from, to) ranges over texts of about `most` characters each; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)
