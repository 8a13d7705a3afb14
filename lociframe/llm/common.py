"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import shared_folder

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of text that cross to Python at once.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """From now on, at most ``BATCH_ROWS`` rows go to a Python worker at once: texts may be long, and a batch is held whole on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def tasks(spark: SparkSession) -> int:
    """The number of partitions that a repartitioning by key deals to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: So many rows of two or three numbers (some 30 MB as a hash table) may go to all executors.
BROADCAST_ROWS = 300_000


def sent_if_small(stored: DataFrame) -> DataFrame:
    """A table of narrow rows, marked for broadcast if its count allows it; else Spark joins it by shuffle or splits what is skewed."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def row_hash(doc_id: int | None, text: str) -> int:
    """Of an id and its text, as a signed 64-bit number: an order of rows that copies of a row share."""
    x = xxhash.xxh64_intdigest(f"{doc_id}:".encode() + text.encode("utf-8", "surrogatepass"))
    return x - (1 << 64) if x >> 63 else x
