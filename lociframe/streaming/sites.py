"""An extra beyond batch: per-site sums that are decomposable run unchanged on a stream of calls."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.sites import aggregate_population, allele_counts


def watched_calls(spark, path: str, schema: str) -> DataFrame:
    """Calls from the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).parquet(path)


def running_population(calls: DataFrame, individuals: Iterable[int], checkpoint: str, name: str) -> StreamingQuery:
    """Keeps the virtual individual of each site up to date; state is one row per site."""
    rows = aggregate_population(calls, individuals)
    return rows.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_allele_counts(calls: DataFrame, individuals: Iterable[int], checkpoint: str, name: str) -> StreamingQuery:
    rows = allele_counts(calls, individuals)
    return rows.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
