"""Running sums, minima, row numbers and ranks in two levels, so that no task holds a chromosome or a whole result.

Rows lie in chunks that follow each other. Windows run within a chunk; each chunk leaves one row of totals; windows over these
rows, a few for each million, give what all chunks before add up to, and that is carried into the chunk by a join on its key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import stored

#: Positions of a chromosome in a chunk.
CHUNK = 1 << 20


def by_position(width: int = CHUNK, position: str = "pos") -> Column:
    return F.floor(F.col(position) / width)


def within(keys: list[str], *order: Column | str):
    """The window of a chunk's rows from its first to the current one, without those that tie with it."""
    return Window.partitionBy(*keys, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def carried(rows: DataFrame, keys: list[str], totals: dict[str, Column], before: dict[str, Callable[[Column], Column]], later: dict[str, tuple[Column, Callable[[Column], Column]]] | None = None) -> DataFrame:
    """Rows with columns that tell of all earlier chunks of their keys: null in the first one.

    ``totals``: aggregates of a chunk; ``before``: how those of earlier chunks combine, by name (F.sum, F.min, ...). ``later``: further values of a chunk, which may
    use totals and what was combined before, and how they combine in turn.
    """
    chunk = rows.groupBy(*keys, "chunk").agg(*[c.alias(f"{n}_") for n, c in totals.items()])
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunk = chunk.withColumns({n: combine(F.col(f"{n}_")).over(earlier) for n, combine in before.items()})
    for n, (value, combine) in (later or {}).items():
        chunk = chunk.withColumn(f"{n}_", value).withColumn(n, combine(F.col(f"{n}_")).over(earlier))
    return rows.join(chunk.select(*keys, "chunk", *before, *(later or {})), [*keys, "chunk"])


def in_order(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows, written down in ranges of the order, with the number of their range as ``chunk``. Rows that tie are in one range."""
    return stored(rows.repartitionByRange(*order).withColumn("chunk", F.spark_partition_id()))


def numbered(rows: DataFrame, name: str, *order: Column) -> DataFrame:
    """Rows with their number from 0 in the order, which should not tie."""
    parts = in_order(rows, *order)
    told = carried(parts.withColumn("local", F.row_number().over(within([], *order))), [], {"ahead": F.count("*")}, {"ahead": F.sum})
    return told.withColumn(name, F.coalesce("ahead", F.lit(0)) + F.col("local") - 1).drop("chunk", "local", "ahead")


def ranked(rows: DataFrame, name: str, method: str, *order: tuple[Column, bool]) -> DataFrame:
    """Rows with their rank from 1, dense or standard, by expressions that each rise or (True) fall; nulls come last where values fall, else first.

    Rows are counted by value first, so that a value of any frequency is one row to rank; its rank returns to the rows by a join.
    """
    values = [f"order{i}_" for i in range(len(order))]
    held = rows.withColumns({v: c for v, (c, _) in zip(values, order, strict=True)})
    directed = [F.desc(v) if falls else F.asc(v) for v, (_, falls) in zip(values, order, strict=True)]
    distinct = in_order(held.groupBy(*values).agg(F.count("*").alias("rows_")), *directed)
    local = Window.partitionBy("chunk").orderBy(*directed).rowsBetween(Window.unboundedPreceding, -1)
    step = F.lit(1) if method == "dense" else F.col("rows_")
    told = carried(distinct.withColumn("local", F.coalesce(F.sum(step).over(local), F.lit(0))), [], {"ahead": F.sum(step)}, {"ahead": F.sum})
    told = told.select(*[F.col(v).alias(f"{v}r") for v in values], (F.coalesce("ahead", F.lit(0)) + F.col("local") + 1).alias(name))
    same = reduce(and_, [held[v].eqNullSafe(F.col(f"{v}r")) for v in values])
    return held.join(told, same).drop(*values, *[f"{v}r" for v in values])
