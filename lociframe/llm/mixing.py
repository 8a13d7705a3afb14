"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions only.

1. Word counts give each source's size. Its target is the share of its weight in all words, but at most
   ``max_repeat`` times its size; what that cuts off is shared again by weight. Sorting the sources by size over
   weight gives this fixed point in one pass: the capped ones are a prefix of that order.
2. The mix has ``total / block_words`` equal blocks. They go to the sources by the highest quotients
   ``target / (2k + 1)``, and each source's blocks to its shards (a hash of the document) likewise. Quotas near
   the proportional share are certain, so only a few quotients around it are ranked.
3. In a (source, shard) cell documents stand in seeded hash order; the cell takes whole passes and then the
   first blocks of that order, so that every document is taken at most ``max_repeat`` times. ``mix`` counts the words
   within the blocks; ``mixed_documents`` takes whole documents, the last one if at least half of it is within.

The number of shards grows with the square root of the words. So both the number of cells and the rows of a cell
stay small, whatever a single source holds; only sums leave a cell.

Nulls: a null text has no words and takes none; a null source is a source of its own, sorted last; a null doc_id is
an id like any other. Equal rows are separate rows. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, table, text_or_empty

BLOCK_WORDS = 16
SEED = 20
#: So many cells (some 10 MB) go to all executors; above that Spark joins by the cell.
BROADCAST_CELLS = 100_000
WEIGHTS = (1.0, 2.0, 3.0)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = 3) -> DataFrame:
    """(source, size) of each document -> source, source_size, rank, target; one row per source."""
    by_name, all_rows = Window.orderBy(F.col("source").isNull(), "source"), Window.partitionBy()
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("ratio", "rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("rank", F.row_number().over(by_name))
    ranked = (
        ranked.withColumn("weight", F.element_at(wheel, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", (F.col("source_size") * max_repeat).cast("double"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(all_rows).cast("double"))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("capped", F.col("level") * F.col("weight") >= F.col("cap"))
    )
    left = F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(all_rows)
    open_weight = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(all_rows)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(left * F.col("weight") / F.nullif(open_weight, F.lit(0.0)))
    return ranked.withColumn("target", target).select("source", "source_size", "rank", "target")


def apportion(parties: DataFrame, group: list[str], order: list[str], votes: str, seats: Column) -> DataFrame:
    """Sainte-Lague within ``group``: adds ``quota``. ``seats`` is the group's number of seats, ``order`` breaks ties.

    A party's quota differs from its proportional share by less than half the number of parties times its share,
    plus two. Quotients outside that window need no ranking: those before it always win, those after it never do.
    """
    own, ranked = Window.partitionBy(*group), Window.partitionBy(*group).orderBy(F.desc("quotient"), *order)
    share = F.col("votes") / F.nullif(F.sum("votes").over(own), F.lit(0.0))
    near = (
        parties.withColumn("votes", F.col(votes).cast("double"))
        .withColumn("seats", seats.cast("long"))
        .withColumn("share", F.coalesce(share, F.lit(0.0)))
        .withColumn("reach", F.ceil(F.count("*").over(own) / 2 * F.col("share")) + 2)
        .withColumn("low", F.greatest(F.lit(0), F.floor(F.col("share") * F.col("seats")) - F.col("reach")).cast("long"))
        .withColumn("high", (F.floor(F.col("share") * F.col("seats")) + F.col("reach")).cast("long"))
        .withColumn("open", F.col("seats") - F.sum("low").over(own))
    )
    keys = [*dict.fromkeys([*group, *order])]
    won = (
        near.where("votes > 0 AND open > 0")
        .select(*keys, "votes", "open", F.explode(F.sequence("low", "high")).alias("k"))
        .withColumn("quotient", F.col("votes") / (2 * F.col("k") + 1))
        .withColumn("place", F.row_number().over(ranked))
        .where("place <= open")
        .groupBy(*keys)
        .agg(F.count("*").alias("won"))
    )
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"w.{c}")) for c in keys]
    kept = [F.col(f"p.{c}") for c in parties.columns]
    return near.alias("p").join(won.alias("w"), same, "left").select(*kept, (F.col("p.low") + F.coalesce("w.won", F.lit(0))).alias("quota"))


def _dealt(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    """Adds each document's source as a key that is never null, its shard, and its place in the seeded order of its cell."""
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_hash"), F.lit(shards)))
    dealt = dealt.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")))
    return dealt.withColumn("place", F.struct(F.xxhash64(F.lit(seed + 1), "doc_id").alias("h"), F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("text_hash").alias("t")))


def _cells(sized: DataFrame, weights: tuple[float, ...], max_repeat: int, block_words: int, seed: int) -> tuple[DataFrame, DataFrame, int]:
    """(doc_id, source, size, text_hash) -> the same rows as dealt, with the words before each in its cell; the cells; the number of shards."""
    total = sized.agg(F.sum("size").alias("n")).first()["n"] or 0
    shards = max(16, int(total**0.5 / 16) + 1)
    dealt = _dealt(sized, shards, seed)
    cells = cut(dealt.groupBy("key", "shard").agg(F.first("source").alias("source"), F.sum("size").alias("cell_size")), "cells")
    sources = source_targets(cells.select("source", F.col("cell_size").alias("size")), weights, max_repeat)
    sources = apportion(sources, [], ["rank"], "target", F.lit(round(total / block_words)))
    cells = cells.alias("c").join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
    cells = cells.select(F.col("s.rank"), "key", "shard", "cell_size", "source_size", "target", F.col("quota").alias("source_quota"))
    cells = apportion(cells, ["rank"], ["shard"], "cell_size", F.col("source_quota"))
    words = F.least(F.col("quota") * block_words, F.col("cell_size") * max_repeat)
    cells = cells.withColumn("passes", F.coalesce(F.floor(words / F.nullif(F.col("cell_size"), F.lit(0))), F.lit(0)).cast("long"))
    cells = cells.withColumn("rest", words - F.col("passes") * F.col("cell_size"))
    seeded = Window.partitionBy("key", "shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("before", F.coalesce(F.sum("size").over(seeded), F.lit(0)))
    return placed, cells.select("key", "shard", "source_size", "target", "passes", "rest"), shards


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and text_hash of each document, as a table: texts are read once for it."""
    text = text_or_empty(docs)
    return cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(text).alias("size"), F.xxhash64(text).alias("text_hash")), "sizes")


def mix(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = 3, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, text_hash) -> the same rows with source_size, target, shard and taken (words the mix takes)."""
    placed, cells, _ = _cells(sized, weights, max_repeat, block_words, seed)
    first = F.least(F.greatest(F.col("rest") - F.col("before"), F.lit(0)), F.col("size"))
    return placed.join(cells, ["key", "shard"]).withColumn("taken", F.col("passes") * F.col("size") + first).drop("key", "place", "passes", "rest", "before")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = 3, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a whole document stands as often as it is taken.

    Where a cell's quota ends within a document, the document is taken if at least half of it is within. So a cell is told by its
    passes and its last place, and texts meet a table with a row for each cell instead of being sorted. Rows that share id and
    text stand alike.
    """
    placed, cells, shards = _cells(sizes(docs), weights, max_repeat, block_words, seed)
    joined = placed.where("size > 0").join(cells, ["key", "shard"])
    within = F.col("rest") - F.col("before") >= F.col("size") / 2
    ends = joined.groupBy("key", "shard").agg(F.first("passes").alias("passes"), F.max(F.when(within & (F.col("rest") > 0), F.col("place"))).alias("last"))
    ends = cut(ends.where("passes > 0 OR last IS NOT NULL"), "ends").select(F.col("key").alias("end_key"), F.col("shard").alias("end_shard"), "passes", "last")
    if ends.count() <= BROADCAST_CELLS:
        ends = F.broadcast(ends)
    text = text_or_empty(docs)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "source", F.xxhash64(text).alias("text_hash"), text.rlike(WORD).alias("full"))
    taken = _dealt(rows.where("full"), shards, seed).join(ends, (F.col("key") == F.col("end_key")) & (F.col("shard") == F.col("end_shard")))
    times = F.col("passes") + F.coalesce((F.col("place") <= F.col("last")).cast("long"), F.lit(0))
    copies = taken.withColumn("times", times).where("times > 0").withColumn("n", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return copies.select("row.*")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(sizes(table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken", "source", "shard")
