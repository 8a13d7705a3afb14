"""Tables in the shape of genotype data, derived from the star-schema tables: the Spark side and the SQL side.

calls      one row per site and individual: read counts a and b, quality q, genotype g (copies of allele 1, -1 undefined)
membership genes and their categories
runs       scored positions
spans      intervals
pedigree   individuals with their parents; founders have none
digraph    edges of pathways
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POP1, POP2, ADMIXED, EVERYONE = (0, 1), (2, 3), (4, 5), (0, 1, 2, 3, 4, 5, 6, 7)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = F.when(F.col("l_returnflag").isin("A", "N"), F.col("l_quantity")).otherwise(0.0)
    alt = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)
    counts = load(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("site"), (F.col("l_suppkey") % 8).alias("ind"))
    counts = counts.agg(F.sum(ref).cast("long").alias("a"), F.sum(alt).cast("long").alias("b"), (F.max("l_linenumber") * 10).cast("long").alias("q"))
    g = F.when(F.col("a") + F.col("b") == 0, -1).when(F.col("b") == 0, 2).when(F.col("a") == 0, 0).otherwise(1).cast("long")
    return counts.select("site", (F.col("site") % 10).alias("chrom"), (F.col("site") * 100).alias("pos"), "ind", "a", "b", "q", g.alias("g"))


CALLS = """calls AS (SELECT site, site % 10 AS chrom, site * 100 AS pos, ind, a, b, q,
    CAST(CASE WHEN a + b = 0 THEN -1 WHEN b = 0 THEN 2 WHEN a = 0 THEN 0 ELSE 1 END AS BIGINT) AS g FROM (
    SELECT l_partkey AS site, l_suppkey % 8 AS ind, CAST(sum(CASE WHEN l_returnflag IN ('A','N') THEN l_quantity ELSE 0 END) AS BIGINT) AS a,
    CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS BIGINT) AS b, CAST(max(l_linenumber) * 10 AS BIGINT) AS q
    FROM lineitem GROUP BY 1, 2))"""


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, parts = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "part")
    found = items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return found.select(F.col("l_suppkey").alias("gene"), F.concat_ws("|", "p_type", "p_brand").alias("cat")).distinct()


MEMBERSHIP = "membership AS (SELECT DISTINCT l_suppkey AS gene, p_type || '|' || p_brand AS cat FROM lineitem JOIN part ON l_partkey = p_partkey)"


def listed_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").where("s_acctbal < 2000").select(F.col("s_suppkey").alias("gene"))


LISTED = "listed AS (SELECT s_suppkey AS gene FROM supplier WHERE s_acctbal < 2000)"


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores in hundredths: sums of them are exact."""
    return load(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("chrom"), F.col("event_id").alias("pos"), F.round(F.col("value") * 100).cast("long").alias("score"))


RUNS = "runs AS (SELECT user_id % 50 AS chrom, event_id AS pos, CAST(round(value * 100) AS BIGINT) AS score FROM events)"


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return load(spark, sf_dir, "supplier").select(k.alias("name"), (k % 10).alias("chrom"), (k * 1000).alias("start"), (k * 1000 + 5700).alias("end"))


SPANS = 'spans AS (SELECT s_suppkey AS name, s_suppkey % 10 AS chrom, s_suppkey * 1000 AS start, s_suppkey * 1000 + 5700 AS "end" FROM supplier)'


def pedigree(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return load(spark, sf_dir, "supplier").select(s.alias("id"), F.when(s >= 10, s % 10).alias("p1"), F.when(s >= 10, F.floor(s / 2).cast("long")).alias("p2"))


PEDIGREE = "pedigree AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey >= 10 THEN s_suppkey % 10 END AS p1, CASE WHEN s_suppkey >= 10 THEN s_suppkey // 2 END AS p2 FROM supplier)"


def digraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = load(spark, sf_dir, "part").select(F.col("p_brand").alias("pathway"), F.col("p_size").cast("long").alias("src"), (F.col("p_partkey") % 60).alias("dst"))
    return edges.where("src < dst").distinct()


DIGRAPH = "digraph AS (SELECT DISTINCT p_brand AS pathway, CAST(p_size AS BIGINT) AS src, p_partkey % 60 AS dst FROM part WHERE p_size < p_partkey % 60)"
