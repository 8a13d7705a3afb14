"""Queries that write views in a format and read them back: readers and writers against the views themselves."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import shared_folder
from ..sources import lines, readers, variant_source, writers
from .catalog import query
from .site_queries import WITH
from .views import RUNS, calls, runs


def written(lines: DataFrame, name: str) -> str:
    """The folder in which the lines stand, in one order, as text."""
    path = f"{shared_folder(lines.sparkSession)}/{name}-{uuid.uuid4().hex}"
    lines.select("value").write.text(path)
    return path


@query(f"{WITH} SELECT ind::VARCHAR AS ind, CAST(CASE WHEN g < 0 THEN 9 ELSE g END AS BIGINT) AS g, CAST(count(*) AS BIGINT) AS n FROM calls GROUP BY 1, 2")
def ped_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Lines of all individuals, read back: how often each has each genotype."""
    found = readers.ped_genotypes(spark, written(writers.ped_lines(calls(spark, d), F.col("site")), "ped"))
    return found.groupBy("ind", F.col("g").cast("long").alias("g")).agg(F.count("*").alias("n"))


@query(f"{WITH} SELECT DISTINCT '1' AS chrom, 'snp' || site AS snp, pos FROM calls")
def map_round_trip(spark: SparkSession, d: str) -> DataFrame:
    sites = calls(spark, d).select("site", "pos").distinct()
    return readers.map_sites(spark, written(writers.map_lines(sites), "map")).select("chrom", "snp", "pos")


@query(f"{WITH} SELECT CASE WHEN site % 2 = 0 THEN 'a' ELSE 'b' END AS chrom, pos, 'i' || ind AS ind, g FROM calls WHERE g >= 0")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A table of digits with a column for each individual; undefined cells are left out."""
    cell = F.when(F.col("g") == 2, "11").when(F.col("g") == 1, "12").when(F.col("g") == 0, "22").otherwise("0")
    key = F.concat(F.when(F.col("site") % 2 == 0, "a").otherwise("b"), F.lit(" "), F.col("pos").cast("string"))
    cells = calls(spark, d).groupBy("site", key.alias("key")).agg(*[F.coalesce(F.max(F.when(F.col("ind") == i, cell)), F.lit("0")).alias(f"i{i}") for i in range(8)])
    rows = cells.select(F.concat_ws(",", "key", *[f"i{i}" for i in range(8)]).alias("value"), F.col("site").alias("place"))
    found = readers.csv_genotypes(spark, written(writers.headed(rows, ["site," + ",".join(f"i{i}" for i in range(8))]), "csv"))
    return found.where("g >= 0").select("chrom", "pos", "ind", F.col("g").cast("long").alias("g"))


@query(f"WITH {RUNS} SELECT chrom, pos AS start, pos + 1 AS \"end\", score / 100.0::DOUBLE AS score FROM runs WHERE chrom < 5")
def bedgraph_round_trip(spark: SparkSession, d: str) -> DataFrame:
    rows = runs(spark, d).where("chrom < 5").select("chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), (F.col("score") / 100).alias("score"))
    found = readers.data_rows(spark, written(writers.bedgraph_lines(rows), "bedgraph"))
    at = lambda i, kind: F.col("cell")[i].cast(kind)
    return found.select(at(0, "long").alias("chrom"), at(1, "long").alias("start"), at(2, "long").alias("end"), at(3, "double").alias("score"))


@query(f"{WITH} SELECT site, string_agg(CASE WHEN g < 0 THEN '9' ELSE CAST(g AS VARCHAR) END, '' ORDER BY ind) AS genotypes FROM calls GROUP BY 1")
def eigenstrat_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Lines in the order of sites: the site is told by the line with its name, the one of the same number, wherever the files are split."""
    found = calls(spark, d)
    counted = lambda rows, name: lines.ordered_lines(lines.placed_lines(spark, written(rows, name)))
    genotypes = counted(writers.eigenstrat_lines(found), "geno")
    names = counted(writers.eigenstrat_snp_lines(found.select("site").distinct()), "snp")
    site = F.regexp_extract("value", r"^ *snp([0-9]+)", 1).cast("long").alias("site")
    return names.select("n", site).join(genotypes.select("n", F.col("value").alias("genotypes")), "n").select("site", "genotypes")


def made_table(spark: SparkSession, d: str) -> str:
    """Lines without a header become a table: its columns are picked from theirs, and its path is given."""
    cells = [F.coalesce(F.max(F.when(F.col("ind") == i, F.col(c))), F.lit(-1 if c == "g" else 0)).cast("string").alias(f"{c}{i}") for i in range(8) for c in "abgq"]
    rows = calls(spark, d).groupBy("site", "chrom", "pos").agg(*cells)
    site = ["'x'", "concat('c', chrom)", "pos", "'A'", "'C'", "site"]
    raw = rows.selectExpr(f"concat_ws('\t', {', '.join(site)}, {', '.join(f'{c}{i}' for i in range(8) for c in 'abgq')}) AS value")
    meta = lines.table_metadata(["chr", "pos", "A", "B", "site"], [f"i{i}" for i in range(8)], 4, 1, 2, 1, 2, "view", "x")
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    writers.write_table(lines.build_table(spark, written(raw, "raw"), meta, [2, 3, 4, 5, 6, *range(7, 39)]), path, meta)
    return path


@query(f"""{WITH}, s AS (SELECT DISTINCT site, chrom, pos FROM calls), i AS (SELECT unnest(range(8)) AS ind)
    SELECT 'c' || s.chrom AS chrom, s.pos, 'i' || i.ind AS ind, coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(g, -1) AS g, coalesce(q, 0) AS q FROM s CROSS JOIN i LEFT JOIN calls c ON c.site = s.site AND c.ind = i.ind""")
def made_table_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A table built from picked columns, read back as calls."""
    table, _ = readers.variant_table(spark, made_table(spark, d))
    return readers.long_calls(table).select(F.col("scaffold").alias("chrom"), "pos", "ind", "a", "b", F.coalesce("g", F.lit(-1)).alias("g"), "q")


@query(f"""{WITH}, s AS (SELECT DISTINCT site, chrom, pos FROM calls)
    SELECT 'c' || s.chrom AS chr, s.pos, s.site::VARCHAR AS site, coalesce(c.a, 0) AS "3A", coalesce(c.g, -1) AS "3G" FROM s LEFT JOIN calls c ON c.site = s.site AND c.ind = 2""")
def variant_source_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The same through the data source, of which five columns are asked for."""
    return variant_source.read_variants(spark, made_table(spark, d), ["chr", "pos", "site", "3A", "3G"])


@query(f"WITH {RUNS} SELECT chrom, pos, score FROM runs WHERE chrom < 5")
def numbered_lines_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Lines that tell their own place: those whose number in their file is not what a second way of counting gives would be missing."""
    rows = runs(spark, d).where("chrom < 5").select("chrom", "pos", "score")
    path = written(rows.select(F.concat_ws("\t", "chrom", "pos", "score").alias("value")), "numbered")
    told = lines.numbered_lines(spark, path)
    whole = told.groupBy("file").agg(F.min("line").alias("first"), F.max("line").alias("last"), F.count_distinct("line").alias("n")).where("first = 1 AND last = n").select("file")
    at = lambda i: F.split("value", "\t")[i].cast("long")
    return told.join(whole, "file", "left_semi").select(at(0).alias("chrom"), at(1).alias("pos"), at(2).alias("score"))
