"""Genotypes against coverage, genes, intervals and protein changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequences import in_spans


def covered_bases(coverage: DataFrame, calls: DataFrame, reference: Column, shown: Column) -> DataFrame:
    """The base of each covered (chrom, pos, ind): what its call shows, or the reference base where the site has no call."""
    found = calls.select("chrom", "pos", "ind", shown.alias("shown"))
    joined = coverage.join(found, ["chrom", "pos", "ind"], "left")
    return joined.withColumn("base", F.coalesce("shown", reference)).drop("shown")


def genes_with_sequence(genes: DataFrame, sequences: DataFrame) -> DataFrame:
    """Genes whose chromosome is among the named sequences (name, sequence); others are dropped."""
    names = sequences.select(F.col("name").alias("chrom")).distinct()
    return genes.join(names, "chrom", "left_semi")


def unlisted_length(intervals: DataFrame) -> DataFrame:
    """Positions that intervals (chrom, start, end; both included) cover, overlaps once, as ``length``: a sweep in a chromosome."""
    along = Window.partitionBy("chrom").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    rows = intervals.withColumn("before", F.max("end").over(along))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.col("before") + 1, F.col("start"))) + 1)
    return rows.agg(F.coalesce(F.sum(new), F.lit(0)).alias("length"))


def coding_diversity(calls: DataFrame, changes: DataFrame, covered: DataFrame, nonsynonymous_sites: float, synonymous_sites: float) -> DataFrame:
    """One row: SNPs, pi and theta of the nonsynonymous and of the synonymous changes within the covered intervals.

    ``changes``: (chrom, pos, ref_aa, alt_aa) of SNPs in coding sequence; those that keep the amino acid are synonymous.
    Pi sums 2p(1 - p)n / (n - 1) over polymorphic sites; theta divides their number by the harmonic number of the most copies.
    """
    sums = calls.where("g >= 0").groupBy("chrom", "pos").agg(F.sum("g").alias("s"), (2 * F.count("*")).alias("n")).where("s > 0 AND s < n")
    kind = (F.col("ref_aa") != F.col("alt_aa")).alias("changed")
    rows = in_spans(sums.join(changes.select("chrom", "pos", kind).distinct(), ["chrom", "pos"]), covered).select("chrom", "pos", "s", "n", "changed").distinct()
    p = F.col("s") / F.col("n")
    pi = 2 * p * (1 - p) * F.col("n") / (F.col("n") - 1)
    of = lambda x, name: [F.count_if(x).alias(f"snps_{name}"), F.coalesce(F.sum(F.when(x, pi)), F.lit(0.0)).alias(f"h_{name}")]
    found = rows.agg(*of(F.col("changed"), "non"), *of(~F.col("changed"), "syn"))
    copies = calls.where("g >= 0").groupBy("chrom", "pos").agg((2 * F.count("*")).alias("n")).agg(F.max("n").alias("n"))
    harmonic = copies.select(F.aggregate(F.sequence(F.lit(1), F.col("n") - 1), F.lit(0.0), lambda t, k: t + 1 / k).alias("a"))
    found = found.crossJoin(F.broadcast(harmonic)).crossJoin(F.broadcast(unlisted_length(covered)))  # rows of one line each
    theta = lambda name, sites: (F.col(f"snps_{name}") / F.col("a") / sites).alias(f"theta_{name}")
    pi_of = lambda name, sites: (F.col(f"h_{name}") / sites).alias(f"pi_{name}")
    n, s = F.lit(float(nonsynonymous_sites)), F.lit(float(synonymous_sites))
    return found.select("snps_non", n.alias("sites_non"), pi_of("non", n), "snps_syn", s.alias("sites_syn"), pi_of("syn", s), "length", theta("non", n), theta("syn", s))
