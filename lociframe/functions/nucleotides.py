"""Nucleotide codes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The code of two different bases; N gives way to the other one.
CONSENSUS = {"AC": "M", "AG": "R", "AT": "W", "CG": "S", "CT": "Y", "GT": "K", "AN": "A", "CN": "C", "GN": "G", "NT": "T"}
#: Codes and their complements.
CODES, COMPLEMENTS = "ACGTMKRYWSN", "TGCAKMYRWSN"


def consensus(a: Column, b: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in CONSENSUS.items() for x in pair])
    return F.when(a == b, a).otherwise(F.coalesce(F.element_at(table, F.concat(F.least(a, b), F.greatest(a, b))), F.lit("N")))


def genotype_base(g: Column, a: Column, b: Column) -> Column:
    """The base that a genotype shows: allele 1 twice, allele 2 twice, their consensus, or N."""
    return F.when(g == 2, a).when(g == 0, b).when(g == 1, consensus(a, b)).otherwise("N")


def complement(s: Column) -> Column:
    return F.translate(s, CODES, COMPLEMENTS)


def reverse_complement(s: Column) -> Column:
    return F.reverse(complement(s))


def genotype_from_digits(cell: Column) -> Column:
    """``4 - sum of digits`` of a numeric genotype; 4 (no digits counted) is undefined."""
    total = F.aggregate(F.split(cell, ""), F.lit(0), lambda s, c: s + F.coalesce(c.try_cast("int"), F.lit(0)))
    return F.when(4 - total == 4, -1).otherwise(4 - total)


def genotype_from_vcf(gt: Column) -> Column:
    """Copies of allele 1 in a GT field; any other allele number counts as one copy of the other; ``./.`` is undefined."""
    parts = F.split(F.replace(gt, F.lit("|"), F.lit("/")), "/")
    return F.when(F.exists(parts, lambda x: x == "."), -1).otherwise(2 - F.aggregate(parts, F.lit(0), lambda s, x: s + F.least(x.cast("int"), F.lit(1))))


def ped_alleles(g: Column) -> Column:
    return F.when(g == 2, "1 1").when(g == 1, "1 2").when(g == 0, "2 2").otherwise("0 0")


def ped_genotype(pair: Column) -> Column:
    return F.when(pair == "1 1", 2).when(pair.isin("1 2", "2 1"), 1).when(pair == "2 2", 0).otherwise(9)
