"""Writers: rows become text in parallel; headers of a few lines come from the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nucleotides import ped_alleles
from ..functions.text_rules import underscored
from .metadata import Metadata, header_lines

#: What a VCF 4.1 file for submission begins with.
VCF_HEAD = ("##fileformat=VCFv4.1", '##INFO=<ID=VRT,Number=1,Type=Integer,Description="Kind of variation; 1 stands for a change of one nucleotide">', '##FORMAT=<ID=NA,Number=1,Type=Integer,Description="Number of alleles for the population">', '##FORMAT=<ID=AC,Number=.,Type=Integer,Description="Allele count for each alternate allele">')


def headed(rows: DataFrame, head: list[str], by: tuple[str, ...] = ("place",)) -> DataFrame:
    """The lines ``value`` in order of ``by``, below lines of a head; ranges keep the order, so no task sees all rows."""
    top = rows.sparkSession.createDataFrame([(x, i) for i, x in enumerate(head)] or [("", 0)][:0], "value string, head long")
    return top.unionByName(rows.select("value", F.lit(len(head)).cast("long").alias("head"), *by), allowMissingColumns=True).orderBy("head", *by).select("value")


def write_table(rows: DataFrame, path: str, meta: Metadata | None = None) -> None:
    """Rows (line, cell array) as tab-separated text, below their header."""
    lines = rows.select(F.array_join("cell", "\t", "").alias("value"), F.col("line").alias("place"))
    headed(lines, header_lines(meta) if meta else []).write.text(path)


def write_individuals(people: DataFrame, path: str) -> None:
    people.orderBy("col").select(F.concat_ws("\t", F.col("col").cast("string"), "name", F.lit("")).alias("value")).write.text(path)


def vcf_lines(sites: DataFrame, population: str | None = None) -> DataFrame:
    """(chrom, pos, a, b, qual[, na, ac]) -> VCF lines; raises at an allele that is no nucleotide or a count above the total."""
    named = F.col("a").isin("A", "C", "G", "T") & F.col("b").isin("A", "C", "G", "T")
    cells = [F.col("chrom"), F.col("pos").cast("string"), F.concat_ws(";", "chrom", F.col("pos").cast("string")), F.when(named, F.col("a")).otherwise(F.raise_error(F.lit("allele is not A, C, G or T")).cast("string")), F.col("b"), F.coalesce(F.col("qual").cast("string"), F.lit(".")), F.lit("."), F.lit("VRT=6")]
    head = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"]
    if population:
        counts = F.concat_ws(":", F.col("na").cast("string"), F.col("ac").cast("string"))
        cells += [F.lit("NA:AC"), F.when(F.col("ac") > F.col("na"), F.raise_error(F.lit("more alleles than chromosomes")).cast("string")).otherwise(counts)]
        head += ["FORMAT", population]
    return headed(sites.select(F.concat_ws("\t", *cells).alias("value"), "chrom", "pos"), [*VCF_HEAD, "\t".join(head)], ("chrom", "pos"))


def write_phylip(alignments: DataFrame, path: str) -> None:
    """(gene, name, sequence) -> a folder per gene with ``n length`` and a line per name."""
    per = alignments.groupBy("gene").agg(F.count("*").alias("n"), F.max(F.length("sequence")).alias("length"), F.array_sort(F.collect_list(F.struct("name", "sequence"))).alias("v"))
    lines = F.concat(F.array(F.concat_ws(" ", F.col("n").cast("string"), F.col("length").cast("string"))), F.transform("v", lambda x: F.concat_ws("\t", x["name"], x["sequence"])))
    per.select("gene", F.array_join(lines, "\n").alias("value")).write.partitionBy("gene").text(path)


def matrix_lines(cells: DataFrame, value: str, fmt: str = "%.4f") -> DataFrame:
    """(i, j, value) of all ordered pairs -> a PHYLIP matrix: its size, then a line per name."""
    rows = cells.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", F.format_string(fmt, F.col(value)).alias("x")))).alias("v"))
    lines = rows.select(F.concat_ws(" ", F.rpad(F.col("i").cast("string"), 10, " "), F.array_join("v.x", " ")).alias("value"), F.dense_rank().over(Window.orderBy("i")).alias("place"))
    return headed(lines, [str(rows.count())])


def ped_lines(calls: DataFrame, place: Column) -> DataFrame:
    """(ind, site, g) -> a line per individual: name, fixed fields, two alleles per site in the order of ``place``."""
    rows = calls.groupBy("ind").agg(F.array_sort(F.collect_list(F.struct(place.alias("p"), ped_alleles(F.col("g")).alias("x")))).alias("v"))
    return rows.select(F.concat_ws(" ", F.col("ind").cast("string"), F.lit("1 0 0 1 1"), F.array_join("v.x", " ")).alias("value"))


def map_lines(sites: DataFrame) -> DataFrame:
    return sites.orderBy("pos").select(F.concat_ws(" ", F.lit("1"), F.concat(F.lit("snp"), F.col("site").cast("string")), F.lit("0"), F.col("pos").cast("string")).alias("value"))


def eigenstrat_lines(calls: DataFrame) -> DataFrame:
    """A line per site: a digit for each individual, 9 undefined."""
    cell = F.when(F.col("g").isin(0, 1, 2), F.col("g").cast("string")).otherwise("9")
    rows = calls.groupBy("site").agg(F.array_sort(F.collect_list(F.struct("ind", cell.alias("x")))).alias("v"))
    return rows.orderBy("site").select(F.array_join("v.x", "").alias("value"))


def bedgraph_lines(runs: DataFrame) -> DataFrame:
    return runs.orderBy("chrom", "start").select(F.concat_ws("\t", F.col("chrom").cast("string"), F.col("start").cast("string"), F.col("end").cast("string"), F.format_string("%.4f", F.col("score").cast("double"))).alias("value"))


def append_names(names: DataFrame, path: str) -> None:
    names.select(F.col("name").alias("value")).write.mode("append").text(path)


def mega_lines(cells: DataFrame, value: str, title: str) -> DataFrame:
    """(i, j, value) of all ordered pairs -> a lower triangle of distances with names before it."""
    names = cells.select("i").distinct()
    heads = names.select(F.concat(F.lit("#"), F.col("i").cast("string")).alias("value"), F.dense_rank().over(Window.orderBy("i")).alias("place"))
    below = F.array_sort(F.collect_list(F.when(F.col("j") < F.col("i"), F.struct("j", F.format_string("%.4f", F.col(value)).alias("x")))))
    rows = cells.groupBy("i").agg(below.alias("v"))
    lines = rows.select(F.array_join("v.x", " ").alias("value"), (F.dense_rank().over(Window.orderBy("i")) + (1 << 20)).alias("place")).where("value <> ''")
    return headed(heads.union(lines), ["#mega", f"!Title: {title};", "!Format DataType=Distance DataFormat=LowerLeft;"])


def eigenstrat_snp_lines(sites: DataFrame) -> DataFrame:
    """A line per site in the order of ``eigenstrat_lines``; chromosome, distances and bases are place holders."""
    return sites.orderBy("site").select(F.concat(F.lit("  snp"), F.col("site").cast("string"), F.lit(" 11 0.002 2000 A T")).alias("value"))


def eigenstrat_ind_lines(people: DataFrame) -> DataFrame:
    """(ord, population) -> a line per individual, numbered from 0."""
    return people.orderBy("ord").select(F.concat_ws(" ", F.concat(F.lit("ind_"), F.col("ord").cast("string")), F.lit("M"), underscored(F.col("population"))).alias("value"))


def eigenstrat_parameters(genotypes: str, snps: str, individuals: str, vectors: str, values: str, components: int = 2) -> list[str]:
    named = {"genotypename": genotypes, "snpname": snps, "indivname": individuals, "evecoutname": vectors, "evaloutname": values, "altnormstyle": "NO", "numoutevec": components}
    return [f"{k}: {v}" for k, v in named.items()]


def link_lines(runs: DataFrame) -> DataFrame:
    return runs.orderBy("chrom", "start", "end").select(F.concat_ws(" ", F.col("chrom").cast("string"), F.col("start").cast("string"), F.col("end").cast("string")).alias("value"))


def submission_lines(handle: str, batch: str, populations: list[str]) -> list[str]:
    """The template of a variant submission: a section per subject, to be filled in by hand."""
    sections = [("CONT", ["NAME", "FAX", "TEL", "EMAIL", "LAB", "INST", "ADDR"], {}), ("METHOD", ["ID", "METHOD_CLASS", "TEMPLATE_TYPE", "METHOD"], {"METHOD_CLASS": "Sequence"})]
    sections += [("POPULATION", ["ID", "POPULATION"], {"ID": p}) for p in populations]
    sections += [("SNPASSAY", ["BATCH", "MOLTYPE", "METHOD", "ORGANISM"], {"BATCH": batch}), ("SNPPOPUSE | SNPINDUSE", ["BATCH", "METHOD"], {})]
    return [line for kind, keys, known in sections for line in (f"TYPE: {kind}", f"HANDLE: {handle}", *(f"{k}: {known.get(k, '')}" for k in keys), "||")]
