"""Joins of positions with genes and exons, and what is read off them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nucleotides import consensus

#: Positions in a bin of the lowest level, how many bins make one of the next, and how many levels there are: 4096 * 16^5 positions are beyond any chromosome.
BIN, FAN, LEVELS = 4096, 16, 6


def in_bins(spans: DataFrame, width: int = BIN, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """Spans (start, end; both included) with ``level`` and ``bin``, a row for each bin of their cover.

    A span longer than ``fan`` bins of a level is covered by bins of the next one, but for what sticks out on either side: fewer than ``2 * fan`` bins
    a level, whatever its length.
    """
    rows, cover = spans.withColumn("low_", F.floor(F.col("start") / width)).withColumn("high_", F.floor(F.col("end") / width)), []
    struct = lambda level, a, b: F.transform(F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<long>")), lambda x: F.struct(F.lit(level).alias("level"), x.alias("bin")))
    for level in range(levels):
        low, high = F.col("low_"), F.col("high_")
        up, down = F.ceil(low / fan), F.floor((high + 1) / fan) - 1
        few = (high - low < fan) if level < levels - 1 else F.lit(True)
        rows = rows.withColumn(f"whole{level}_", struct(level, low, F.when(few, high).otherwise(up * fan - 1)))
        rows = rows.withColumn(f"rest{level}_", F.when(few, F.array().cast("array<struct<level:int,bin:bigint>>")).otherwise(struct(level, (down + 1) * fan, high)))
        cover += [f"whole{level}_", f"rest{level}_"]
        rows = rows.withColumns({"low_": F.when(few, 1).otherwise(up), "high_": F.when(few, 0).otherwise(down)})
    return rows.withColumn("cover_", F.explode(F.concat(*cover))).drop("low_", "high_", *cover).select("*", "cover_.*").drop("cover_")


def in_spans(sites: DataFrame, spans: DataFrame, width: int = BIN) -> DataFrame:
    """Sites (chrom, pos) within spans (chrom, start, end; both ends included).

    Spans get the bins of their cover, sites one bin of each level that occurs among spans, so this is an equi-join whose keys are even; the bins of
    a cover do not overlap, so a pair meets once.
    """
    binned = in_bins(spans.where("start <= end"), width)
    present = sorted(r["level"] for r in binned.select("level").distinct().collect())  # at most LEVELS
    at = [F.struct(F.lit(level).alias("level"), F.floor(F.col("pos") / (width * FAN**level)).alias("bin")) for level in present]
    keyed = sites.withColumn("cover_", F.explode(F.array(*at) if at else F.array().cast("array<struct<level:int,bin:bigint>>"))).select("*", "cover_.*").drop("cover_")
    return keyed.join(binned, ["chrom", "level", "bin"]).where(F.col("pos").between(F.col("start"), F.col("end"))).drop("level", "bin")


def trimmed_exons(genes: DataFrame) -> DataFrame:
    """(name, chrom, strand, cds_start, cds_end, starts, ends) -> exons cut to the coding part, with the coding length before each."""
    rows = genes.select("name", "chrom", "strand", "cds_start", "cds_end", F.inline(F.arrays_zip("starts", "ends")))
    rows = rows.select("name", "chrom", "strand", F.greatest("starts", "cds_start").alias("start"), F.least("ends", "cds_end").alias("stop")).where("start < stop")
    along = Window.partitionBy("name").orderBy("start")
    length = F.col("stop") - F.col("start")
    before = F.coalesce(F.sum(length).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("before", before).withColumn("total", F.sum(length).over(Window.partitionBy("name"))).withColumn("end", F.col("stop") - 1)


def coding_offsets(sites: DataFrame, exons: DataFrame) -> DataFrame:
    """Offset of each site in the coding sequence of each gene whose exon holds it, counted from the gene's own start."""
    rows = in_spans(sites, exons)
    forward = F.col("before") + F.col("pos") - F.col("start")
    offset = F.when(F.col("strand") == "-", F.col("total") - forward - 1).otherwise(forward)
    return rows.select("name", "chrom", "pos", offset.alias("offset"))


def masked(calls: DataFrame, base: Column, min_depth: int, min_share: float) -> DataFrame:
    """Bases as N where an individual's depth is low, and the whole site as N where too few individuals are covered."""
    deep = F.col("a") + F.col("b") >= min_depth
    share = F.avg(deep.cast("double")).over(Window.partitionBy("site"))
    return calls.select("site", "chrom", "pos", "ind", F.when(deep & (share >= min_share), base).otherwise("N").alias("base"))


def nearby_sequence(bases: DataFrame, width: int) -> DataFrame:
    """Bases of each window of ``width`` positions in order, as one string per individual."""
    rows = bases.groupBy("chrom", "ind", F.floor(F.col("pos") / width).alias("part")).agg(F.array_sort(F.collect_list(F.struct("pos", "base"))).alias("v"))
    return rows.select("chrom", "ind", "part", F.array_join("v.base", "").alias("sequence"))


def cut_by(sites: DataFrame, enzymes: DataFrame, chosen: list[str]) -> DataFrame:
    """Sites that at least one of the chosen enzymes cuts: (chrom, pos, enzymes array) on the right."""
    hit = enzymes.where(F.arrays_overlap("enzymes", F.array(*[F.lit(x) for x in chosen])))
    return sites.join(hit, ["chrom", "pos"], "left_semi")


def flanked(sites: DataFrame, flanks: DataFrame) -> DataFrame:
    """Sequence around each site as ``before n after``, its alleles, and the target of a primer design; null where unknown.

    A flank is text like ``ACG[A/C]TTG``.
    """
    at = F.instr("flank", "[")
    text = F.concat(F.substring_index("flank", "[", 1), F.lit("n"), F.substring_index("flank", "]", -1))
    target = F.concat((at - 6).cast("string"), F.lit(",11"))
    return sites.join(flanks, ["chrom", "pos"], "left").select("site", "chrom", "pos", text.alias("sequence"), F.regexp_extract("flank", r"\[(.*?)\]", 1).alias("alleles"), target.alias("target"))


def allele_order(cells: DataFrame) -> DataFrame:
    """(site, base) of both chromosomes of everyone -> ancestral (the more frequent, ties to the earlier letter) and derived base."""
    counts = cells.where(F.col("base").isin("A", "C", "G", "T")).groupBy("site", "base").agg(F.count("*").alias("n"))
    order = Window.partitionBy("site").orderBy(F.desc("n"), "base")
    rows = counts.withColumn("r", F.row_number().over(order))
    return rows.groupBy("site").agg(F.max(F.when(F.col("r") == 1, F.col("base"))).alias("ancestral"), F.coalesce(F.max(F.when(F.col("r") == 2, F.col("base"))), F.lit("N")).alias("derived"), F.max("r").cast("long").alias("alleles"))


def allele_codes(cells: DataFrame) -> DataFrame:
    """(site, ind, base), a nucleotide or a code of two -> ancestral and derived base, and each individual's copies of the first.

    The more frequent of the two is ancestral (ties to the earlier letter); N is undefined, as -1. With one letter and a code of two,
    the code is the derived one. Raises at a site with more than three letters, or whose three are not two bases and their code.
    """
    counts = cells.where("base <> 'N'").groupBy("site", "base").agg(F.count("*").alias("n"))
    letters = counts.groupBy("site").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "base"))).alias("v"), F.count("*").alias("k"))
    plain = F.filter("v.base", lambda x: x.isin("A", "C", "G", "T"))
    mixed = F.filter("v.base", lambda x: ~x.isin("A", "C", "G", "T"))
    three = (F.size("plain") == 2) & (F.size("mixed") == 1) & (consensus(F.get("plain", F.lit(0)), F.get("plain", F.lit(1))) == F.get("mixed", F.lit(0)))
    bad = (F.col("k") > 3) | (F.col("k") == 3) & ~F.coalesce(three, F.lit(False)) | (F.col("k") == 2) & (F.size("mixed") > 1)
    named = letters.withColumn("plain", plain).withColumn("mixed", mixed).withColumn("order", F.concat("plain", "mixed"))
    wrong = F.raise_error(F.concat(F.lit("not two alleles at site "), F.col("site").cast("string"))).cast("string")
    alleles = named.select("site", F.when(bad, wrong).otherwise(F.get("order", F.lit(0))).alias("ancestral"), F.coalesce(F.get("order", F.lit(1)), F.lit("N")).alias("derived"))
    code = F.when(F.col("base") == "N", -1).when(F.col("base") == F.col("ancestral"), 2).when(F.col("base") == F.col("derived"), 0).otherwise(1)
    return cells.join(alleles, "site", "left").select("site", "ind", F.coalesce("ancestral", F.lit("N")).alias("ancestral"), F.coalesce("derived", F.lit("N")).alias("derived"), code.cast("long").alias("g"))
