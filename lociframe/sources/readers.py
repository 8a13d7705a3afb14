"""Readers of population-genetics files. All give long tables: a row per site and individual.

Compressed text needs nothing special: Spark's readers take .gz and .bz2 files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.nucleotides import genotype_from_digits, genotype_from_vcf, ped_genotype
from ..operators import prefix
from ..operators.sequences import allele_codes
from .lines import checked_lines, ordered_lines, placed_lines
from .metadata import Metadata, leading_lines, read_header


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, line): lines, and what they are ordered by: the file's name, where the split of the file begins, and an id within it. Ids alone are no order, since Spark deals files to partitions by size."""
    return placed_lines(spark, path).select("value", F.struct("file", "start", "at").alias("line"))


def first_line(lines: DataFrame) -> Row | None:
    """The first of ``text_lines``: in the first file by name, however many there are."""
    return lines.agg(F.min(F.struct("line", "value")).alias("first")).first()["first"]


def data_rows(spark: SparkSession, path: str) -> DataFrame:
    """Cells of tab-separated lines, without comments and blank lines."""
    rows = text_lines(spark, path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return rows.select("line", F.split("value", "\t").alias("cell"))


def variant_table(spark: SparkSession, path: str, meta: Metadata | None = None) -> tuple[DataFrame, Metadata]:
    """(line, cell array, site key columns, calls array of structs) of a table with 4 or 1 columns per individual."""
    meta = meta or read_header(spark, path)
    starts = sorted(c for _, c in meta.individuals)
    four = len(starts) > 1 and starts[1] - starts[0] == 4 or len(starts) == 1 and len(meta.column_names) - starts[0] >= 3
    at = lambda c: F.get("cell", F.lit(c - 1))
    number = lambda c: at(c).try_cast("long")
    calls = []
    for i, (name, c) in enumerate(meta.individuals):
        fields = [F.lit(i).alias("ord"), F.lit(name).alias("ind")]
        if four:
            fields += [number(c).alias("a"), number(c + 1).alias("b"), number(c + 2).alias("g"), number(c + 3).alias("q")]
        else:
            fields += [F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"), number(c).alias("g"), F.lit(None).cast("long").alias("q")]
        calls.append(F.struct(*fields))
    column = lambda c, kind: at(c).try_cast(kind) if c else F.lit(None).cast(kind)
    empty = F.array().cast("array<struct<ord:int,ind:string,a:bigint,b:bigint,g:bigint,q:bigint>>")
    rows = data_rows(spark, path).select("line", "cell", column(meta.scaffold, "string").alias("scaffold"), column(meta.pos, "long").alias("pos"), column(meta.ref, "string").alias("chrom"), column(meta.rPos, "long").alias("ref_pos"), (F.array(*calls) if calls else empty).alias("calls"))
    return rows, meta


def long_calls(table: DataFrame) -> DataFrame:
    return table.select("line", "scaffold", "pos", F.inline("calls")).withColumn("g", F.when(F.col("g") >= 0, F.col("g")))


def checked_table(spark: SparkSession, path: str, columns: int, integers: list[int]) -> DataFrame:
    """Tab-separated rows; raises at a row with too few columns or a cell of ``integers`` that is no whole number, naming its line."""
    rows = checked_lines(spark, path, columns, {"cell": c for c in integers} if len(integers) < 2 else {f"cell {c}": c for c in integers})
    return rows.select(F.struct("file", "start", "at").alias("line"), "cell")


def individuals(spark: SparkSession, path: str) -> DataFrame:
    """(ord, col, name, alias) of a file of columns, names and aliases; an alias may be empty and its column missing."""
    rows = data_rows(spark, path)
    found = rows.select("line", F.get("cell", F.lit(0)).cast("int").alias("col"), F.get("cell", F.lit(1)).alias("name"), F.coalesce(F.get("cell", F.lit(2)), F.lit("")).alias("alias"))
    return found.select(F.row_number().over(Window.orderBy("line")).alias("ord"), "col", "name", "alias")


def tagged_individuals(spark: SparkSession, tags: list[str]) -> DataFrame:
    """From ``column:name`` tags."""
    rows = [(i + 1, int(c), n) for i, (c, _, n) in enumerate(t.partition(":") for t in tags)]
    return spark.createDataFrame(rows, "ord int, col int, name string")


def individual_names(spark: SparkSession, path: str) -> DataFrame:
    """(name, keywords): the first word of a line, and the others joined by one blank; raises at a repeated name."""
    words = F.split(F.trim("value"), r"\s+")
    rows = text_lines(spark, path).where(F.trim("value") != "").select(words[0].alias("name"), F.array_join(F.slice(words, 2, 1 << 20), " ").alias("keywords"))
    repeated = rows.groupBy("name").count().where("count > 1").select("name").limit(1).collect()
    if repeated:
        raise ValueError(f"repeated name: {repeated[0]['name']}")
    return rows


def _site(text: Column) -> list[Column]:
    parts = F.split(F.trim(text), r"\s+")
    return [parts[0].alias("chrom"), parts[1].cast("long").alias("pos")]


def csv_genotypes(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos, ind, cell, g) of a table whose head names individuals; g is null where cells are nucleotides."""
    lines = text_lines(spark, path)
    head = first_line(lines)
    names = [x.strip() for x in head["value"].split(",")[1:]]
    rows = lines.where((F.col("line") > F.struct(*[F.lit(x).cast(t).alias(n) for n, t, x in zip(("file", "start", "at"), ("string", "long", "long"), head["line"], strict=True)])) & (F.trim("value") != "")).select(F.split("value", ",").alias("cell"))
    people = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("ind"), F.transform(F.slice("cell", 2, len(names)), lambda x: F.trim(x)).alias("cell"))
    found = rows.select(*_site(F.col("cell")[0]), F.inline(people).alias("ind", "cell"))
    return found.withColumn("g", F.when(F.col("cell").rlike("^[0-9]+$"), genotype_from_digits(F.col("cell"))))


def csv_allele_codes(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos, ind, g) of either kind of table: digits as they are, nucleotides as copies of the ancestral base."""
    rows = csv_genotypes(spark, path)
    letters = rows.where("g IS NULL").select(F.concat_ws(" ", "chrom", "pos").alias("site"), "ind", F.upper("cell").alias("base"))
    coded = allele_codes(letters).select(F.substring_index("site", " ", 1).alias("chrom"), F.substring_index("site", " ", -1).cast("long").alias("pos"), "ind", "g")
    return rows.where("g IS NOT NULL").select("chrom", "pos", "ind", F.col("g").cast("long").alias("g")).union(coded)


def map_sites(spark: SparkSession, path: str) -> DataFrame:
    """(line, chrom, snp, pos) of lines of chromosome, name, genetic distance and position."""
    words = F.split(F.trim("value"), r"\s+")
    return text_lines(spark, path).where(F.trim("value") != "").select("line", words[0].alias("chrom"), words[1].alias("snp"), words[3].cast("long").alias("pos"))


def founder_kinship(spark: SparkSession, path: str) -> DataFrame:
    """(id1, id2, kinship) of lines of two names and a number."""
    words = F.split(F.trim("value"), r"\s+")
    return text_lines(spark, path).where(F.trim("value") != "").select(words[0].alias("id1"), words[1].alias("id2"), words[2].cast("double").alias("kinship"))


def option_list(spark: SparkSession, path: str) -> DataFrame:
    """(line, name, value) of a list of choices: tab-separated lines without comments; a line of one cell is its own value."""
    return data_rows(spark, path).select("line", F.col("cell")[0].alias("name"), F.element_at("cell", -1).alias("value"))


def checked_primers(spark: SparkSession, path: str) -> DataFrame:
    """Primers, raising at a record without scaffold or position, and where a site has two records."""
    rows = primers(spark, path)
    same = F.count("*").over(Window.partitionBy("chrom", "pos"))
    wrong = F.raise_error(F.concat(F.lit("bad or repeated primer record: "), F.substring_index("entry", "\n", 1)))
    bad = F.col("chrom").isNull() | F.col("pos").isNull() | (same > 1)
    return rows.select("chrom", "pos", "enzymes", F.when(bad, wrong.cast("string")).otherwise(F.col("entry")).alias("entry"))


def _located(rows: DataFrame, loci: DataFrame) -> DataFrame:
    """(ind, cells) and (locus number, chrom, pos) -> a row per locus and individual."""
    cells = rows.select("ind", F.posexplode("cells").alias("locus", "cell"))
    return cells.join(loci, "locus").select("chrom", "pos", "ind", "cell", genotype_from_digits(F.col("cell")).alias("g"))


def fstat_genotypes(spark: SparkSession, path: str) -> DataFrame:
    """A line of four numbers, of which the second counts the loci; a line per locus; a line per individual."""
    first = next(x for x in leading_lines(spark, path) if x.strip())
    loci_number = int(first.split()[1])
    numbered = ordered_lines(placed_lines(spark, path).where(F.trim("value") != ""))
    loci = numbered.where(F.col("n").between(2, loci_number + 1)).select((F.col("n") - 2).alias("locus"), *_site(F.col("value")))
    words = F.split(F.trim("value"), r"\s+")
    return _located(numbered.where(F.col("n") > loci_number + 1).select(words[0].alias("ind"), F.slice(words, 2, loci_number).alias("cells")), loci)


def genepop_genotypes(spark: SparkSession, path: str) -> DataFrame:
    """A title, loci (by commas or a line each), then ``POP`` lines and individuals as ``name, cell cell ...``."""
    numbered = ordered_lines(placed_lines(spark, path).where(F.trim("value") != "")).withColumn("is_pop", F.upper(F.trim("value")) == "POP")
    first = numbered.where("is_pop").agg(F.coalesce(F.min("n"), F.lit(1 << 62)).alias("pop"))  # one row
    numbered = numbered.join(F.broadcast(first))
    names = numbered.where("n < pop AND n > 1").select("n", F.posexplode(F.split("value", ",")).alias("j", "locus")).where(F.trim("locus") != "")
    loci = prefix.numbered(names, "number", F.asc("n"), F.asc("j")).select(F.col("number").alias("locus"), *_site(F.col("locus")))
    rows = numbered.where("n > pop AND NOT is_pop")
    return _located(rows.select(F.trim(F.substring_index("value", ",", 1)).alias("ind"), F.split(F.trim(F.substring_index("value", ",", -1)), r"\s+").alias("cells")), loci)


def vcf_genotypes(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos, ref, alt, qual, ind, g, a, b, q); reads and quality are null where a row has no AD or GQ."""
    lines = text_lines(spark, path)
    head = first_line(lines.where(F.col("value").startswith("#CHROM")))
    names = head["value"].split()[9:]
    rows = lines.where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(F.split(F.trim("value"), r"\s+").alias("c"))
    people = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("ind"), F.slice("c", 10, len(names)).alias("cell"))
    found = rows.select(F.col("c")[0].alias("chrom"), F.col("c")[1].cast("long").alias("pos"), F.col("c")[3].alias("ref"), F.col("c")[4].alias("alt"), F.col("c")[5].try_cast("double").alias("qual"), F.split(F.col("c")[8], ":").alias("keys"), F.inline(people).alias("ind", "cell"))
    parts = F.split("cell", ":")
    value = lambda key: F.get(parts, F.array_position("keys", key).cast("int") - 1)
    reads = F.split(value("AD"), ",")
    return found.select("chrom", "pos", "ref", "alt", "qual", "ind", genotype_from_vcf(F.coalesce(value("GT"), F.lit("./."))).alias("g"), F.get(reads, F.lit(0)).try_cast("long").alias("a"), F.get(reads, F.lit(1)).try_cast("long").alias("b"), value("GQ").try_cast("long").alias("q"))


def ped_genotypes(spark: SparkSession, path: str) -> DataFrame:
    """(ind, snp, g): six leading fields, then two alleles per SNP; 9 is undefined."""
    words = F.split(F.trim("value"), r"\s+")
    rows = text_lines(spark, path).where(F.trim("value") != "").select(words[0].alias("ind"), F.slice(words, 7, 1 << 30).alias("v"))
    cells = rows.select("ind", "v", F.explode(F.sequence(F.lit(0), F.floor(F.size("v") / 2).cast("int") - 1)).alias("snp"))
    pair = F.concat_ws(" ", F.get("v", F.col("snp") * 2), F.get("v", F.col("snp") * 2 + 1))
    return cells.select("ind", "snp", ped_genotype(pair).alias("g"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path, lineSep=">").where(F.trim("value") != "")
    first = F.substring_index("value", "\n", 1)
    body = F.substring(F.col("value"), F.length(first) + 1, F.length("value"))
    return rows.select(F.split(F.trim(first), r"\s+")[0].alias("name"), F.regexp_replace(body, r"\s", "").alias("sequence"))


def gene_annotation(spark: SparkSession, path: str, columns: dict[str, int]) -> DataFrame:
    """Picks columns by number: name, chrom, strand, tx_start, tx_end, cds_start, cds_end, starts, ends."""
    at = lambda k: F.get("cell", F.lit(columns[k] - 1))
    numbers = lambda k: F.transform(F.filter(F.split(at(k), ","), lambda x: x != ""), lambda x: x.cast("long"))
    whole = [at(k).cast("long").alias(k) for k in ("tx_start", "tx_end", "cds_start", "cds_end")]
    return data_rows(spark, path).select(at("name").alias("name"), at("chrom").alias("chrom"), at("strand").alias("strand"), *whole, numbers("starts").alias("starts"), numbers("ends").alias("ends"))


def primers(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos, enzymes, entry) of records headed ``>scaffold pos``, whose second line lists enzymes by commas."""
    rows = spark.read.text(path, lineSep=">").where(F.trim("value") != "").select(F.split("value", "\n").alias("v"))
    key = F.split(F.trim(F.col("v")[0]), r"\s+")
    enzymes = F.filter(F.transform(F.split(F.get("v", F.lit(1)), ","), lambda x: F.trim(x)), lambda x: x != "")
    return rows.select(key[0].alias("chrom"), key[1].cast("long").alias("pos"), enzymes.alias("enzymes"), F.array_join("v", "\n").alias("entry"))


def flanks(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos, flank) of tab-separated scaffold, position, bracketed sequence."""
    at = lambda i: F.get("cell", F.lit(i))
    return data_rows(spark, path).select(at(0).alias("chrom"), at(1).cast("long").alias("pos"), at(2).alias("flank"))


def locations(spark: SparkSession, path: str, last_wins: bool = False) -> DataFrame:
    """(key, value) of a lookup file; of a repeated key the first or the last line counts."""
    rows = data_rows(spark, path).select("line", F.get("cell", F.lit(0)).alias("key"), F.get("cell", F.lit(1)).alias("value"))
    pick = F.max_by("value", "line") if last_wins else F.min_by("value", "line")
    return rows.groupBy("key").agg(pick.alias("value"))


def conflicting_locations(spark: SparkSession, path: str) -> DataFrame:
    rows = data_rows(spark, path).select(F.get("cell", F.lit(0)).alias("key"), F.get("cell", F.lit(1)).alias("value"))
    return rows.groupBy("key").agg(F.count_distinct("value").alias("n")).where("n > 1").select("key")


def chromosome_lengths(spark: SparkSession, path: str) -> DataFrame:
    words = F.split(F.trim("value"), r"\s+")
    rows = text_lines(spark, path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return rows.select(words[0].alias("chrom"), words[1].cast("long").alias("length"))


def weighted_edges(spark: SparkSession, path: str) -> DataFrame:
    words = F.split(F.trim("value"), r"\s+")
    rows = text_lines(spark, path).select(words.alias("w")).where(F.size("w") >= 3)
    return rows.select(F.col("w")[0].alias("mother"), F.col("w")[1].alias("father"), F.col("w")[2].cast("double").alias("weight"))


def first_words(spark: SparkSession, path: str) -> DataFrame:
    return text_lines(spark, path).where(F.trim("value") != "").select(F.split(F.trim("value"), r"\s+")[0].alias("name"))


def pedigree(spark: SparkSession, path: str) -> DataFrame:
    """(ord, id, p1, p2): founders have ``-`` as parents."""
    words = F.split(F.trim("value"), r"\s+")
    parent = lambda i: F.nullif(F.get(words, F.lit(i)), F.lit("-"))
    return text_lines(spark, path).where(F.trim("value") != "").select(F.col("line").alias("ord"), words[0].alias("id"), parent(1).alias("p1"), parent(2).alias("p2"))


def pathway_graphs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """KGML files -> genes (pathway, node, gene) and edges (pathway, src, dst); a reversible reaction has both directions."""
    schema = "_name string, entry array<struct<_id:long,_name:string,_type:string>>, reaction array<struct<_id:long,_type:string,substrate:array<struct<_id:long>>,product:array<struct<_id:long>>>>"
    rows = spark.read.format("xml").option("rowTag", "pathway").schema(schema).load(path).select(F.regexp_replace("_name", "^path:", "").alias("pathway"), "entry", "reaction")
    entry = rows.select("pathway", F.explode("entry").alias("e"))
    genes = entry.where("e._type = 'gene'").select("pathway", F.col("e._id").alias("node"), F.explode(F.split(F.trim("e._name"), r"\s+")).alias("gene"))
    reaction = rows.select("pathway", F.explode("reaction").alias("r"))
    ends = reaction.select("pathway", F.col("r._id").alias("node"), F.col("r._type").alias("kind"), "r.substrate", "r.product")
    into = ends.select("pathway", "node", "kind", F.explode("substrate._id").alias("other"))
    out = ends.select("pathway", "node", "kind", F.explode("product._id").alias("other"))
    one = [into.select("pathway", F.col("other").alias("src"), F.col("node").alias("dst")), out.select("pathway", F.col("node").alias("src"), F.col("other").alias("dst"))]
    back = [into.where("kind = 'reversible'").select("pathway", F.col("node").alias("src"), F.col("other").alias("dst")), out.where("kind = 'reversible'").select("pathway", F.col("other").alias("src"), F.col("node").alias("dst"))]
    return genes, reduce(DataFrame.union, one + back).distinct()
