"""More formats written and read back: genotype files of other programs, lookups, names, pedigrees, pathways and sequences."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nucleotides import genotype_from_digits, ped_alleles, ped_genotype
from ..functions.storage import shared_folder
from ..operators import enrichment, ordered, pairs
from ..sources import readers, writers
from .catalog import query
from .format_queries import written
from .site_queries import WITH, rounded
from .views import DIGRAPH, PEDIGREE, calls, digraph, load, pedigree

DEFINED = f"{WITH} SELECT 'c' || chrom AS chrom, pos, 'i' || ind AS ind, g FROM calls WHERE g >= 0"


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def digits(g: Column) -> Column:
    return F.when(g == 2, "11").when(g == 1, "12").when(g == 0, "22").otherwise("0")


def told(found: DataFrame) -> DataFrame:
    return found.where("g >= 0").select("chrom", "pos", "ind", F.col("g").cast("long").alias("g"))


def by_individual(c: DataFrame) -> DataFrame:
    """(ind, cells): a cell for each site in order of position. The view's individuals are eight."""
    cells = c.groupBy("pos").agg(*[F.coalesce(F.max(F.when(F.col("ind") == i, digits(F.col("g")))), F.lit("0")).alias(f"i{i}") for i in range(8)])
    whole = cells.agg(*[F.array_join(F.array_sort(F.collect_list(F.struct("pos", F.col(f"i{i}").alias("x")))).x, " ").alias(f"i{i}") for i in range(8)])
    return whole.select(F.explode(F.array(*[F.struct(F.lit(f"i{i}").alias("ind"), F.col(f"i{i}").alias("cells")) for i in range(8)])).alias("v")).select("v.*")


def loci_lines(c: DataFrame) -> DataFrame:
    return c.select("chrom", "pos").distinct().select(text("c", F.col("chrom"), " ", F.col("pos")).alias("value"), F.lit(0).alias("part"), F.col("pos").alias("place"))


@query(DEFINED)
def fstat_round_trip(spark: SparkSession, d: str) -> DataFrame:
    c = calls(spark, d)
    loci = loci_lines(c)
    people = by_individual(c).select(text(F.col("ind"), " ", F.col("cells")).alias("value"), F.lit(1).alias("part"), F.substring("ind", 2, 9).cast("long").alias("place"))
    return told(readers.fstat_genotypes(spark, written(writers.headed(loci.union(people), [f"1 {loci.count()} 2 1"], ("part", "place")), "fstat")))


@query(DEFINED)
def genepop_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Two populations: those of even and of odd numbers."""
    c = calls(spark, d)
    odd = F.substring("ind", 2, 9).cast("long") % 2
    people = by_individual(c).select(text(F.col("ind"), " , ", F.col("cells")).alias("value"), (2 * odd + 2).cast("int").alias("part"), F.substring("ind", 2, 9).cast("long").alias("place"))
    pops = spark.range(2).select(F.lit("Pop").alias("value"), (2 * F.col("id") + 1).cast("int").alias("part"), F.lit(0).cast("long").alias("place"))
    return told(readers.genepop_genotypes(spark, written(writers.headed(loci_lines(c).union(pops).union(people), ["a title"], ("part", "place")), "genepop")))


@query(f"{WITH} SELECT 'c' || chrom AS chrom, pos, 'A' AS ref, 'i' || ind AS ind, g, a, b, q FROM calls")
def vcf_round_trip(spark: SparkSession, d: str) -> DataFrame:
    gt = F.when(F.col("g") == 2, "0/0").when(F.col("g") == 1, "0/1").when(F.col("g") == 0, "1/1").otherwise("./.")
    cells = [F.coalesce(F.max(F.when(F.col("ind") == i, text(gt, ":", F.col("q"), ":", F.col("a"), ",", F.col("b")))), F.lit("none")).alias(f"i{i}") for i in range(8)]
    rows = calls(spark, d).groupBy("chrom", "pos").agg(*cells)
    lines = rows.select(F.concat_ws("\t", text("c", F.col("chrom")), F.col("pos").cast("string"), F.lit("."), F.lit("A"), F.lit("C"), F.lit("7.5"), F.lit("."), F.lit("."), F.lit("GT:GQ:AD"), *[f"i{i}" for i in range(8)]).alias("value"), "pos")
    head = ["##fileformat=VCFv4.1", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + "\t".join(f"i{i}" for i in range(8))]
    found = readers.vcf_genotypes(spark, written(writers.headed(lines.withColumnRenamed("pos", "place"), head), "vcf"))
    return found.where("q IS NOT NULL").select("chrom", "pos", "ref", "ind", F.col("g").cast("long").alias("g"), "a", "b", "q")


@query(f"{WITH} SELECT 'c' || chrom AS chrom, pos, 'c' || chrom || ';' || pos AS id, 'A' AS ref, 'C' AS alt, CAST(sum(CASE WHEN g >= 0 THEN 2 ELSE 0 END) AS BIGINT) AS na, CAST(sum(CASE WHEN g >= 0 THEN 2 - g ELSE 0 END) AS BIGINT) AS ac FROM calls GROUP BY site, chrom, pos")
def vcf_counts_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Sites of a population as written for submission."""
    g = F.col("g")
    sites = calls(spark, d).groupBy(text("c", F.col("chrom")).alias("chrom"), "pos").agg(F.sum(F.when(g >= 0, 2).otherwise(0)).alias("na"), F.sum(F.when(g >= 0, 2 - g).otherwise(0)).alias("ac"))
    lines = writers.vcf_lines(sites.select("*", F.lit("A").alias("a"), F.lit("C").alias("b"), F.lit(None).cast("double").alias("qual")), "everyone")
    cell = readers.data_rows(spark, written(lines, "sites")).select("cell")
    at = lambda i: F.col("cell")[i]
    counts = F.split(at(9), ":")
    return cell.select(at(0).alias("chrom"), at(1).cast("long").alias("pos"), at(2).alias("id"), at(3).alias("ref"), at(4).alias("alt"), counts[0].cast("long").alias("na"), counts[1].cast("long").alias("ac"))


@query(f"""{WITH} SELECT 'g' || chrom AS gene, 'i' || ind AS name, string_agg(CASE g WHEN 2 THEN 'A' WHEN 0 THEN 'C' WHEN 1 THEN 'M' ELSE 'N' END, '' ORDER BY pos) AS sequence FROM calls GROUP BY 1, 2""")
def phylip_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """An alignment per gene in a folder of its own."""
    letter = F.when(F.col("g") == 2, "A").when(F.col("g") == 0, "C").when(F.col("g") == 1, "M").otherwise("N")
    rows = calls(spark, d).groupBy(text("g", F.col("chrom")).alias("gene"), text("i", F.col("ind")).alias("name")).agg(F.array_join(F.array_sort(F.collect_list(F.struct("pos", letter.alias("x")))).x, "").alias("sequence"))
    path = f"{shared_folder(spark)}/phylip-{uuid.uuid4().hex}"
    writers.write_phylip(rows, path)
    back = spark.read.text(path).select("gene", F.split("value", "\t").alias("v")).where(F.size("v") == 2)
    return back.select("gene", F.col("v")[0].alias("name"), F.col("v")[1].alias("sequence"))


DISTANCE = f"""{WITH}, v AS (SELECT site, ind, a / (a + b)::DOUBLE AS f FROM calls WHERE a + b >= 1),
    dist AS (SELECT x.ind AS i, y.ind AS j, avg(abs(x.f - y.f)) AS distance FROM v x JOIN v y ON x.site = y.site AND x.ind <> y.ind GROUP BY 1, 2)"""


def both_orders(spark: SparkSession, d: str) -> DataFrame:
    half = pairs.pair_distance(calls(spark, d)).select("i", "j", "distance")
    itself = spark.range(8).select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit(0.0).alias("distance"))
    return half.union(half.select("j", "i", "distance")).union(itself)


@query(f"{DISTANCE} SELECT i, j, round(distance, 3) AS distance FROM dist UNION ALL SELECT unnest(range(8)), unnest(range(8)), 0.0::DOUBLE")
def distance_matrix_round_trip(spark: SparkSession, d: str) -> DataFrame:
    rows = readers.text_lines(spark, written(writers.matrix_lines(both_orders(spark, d), "distance", "%.8f"), "matrix")).select(F.split(F.trim("value"), r"\s+").alias("w")).where(F.size("w") > 1)
    found = rows.select(F.col("w")[0].cast("long").alias("i"), F.posexplode(F.slice("w", 2, 1 << 20)).alias("j", "x"))
    return rounded(found.select("i", F.col("j").cast("long").alias("j"), F.col("x").cast("double").alias("distance")), "distance", digits=3)


@query(f"{DISTANCE} SELECT i, j, round(distance, 2) AS distance FROM dist WHERE j < i")
def mega_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The lower triangle: its rows have as many numbers as individuals before them."""
    lines = readers.text_lines(spark, written(writers.mega_lines(both_orders(spark, d), "distance", "x"), "mega"))
    rows = lines.where(F.col("value").rlike("^[0-9]")).select(F.split("value", " ").alias("w"))
    found = rows.select(F.size("w").cast("long").alias("i"), F.posexplode("w").alias("j", "x"))
    return rounded(found.select("i", F.col("j").cast("long").alias("j"), F.col("x").cast("double").alias("distance")), "distance", digits=2)


@query("SELECT p_name || '_' || p_partkey AS name, replace(repeat(p_brand, p_size::INTEGER), '#', 'N') AS sequence FROM part".replace("p_name || '_'", "replace(p_name, ' ', '_') || '_'"))
def fasta_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Sequences in lines of 60 letters."""
    sequence = F.replace(F.repeat("p_brand", F.col("p_size").cast("int")), F.lit("#"), F.lit("N"))
    folded = F.regexp_replace(sequence, "(.{60})", "$1\n")
    rows = load(spark, d, "part").select(text(">", F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), "_", F.col("p_partkey"), " a remark\n", folded).alias("value"))
    return readers.fasta(spark, written(rows, "fasta"))


@query(f"WITH {PEDIGREE} SELECT id::VARCHAR AS id, p1::VARCHAR AS p1, p2::VARCHAR AS p2 FROM pedigree")
def pedigree_round_trip(spark: SparkSession, d: str) -> DataFrame:
    parent = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    rows = pedigree(spark, d).select(text(F.col("id"), "  ", parent("p1"), " ", parent("p2"), " more").alias("value"))
    return readers.pedigree(spark, written(rows, "pedigree")).select("id", "p1", "p2")


@query("SELECT s_suppkey::VARCHAR AS id1, s_nationkey::VARCHAR AS id2, s_acctbal AS kinship, s_suppkey::VARCHAR AS mother, 'f' || s_nationkey AS father, s_acctbal AS weight FROM supplier")
def pair_files_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Founders' kinship and weighted mates, met by the first name."""
    s = load(spark, d, "supplier")
    phi = readers.founder_kinship(spark, written(s.select(F.concat_ws(" ", "s_suppkey", "s_nationkey", "s_acctbal").alias("value")), "founders"))
    mates = readers.weighted_edges(spark, written(s.select(text(F.col("s_suppkey"), "\t", text("f", F.col("s_nationkey")), " ", F.col("s_acctbal")).alias("value")), "mates"))
    return phi.join(mates, F.col("id1") == F.col("mother"))


@query(f"""WITH {DIGRAPH}, n AS (SELECT pathway, src AS node FROM digraph UNION SELECT pathway, dst FROM digraph)
    SELECT pathway, src, (1000 + src * 100 + dst)::BIGINT AS dst, NULL AS gene FROM digraph UNION ALL SELECT pathway, (1000 + src * 100 + dst)::BIGINT, dst, NULL FROM digraph
    UNION ALL SELECT pathway, dst, (1000 + src * 100 + dst)::BIGINT, NULL FROM digraph WHERE (src + dst) % 3 = 0 UNION ALL SELECT pathway, (1000 + src * 100 + dst)::BIGINT, src, NULL FROM digraph WHERE (src + dst) % 3 = 0
    UNION ALL SELECT pathway, node, -1::BIGINT, 'x:' || (node + k) FROM n, (VALUES (0), (1)) v(k)""")
def kgml_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Pathways as XML: each edge goes through a reaction, every third one is reversible, and each compound has an entry with two genes."""
    e = digraph(spark, d)
    kind = F.when((F.col("src") + F.col("dst")) % 3 == 0, "reversible").otherwise("irreversible")
    reaction = F.format_string('<reaction id="%d" type="%s"><substrate id="%d"/><product id="%d"/></reaction>', 1000 + F.col("src") * 100 + F.col("dst"), kind, F.col("src"), F.col("dst"))
    nodes = e.select("pathway", F.explode(F.array("src", "dst")).alias("node")).distinct()
    entry = F.format_string('<entry id="%d" name="x:%d x:%d" type="gene"/><entry id="%d" name="c" type="compound"/>', F.col("node"), F.col("node"), F.col("node") + 1, F.col("node"))
    inside = e.select("pathway", reaction.alias("x")).union(nodes.select("pathway", entry.alias("x"))).groupBy("pathway").agg(F.array_join(F.array_sort(F.collect_list("x")), "\n").alias("x"))
    value = F.concat(F.lit('<pathway name="path:'), F.replace(F.col("pathway"), F.lit("#"), F.lit("-")), F.lit('" number="1">\n'), "x", F.lit("\n</pathway>"))
    path = f"{shared_folder(spark)}/kgml-{uuid.uuid4().hex}"
    inside.select(F.col("pathway").alias("map"), value.alias("value")).write.partitionBy("map").text(path)
    genes, edges = readers.pathway_graphs(spark, path)
    both = edges.select("pathway", "src", "dst", F.lit(None).cast("string").alias("gene")).union(genes.select("pathway", "node", F.lit(-1).cast("long"), "gene"))
    return both.withColumn("pathway", F.replace(F.col("pathway"), F.lit("-"), F.lit("#")))


@query("""SELECT (row_number() OVER (ORDER BY s_suppkey))::BIGINT AS ord, s_suppkey AS col, s_name AS name, '' AS alias, 'first' || s_suppkey AS first, s_name || ' ' || s_nationkey AS keywords, (s_suppkey * 7)::BIGINT AS length FROM supplier""")
def names_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Individuals with their columns, names with keywords, chromosome lengths, and lists of first words."""
    s = load(spark, d, "supplier")
    path = f"{shared_folder(spark)}/people-{uuid.uuid4().hex}"
    writers.write_individuals(s.select(F.col("s_suppkey").alias("col"), F.col("s_name").alias("name")), path)
    people = readers.individuals(spark, path).select(F.col("ord").cast("long").alias("ord"), F.col("col").cast("long").alias("col"), "name", "alias")
    named = readers.individual_names(spark, written(s.select(text("first", F.col("s_suppkey"), "  \t", F.col("s_name"), "   ", F.col("s_nationkey")).alias("value")), "names"))
    sizes = readers.chromosome_lengths(spark, written(s.select(text("first", F.col("s_suppkey"), "\t", F.col("s_suppkey") * 7).alias("value")).union(spark.range(1).select(F.lit("#chrom length"))), "lengths"))
    words = path + "-words"
    writers.append_names(s.select(text("first", F.col("s_suppkey"), " and more").alias("name")).where("s_suppkey % 2 = 0"), words)
    writers.append_names(s.select(text("first", F.col("s_suppkey")).alias("name")).where("s_suppkey % 2 = 1"), words)
    first = readers.first_words(spark, words)
    joined = named.withColumnRenamed("name", "first").join(sizes.withColumnRenamed("chrom", "first"), "first").join(first.withColumnRenamed("name", "first"), "first", "left_semi")
    return people.join(joined, F.col("first") == text("first", F.col("col")))


@query("""WITH l AS (SELECT 'k' || (p_partkey % 50) AS key, p_name AS value, p_partkey AS place FROM part)
    SELECT key, arg_min(value, place) AS first, arg_max(value, place) AS last, count(DISTINCT value) > 1 AS conflicting FROM l GROUP BY key""")
def locations_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A lookup file whose keys repeat: the first and the last line of each, and whether they differ."""
    p = load(spark, d, "part").orderBy("p_partkey").coalesce(1)
    path = written(p.select(text("k", F.col("p_partkey") % 50, "\t", F.col("p_name")).alias("value")), "locations")
    first, last = readers.locations(spark, path), readers.locations(spark, path, last_wins=True).withColumnRenamed("value", "last")
    wrong = readers.conflicting_locations(spark, path).withColumn("wrong", F.lit(True))
    return first.withColumnRenamed("value", "first").join(last, "key").join(wrong, "key", "left").select("key", "first", "last", F.coalesce("wrong", F.lit(False)).alias("conflicting"))


@query("""SELECT 's' || (p_partkey % 10) AS chrom, p_partkey AS pos, 'E' || p_size || ',' || p_brand AS enzymes, 'L' || p_size || '[A/C]' || p_brand AS flank, p_name AS name, p_partkey + 5 AS cds_start, p_partkey + 20 AS second_start FROM part""")
def site_files_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Primers with their enzymes, flanking sequences and gene annotation, met by position."""
    p, k = load(spark, d, "part"), F.col("p_partkey")
    chrom = text("s", k % 10)
    primers = readers.checked_primers(spark, written(p.select(text(">", chrom, " ", k, "\n", "E", F.col("p_size"), " , ", F.col("p_brand"), ",\nACGT").alias("value")), "primers"))
    flanks = readers.flanks(spark, written(p.select(text(chrom, "\t", k, "\tL", F.col("p_size"), "[A/C]", F.col("p_brand")).alias("value")), "flanks"))
    gene = p.select(text(F.col("p_name"), "\t", chrom, "\t+\t", k, "\t", k + 90, "\t", k + 5, "\t", k + 80, "\t", k, ",", k + 20, ",\t", k + 10, ",", k + 90, ",").alias("value"))
    numbers = {c: i for i, c in enumerate(("name", "chrom", "strand", "tx_start", "tx_end", "cds_start", "cds_end", "starts", "ends"), 1)}
    genes = readers.gene_annotation(spark, written(gene, "genes"), numbers).select("chrom", F.col("tx_start").alias("pos"), "name", "cds_start", F.col("starts")[1].alias("second_start"))
    return primers.select("chrom", "pos", F.array_join("enzymes", ",").alias("enzymes")).join(flanks, ["chrom", "pos"]).join(genes, ["chrom", "pos"])


@query("""WITH g AS (SELECT s_suppkey AS gene, unnest(['a' || s_nationkey, CASE WHEN s_suppkey % 3 = 0 THEN 'U' ELSE 'b' END, CASE WHEN s_suppkey % 2 = 0 THEN 'N' ELSE '' END]) AS cat FROM supplier) SELECT DISTINCT gene, cat FROM g WHERE cat NOT IN ('', 'U', 'N')""")
def split_categories(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    codes = F.concat_ws(".", text("a", F.col("s_nationkey")), F.when(k % 3 == 0, "U").otherwise("b"), F.when(k % 2 == 0, "N").otherwise(""))
    return enrichment.split_categories(load(spark, d, "supplier").select(k.alias("gene"), codes.alias("codes")), "codes")


@query(f"""{WITH} SELECT site, ind, CASE g WHEN 2 THEN 2 WHEN 1 THEN 1 WHEN 0 THEN 0 ELSE -1 END::BIGINT AS from_digits, CASE g WHEN 2 THEN 2 WHEN 1 THEN 1 WHEN 0 THEN 0 ELSE 9 END::BIGINT AS from_alleles FROM calls""")
def genotype_codes(spark: SparkSession, d: str) -> DataFrame:
    """Genotypes written as digits and as pairs of alleles, and read from them."""
    g = F.col("g")
    return calls(spark, d).select("site", "ind", genotype_from_digits(digits(g)).cast("long").alias("from_digits"), ped_genotype(ped_alleles(g)).cast("long").alias("from_alleles"))


@query("""WITH t AS (SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS r, count(*) OVER () AS n FROM part),
    m AS (SELECT DISTINCT ceil(i * (n / 50.0::DOUBLE) + n / 50.0::DOUBLE / 2)::BIGINT - 1 AS r FROM (SELECT unnest(range(50)) AS i), (SELECT count(*) AS n FROM part)) SELECT p_partkey FROM t SEMI JOIN m USING (r)""")
def thinned_rows(spark: SparkSession, d: str) -> DataFrame:
    return ordered.thin(load(spark, d, "part").select("p_partkey", "p_retailprice"), ["p_retailprice", "p_partkey"], 50).select("p_partkey")
