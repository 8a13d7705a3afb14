"""Queries over sites, fixation indices and pairs of individuals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nucleotides import ped_alleles
from ..operators import fst as fst_ops
from ..operators import pairs, populations, sites
from .catalog import query
from .views import ADMIXED, CALLS, EVERYONE, POP1, POP2, calls, load

WITH = f"WITH {CALLS}"
SUMS = """sums AS (SELECT site, chrom, pos, sum(CASE WHEN ind IN (0,1) THEN a ELSE 0 END) AS a1, sum(CASE WHEN ind IN (0,1) THEN a + b ELSE 0 END) AS n1,
    sum(CASE WHEN ind IN (2,3) THEN a ELSE 0 END) AS a2, sum(CASE WHEN ind IN (2,3) THEN a + b ELSE 0 END) AS n2,
    max(CASE WHEN ind IN (0,1) THEN q END) AS q1, max(CASE WHEN ind IN (2,3) THEN q END) AS q2 FROM calls WHERE ind IN (0,1,2,3) GROUP BY 1, 2, 3),
    freq AS (SELECT *, a1 / n1 AS p1, a2 / n2 AS p2 FROM (SELECT site, chrom, pos, CAST(a1 AS DOUBLE) AS a1, CAST(n1 AS DOUBLE) AS n1, CAST(a2 AS DOUBLE) AS a2, CAST(n2 AS DOUBLE) AS n2, q1, q2 FROM sums) WHERE n1 > 0 AND n2 > 0)"""
UNFIXED = "p1 + p2 <> 0 AND p1 + p2 <> 2"
WRIGHT = "coalesce(power((p1 - p2) / 2, 2) / nullif((p1 + p2) / 2 * (1 - (p1 + p2) / 2), 0), 0)"
H1, H2 = "a1 * (n1 - a1) / (n1 * (n1 - 1))", "a2 * (n2 - a2) / (n2 * (n2 - 1))"
TOP = f"(power(p1 - p2, 2) - {H1} / n1 - {H2} / n2)"
BOTTOM = f"({TOP} + {H1} + {H2})"
MEAN = "((a1 + a2) / (n1 + n2))"
MSP = f"(n1 * power(p1 - {MEAN}, 2) + n2 * power(p2 - {MEAN}, 2))"
MSG = "((n1 * p1 * (1 - p1) + n2 * p2 * (1 - p2)) / (n1 + n2 - 2))"
NC = "((n1 + n2) - (n1 * n1 + n2 * n2) / (n1 + n2))"
WC = f"(({MSP} - {MSG}) / nullif({MSP} + ({NC} - 1) * {MSG}, 0))"


B_BASE = "substr('ACGT', CAST(site % 4 + 1 AS INT), 1)"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def base(n: int) -> Column:
    return F.substring(F.lit("ACGT"), ((F.col("site") + n) % 4 + 1).cast("int"), F.lit(1))


@query(f"{WITH}, {SUMS} SELECT site, chrom, pos, round({WRIGHT}, 6) AS fst FROM freq WHERE {UNFIXED}")
def fst_wright(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fst_ops.site_fst(calls(spark, d), POP1, POP2), "fst")


@query(f"{WITH}, {SUMS} SELECT site, chrom, pos, round({TOP} / nullif({BOTTOM}, 0), 6) AS fst FROM freq WHERE n1 > 1 AND n2 > 1 AND {UNFIXED}")
def fst_reich(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fst_ops.site_fst(calls(spark, d), POP1, POP2, "reich"), "fst")


@query(f"{WITH}, {SUMS} SELECT site, chrom, pos, round({WC}, 6) AS fst FROM freq WHERE n1 + n2 > 2 AND {UNFIXED}")
def fst_weir_cockerham(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fst_ops.site_fst(calls(spark, d), POP1, POP2, "weir_cockerham"), "fst")


@query(f"""{WITH}, {SUMS} SELECT CAST(count(*) AS BIGINT) AS sites, round(avg({TOP} / nullif({BOTTOM}, 0)), 6) AS mean_reich, round(sum({TOP}) / sum({BOTTOM}), 6) AS ratio_reich,
    round(avg({WRIGHT}), 6) AS mean_wright, round(avg({WC}), 6) AS mean_weir_cockerham FROM freq WHERE n1 > 1 AND n2 > 1 AND {UNFIXED}""")
def fst_overall(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fst_ops.overall_fst(calls(spark, d), POP1, POP2), "mean_reich", "ratio_reich", "mean_wright", "mean_weir_cockerham")


SHUFFLED = f"""{WITH}, perm AS (SELECT s AS shuffle, i AS ind, row_number() OVER (PARTITION BY s ORDER BY md5('1:' || s || ':' || i), i) - 1 AS place FROM (SELECT unnest(range(8)) AS s), (SELECT unnest(range(8)) AS i)),
    shuffled AS (SELECT shuffle, site, place, a, b FROM calls JOIN perm USING (ind)),
    sums AS (SELECT shuffle, site, CAST(sum(CASE WHEN place < 2 THEN a ELSE 0 END) AS DOUBLE) AS a1, CAST(sum(CASE WHEN place < 2 THEN a + b ELSE 0 END) AS DOUBLE) AS n1,
    CAST(sum(CASE WHEN place IN (2,3) THEN a ELSE 0 END) AS DOUBLE) AS a2, CAST(sum(CASE WHEN place IN (2,3) THEN a + b ELSE 0 END) AS DOUBLE) AS n2 FROM shuffled GROUP BY 1, 2),
    freq AS (SELECT *, a1 / n1 AS p1, a2 / n2 AS p2 FROM sums WHERE n1 > 0 AND n2 > 0),
    members AS (SELECT shuffle, string_agg(ind::VARCHAR, ',' ORDER BY ind) FILTER (place < 2) AS members1, string_agg(ind::VARCHAR, ',' ORDER BY ind) FILTER (place IN (2, 3)) AS members2 FROM perm GROUP BY 1),
    found AS (SELECT CAST(shuffle AS BIGINT) AS shuffle, round(avg({WRIGHT}), 6) AS mean_fst, CAST(count(*) AS BIGINT) AS sites FROM freq WHERE {UNFIXED} GROUP BY 1),
    named AS (SELECT f.*, members1, members2 FROM found f JOIN members m ON m.shuffle = f.shuffle)"""


@query(f"{SHUFFLED} SELECT * FROM named")
def fst_shuffle(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fst_ops.shuffled_fst(calls(spark, d), 8, 2, 2, 8), "mean_fst")


@query(f"""{SHUFFLED} SELECT mean_fst AS largest, (SELECT round(avg(mean_fst), 6) FROM named) AS mean, members1, members2, (SELECT CAST(count(*) AS BIGINT) FROM named) AS shuffles
    FROM named ORDER BY mean_fst DESC, shuffle LIMIT 1""")
def fst_shuffle_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fst_ops.shuffled_fst_summary(fst_shuffle(spark, d)), "mean")


@query(f"{WITH}, {SUMS} SELECT site, chrom, pos, CASE WHEN n1 >= 40 AND n2 >= 40 AND q1 >= 20 AND q2 >= 20 THEN round({WRIGHT}, 6) ELSE -1.0 END::DOUBLE AS fst FROM freq")
def retain_minus_one(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fst_ops.retained_fst(calls(spark, d), POP1, POP2, 40, 20), "fst")


TOTAL = "total AS (SELECT site, chrom, pos, CAST(sum(a + b) AS BIGINT) AS coverage FROM calls GROUP BY 1, 2, 3)"


@query(f"{WITH}, {TOTAL} SELECT * FROM total WHERE coverage BETWEEN 500 AND 900")
def filter_total_cov(spark: SparkSession, d: str) -> DataFrame:
    return sites.filter_total_coverage(calls(spark, d), EVERYONE, 500, 900)


@query(f"""{WITH}, {TOTAL}, bounds AS (SELECT quantile_disc(coverage, 0.1) AS lo, quantile_disc(coverage, 0.9) AS hi FROM total)
    SELECT site, chrom, pos, coverage FROM total, bounds WHERE coverage BETWEEN lo AND hi""")
def filter_pct_cov(spark: SparkSession, d: str) -> DataFrame:
    return sites.filter_coverage_share(calls(spark, d), EVERYONE, 0.1, 0.9)


@query(f"{WITH} SELECT site, chrom, pos, CAST(count(*) AS BIGINT) AS n FROM calls WHERE ind IN (0,1,2,3) AND a + b >= 20 AND q >= 20 GROUP BY 1, 2, 3 HAVING count(*) = 4")
def filter_individual(spark: SparkSession, d: str) -> DataFrame:
    return sites.filter_every_individual(calls(spark, d), (0, 1, 2, 3), 20, 20)


@query(f"{WITH} SELECT site, chrom, pos, CAST(count(*) AS BIGINT) AS defined FROM calls WHERE g <> -1 GROUP BY 1, 2, 3 HAVING count(*) >= 7")
def filter_defined(spark: SparkSession, d: str) -> DataFrame:
    return sites.filter_defined(calls(spark, d), EVERYONE, 7)


@query(f"""WITH RECURSIVE {CALLS}, s AS (SELECT DISTINCT site, chrom, pos FROM calls),
    kept AS (SELECT chrom, min(pos) AS pos FROM s GROUP BY 1 UNION ALL SELECT k.chrom, (SELECT min(pos) FROM s WHERE s.chrom = k.chrom AND s.pos >= k.pos + 2500) FROM kept k WHERE k.pos IS NOT NULL)
    SELECT s.site, s.chrom, s.pos FROM s JOIN kept USING (chrom, pos)""")
def filter_spacing(spark: SparkSession, d: str) -> DataFrame:
    return sites.filter_spacing(calls(spark, d).select("site", "chrom", "pos").distinct(), 2500)


@query(f"""{WITH} SELECT site, chrom, pos, CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b, max(q) AS q,
    CAST(CASE WHEN max(g) = -1 THEN -1 WHEN min(CASE WHEN g >= 0 THEN g END) = 2 THEN 2 WHEN max(g) = 0 THEN 0 ELSE 1 END AS BIGINT) AS g FROM calls WHERE ind IN (4,5) GROUP BY 1, 2, 3""")
def aggregate_population(spark: SparkSession, d: str) -> DataFrame:
    return sites.aggregate_population(calls(spark, d), ADMIXED)


CDF = """SELECT {key}, coverage, CAST(least(99, floor(100 * sum(n) OVER (PARTITION BY {key} ORDER BY coverage) / sum(n) OVER (PARTITION BY {key}))) AS BIGINT) AS percent
    FROM (SELECT {key}, coverage, count(*) AS n FROM {rows} GROUP BY 1, 2)"""
BY_IND = "(SELECT ind, a + b AS coverage FROM calls)"
BY_POP = "(SELECT CASE WHEN ind IN (0,1) THEN 'p1' ELSE 'p2' END AS pop, site, CAST(sum(a + b) AS BIGINT) AS coverage FROM calls WHERE ind < 4 GROUP BY 1, 2)"


@query(f"{WITH} {CDF.format(key='ind', rows=BY_IND)}")
def coverage_cdf(spark: SparkSession, d: str) -> DataFrame:
    return sites.coverage_distribution(calls(spark, d).select("ind", (F.col("a") + F.col("b")).alias("coverage")), "ind")


@query(f"{WITH} {CDF.format(key='pop', rows=BY_POP)}")
def coverage_cdf_population(spark: SparkSession, d: str) -> DataFrame:
    pop = F.when(F.col("ind").isin(*POP1), "p1").otherwise("p2").alias("pop")
    rows = calls(spark, d).where("ind < 4").groupBy(pop, "site").agg(F.sum(F.col("a") + F.col("b")).alias("coverage"))
    return sites.coverage_distribution(rows, "pop")


@query(f"{WITH}, cdf AS ({CDF.format(key='ind', rows=BY_IND)}) SELECT ind, coverage, percent - lag(percent, 1, 0) OVER (PARTITION BY ind ORDER BY coverage) AS step FROM cdf")
def coverage_diff(spark: SparkSession, d: str) -> DataFrame:
    return sites.percent_steps(coverage_cdf(spark, d), "ind")


def distance_sql(value: str, where: str, columns: str) -> str:
    return f"""{WITH}, good AS (SELECT site, ind, {value} AS f FROM calls WHERE {where})
    SELECT x.ind AS i, y.ind AS j, {columns} FROM good x JOIN good y ON x.site = y.site AND x.ind < y.ind GROUP BY 1, 2"""


READS = ("CAST(a AS DOUBLE) / (a + b)", "a + b >= 20 AND q >= 20")


@query(distance_sql(*READS, "round(avg(abs(x.f - y.f)), 6) AS distance"))
def pair_distance_reads(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pairs.pair_distance(calls(spark, d), "reads", 20, 20).drop("informative"), "distance")


@query(distance_sql("CAST(g AS DOUBLE)", "a + b >= 20 AND q >= 20 AND g >= 0", "round(avg(abs(x.f - y.f)), 6) AS distance, CAST(count(*) AS BIGINT) AS informative"))
def pair_distance_genotype(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pairs.pair_distance(calls(spark, d), "genotype", 20, 20), "distance")


@query(distance_sql(*READS, "CAST(count(*) AS BIGINT) AS informative"))
def informative_counts(spark: SparkSession, d: str) -> DataFrame:
    return pairs.pair_distance(calls(spark, d), "reads", 20, 20).drop("distance")


@query(f"""{WITH} SELECT ind, round(avg(CASE site % 7 WHEN 1 THEN 1 - CAST(a AS DOUBLE) / (a + b) WHEN 2 THEN CAST(a AS DOUBLE) / (a + b) ELSE 1 END), 6) AS distance, CAST(count(*) AS BIGINT) AS informative
    FROM calls WHERE a + b > 0 AND site % 7 IN (1, 2, 3) GROUP BY 1""")
def reference_distance(spark: SparkSession, d: str) -> DataFrame:
    seventh = F.col("site") % 7
    return rounded(pairs.reference_distance(calls(spark, d), F.when(seventh.isin(1, 2, 3), seventh).otherwise(0)), "distance")


@query(f"""{WITH}, p AS (SELECT site, ind, g / 2.0::DOUBLE AS p FROM calls WHERE g >= 0) SELECT m.ind AS mother, f.ind AS father,
    round(avg(m.p * (1 - f.p) + f.p * (1 - m.p)), 6) AS heterozygosity, CAST(count(*) AS BIGINT) AS sites FROM p m JOIN p f ON m.site = f.site WHERE m.ind IN (0,1) AND f.ind IN (2,3) GROUP BY 1, 2""")
def offspring_het(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pairs.offspring_heterozygosity(calls(spark, d), POP1, POP2), "heterozygosity")


@query(f"""{WITH}, c AS (SELECT site, ind, g FROM calls WHERE a + b >= 10 AND g IN (0, 2)),
    p AS (SELECT x.ind AS i, y.ind AS j, sum(CASE WHEN x.g <> y.g THEN 1 ELSE 0 END) AS differ, count(*) AS shared FROM c x JOIN c y ON x.site = y.site AND x.ind < y.ind GROUP BY 1, 2 HAVING count(*) >= 5)
    SELECT round(avg(CAST(differ AS DOUBLE) / shared), 6) AS pi, CAST(count(*) AS BIGINT) AS pairs FROM p""")
def mito_pi(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pairs.mitochondrial_pi(calls(spark, d), 10, 5), "pi")


KING = f"""{WITH}, c AS (SELECT site, ind, g FROM calls WHERE g >= 0),
    k AS (SELECT x.ind AS i, y.ind AS j, count(*) AS n_snp, sum(CASE WHEN x.g = 1 AND y.g = 1 THEN 1 ELSE 0 END) AS hethet, sum(CASE WHEN abs(x.g - y.g) = 2 THEN 1 ELSE 0 END) AS ibs0,
    sum(CASE WHEN x.g = 1 THEN 1 ELSE 0 END) AS het_i, sum(CASE WHEN y.g = 1 THEN 1 ELSE 0 END) AS het_j FROM c x JOIN c y ON x.site = y.site AND x.ind < y.ind GROUP BY 1, 2),
    king AS (SELECT i, j, CAST(n_snp AS BIGINT) AS n_snp, CAST(hethet AS BIGINT) AS hethet, CAST(ibs0 AS BIGINT) AS ibs0, CAST(hethet - 2 * ibs0 AS DOUBLE) / nullif(het_i + het_j, 0) AS kinship FROM k)"""


@query(f"{KING} SELECT i, j, n_snp, hethet, ibs0, round(kinship, 6) AS kinship FROM king")
def king_kinship(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pairs.king(calls(spark, d)).select("i", "j", "n_snp", "hethet", "ibs0", "kinship"), "kinship")


@query(f"""{KING} SELECT i, j, CASE WHEN kinship + 0.3 > 0.354 THEN 'duplicate or MZ twin' WHEN kinship + 0.3 >= 0.177 THEN '1st degree' WHEN kinship + 0.3 >= 0.0884 THEN '2nd degree'
    WHEN kinship + 0.3 >= 0.0442 THEN '3rd degree' ELSE '' END AS label FROM king""")
def relationship_label(spark: SparkSession, d: str) -> DataFrame:
    return pairs.king(calls(spark, d)).select("i", "j", pairs.relationship(F.col("kinship") + 0.3).alias("label"))


@query(f"""{WITH} SELECT site, chrom, pos, CAST(sum(CASE WHEN g >= 0 THEN 2 ELSE 0 END) AS BIGINT) AS na, CAST(sum(CASE WHEN g >= 0 THEN 2 - g ELSE 0 END) AS BIGINT) AS ac FROM calls WHERE ind IN (0,1) GROUP BY 1, 2, 3""")
def vcf_counts(spark: SparkSession, d: str) -> DataFrame:
    return sites.allele_counts(calls(spark, d), POP1)


@query(f"{WITH} SELECT site, ind, CASE g WHEN 2 THEN '1 1' WHEN 1 THEN '1 2' WHEN 0 THEN '2 2' ELSE '0 0' END AS alleles FROM calls")
def ped_encode(spark: SparkSession, d: str) -> DataFrame:
    return calls(spark, d).select("site", "ind", ped_alleles(F.col("g")).alias("alleles"))


@query(f"{WITH} SELECT site, string_agg(CASE WHEN g < 0 THEN '9' ELSE CAST(g AS VARCHAR) END, '' ORDER BY ind) AS genotypes FROM calls GROUP BY 1")
def geno_matrix(spark: SparkSession, d: str) -> DataFrame:
    cell = F.when(F.col("g") < 0, "9").otherwise(F.col("g").cast("string"))
    rows = calls(spark, d).groupBy("site").agg(F.array_sort(F.collect_list(F.struct("ind", cell.alias("c")))).alias("v"))
    return rows.select("site", F.array_join("v.c", "").alias("genotypes"))


COVARIANCE = f"""{WITH}, s AS (SELECT site, sum(g) AS s, count(*) AS n FROM calls WHERE g >= 0 GROUP BY 1 HAVING count(*) = 8 AND least(sum(g), 16 - sum(g)) >= 2),
    z AS (SELECT c.site, ind, (g - s / n::DOUBLE) / sqrt((1 + s) / (2 + 2 * n)::DOUBLE * (1 - (1 + s) / (2 + 2 * n)::DOUBLE)) AS z FROM calls c JOIN s ON c.site = s.site)
    SELECT x.ind AS i, y.ind AS j, round(sum(x.z * y.z), 6) AS product FROM z x JOIN z y ON x.site = y.site GROUP BY 1, 2"""


@query(COVARIANCE)
def pca_covariance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pairs.covariance(calls(spark, d), 8), "product")


@query(f"""{WITH}, w AS (SELECT CAST(count(*) AS BIGINT) AS s FROM (SELECT site FROM calls WHERE g >= 0 GROUP BY 1 HAVING min(g) <> max(g) OR min(g) = 1)),
    h AS (SELECT sum(2 * p * (1 - p) * n / (n - 1)) AS h FROM (SELECT site, sum(g) / (2.0::DOUBLE * count(*)) AS p, 2.0::DOUBLE * count(*) AS n FROM calls WHERE g >= 0 GROUP BY 1)),
    l AS (SELECT CAST(count(DISTINCT site) AS BIGINT) AS length FROM calls WHERE a + b > 0)
    SELECT s AS polymorphic, length, round(h / length, 6) AS pi, round(s / (SELECT sum(1.0::DOUBLE / k) FROM range(1, 16) t(k)) / length, 6) AS theta FROM w, h, l""")
def nucleotide_diversity(spark: SparkSession, d: str) -> DataFrame:
    rows = calls(spark, d).groupBy("site").agg(F.sum(F.when(F.col("g") >= 0, F.col("g"))).alias("s"), F.count_if(F.col("g") >= 0).alias("n"), F.max((F.col("a") + F.col("b") > 0).cast("int")).alias("covered"))
    p, n = F.col("s") / (2 * F.col("n")), 2 * F.col("n")
    mixed = (F.col("n") > 0) & (F.col("s") > 0) & (F.col("s") < 2 * F.col("n"))
    sums = rows.agg(F.count_if(mixed).alias("polymorphic"), F.sum("covered").alias("length"), F.sum(F.when(F.col("n") > 0, 2 * p * (1 - p) * n / (n - 1))).alias("h"))
    harmonic = sum(1 / k for k in range(1, 16))
    return sums.select("polymorphic", "length", F.round(F.col("h") / F.col("length"), 6).alias("pi"), F.round(F.col("polymorphic") / harmonic / F.col("length"), 6).alias("theta"))


@query(f"""{WITH}, c AS (SELECT l_suppkey % 40 AS col, max(l_comment_free) AS n FROM (SELECT l_suppkey, 'ind' || (l_suppkey % 40) || ' tag' AS l_comment_free FROM lineitem) GROUP BY 1)
    SELECT CAST(col AS BIGINT) AS col, n AS name FROM c WHERE col IN (3, 5) OR contains('pasted ind7 ind12, ind30;', split_part(n, ' ', 1))""")
def specify_individuals(spark: SparkSession, d: str) -> DataFrame:
    col = F.col("l_suppkey") % 40
    names = load(spark, d, "lineitem").select(col.alias("col"), F.concat(F.lit("ind"), col.cast("string"), F.lit(" tag")).alias("name")).distinct()
    return populations.specified(names, (3, 5), "pasted ind7 ind12, ind30;")


@query("""WITH p AS (SELECT DISTINCT l_suppkey % 8 AS ind FROM lineitem WHERE l_returnflag = 'R'), t AS (SELECT DISTINCT l_suppkey % 8 AS ind FROM lineitem)
    SELECT (SELECT CAST(count(*) AS BIGINT) FROM p WHERE ind NOT IN (SELECT ind FROM t)) AS outside, (SELECT CAST(count(*) AS BIGINT) FROM p WHERE ind IN (2, 3)) AS shared""")
def population_check(spark: SparkSession, d: str) -> DataFrame:
    items = load(spark, d, "lineitem")
    p, t = (x.select((F.col("l_suppkey") % 8).alias("ind")) for x in (items.where("l_returnflag = 'R'"), items))
    return populations.population_faults(p, t, t.where("ind IN (2, 3)"))
