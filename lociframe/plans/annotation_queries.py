"""Queries over annotation, populations and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nucleotides import genotype_base
from ..functions.text_rules import bound_value, chromosome_key, codes_of, is_identifier, underscored
from ..operators import annotation, enrichment, graphs, populations, sequences
from ..operators.prefix import numbered
from .catalog import query
from .ordered_queries import HYPER, COUNTS, SHOWN, enrich_hypergeom
from .site_queries import B_BASE, COVARIANCE, WITH, base, rounded
from .views import CALLS, SPANS, calls, load, spans

SEEN = f"{WITH}, seen AS (SELECT * FROM calls WHERE site % 3 <> 0)"


@query(f"{SEEN} SELECT c.site, c.chrom, c.pos, c.ind, CASE WHEN s.site IS NULL THEN {B_BASE.replace('site', 'c.site')} ELSE {SHOWN.replace('site', 'c.site').replace('CASE g', 'CASE s.g')} END AS base FROM calls c LEFT JOIN seen s ON s.site = c.site AND s.ind = c.ind WHERE c.a + c.b > 0")
def covered_bases(spark: SparkSession, d: str) -> DataFrame:
    """A third of the sites are not in the genotype table: everyone there has the reference base."""
    found = calls(spark, d)
    shown = genotype_base(F.col("g"), base(0), base(1))
    return annotation.covered_bases(found.where("a + b > 0").select("site", "chrom", "pos", "ind"), found.where("site % 3 <> 0"), base(0), shown)


@query(f"WITH {SPANS} SELECT name, chrom, start, \"end\" FROM spans WHERE chrom IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 2 = 0)")
def genes_with_sequence(spark: SparkSession, d: str) -> DataFrame:
    names = load(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("name"), F.lit("ACGT").alias("sequence"))
    return annotation.genes_with_sequence(spans(spark, d), names).select("name", "chrom", "start", "end")


@query(f"""{WITH}, {SPANS}, v AS (SELECT site, chrom, pos, sum(g) AS s, 2 * count(*) AS n FROM calls WHERE g >= 0 GROUP BY 1, 2, 3), m AS (SELECT max(n) AS n FROM v),
    x AS (SELECT v.*, p_size % 5 <> p_partkey % 4 AS changed FROM v JOIN part ON p_partkey = site WHERE s > 0 AND s < n AND EXISTS (SELECT 1 FROM spans p WHERE p.chrom = v.chrom AND pos BETWEEN start AND "end")),
    h AS (SELECT changed, 2 * (s / n::DOUBLE) * (1 - s / n::DOUBLE) * n / (n - 1) AS h FROM x), a AS (SELECT list_sum(list_transform(range(1, n), lambda k: 1.0::DOUBLE / k)) AS a FROM m),
    l AS (SELECT CAST(count(DISTINCT (chrom, pos)) AS BIGINT) AS length FROM (SELECT chrom, unnest(range(start, "end" + 1)) AS pos FROM spans))
    SELECT CAST(count(*) FILTER (changed) AS BIGINT) AS snps_non, 700.0::DOUBLE AS sites_non, round(coalesce(sum(h) FILTER (changed), 0) / 700, 6) AS pi_non, CAST(count(*) FILTER (NOT changed) AS BIGINT) AS snps_syn, 300.0::DOUBLE AS sites_syn,
    round(coalesce(sum(h) FILTER (NOT changed), 0) / 300, 6) AS pi_syn, any_value(length) AS length, round(count(*) FILTER (changed) / any_value(a) / 700, 6) AS theta_non, round(count(*) FILTER (NOT changed) / any_value(a) / 300, 6) AS theta_syn FROM h, a, l""")
def coding_diversity(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    changes = load(spark, d, "part").select((k % 10).alias("chrom"), (k * 100).alias("pos"), (F.col("p_size") % 5).cast("string").alias("ref_aa"), (k % 4).cast("string").alias("alt_aa"))
    found = annotation.coding_diversity(calls(spark, d), changes, spans(spark, d), 700, 300)
    return rounded(found, "pi_non", "pi_syn", "theta_non", "theta_syn")


@query(f"WITH {CALLS}, t AS (SELECT count(*) AS n, count(*) FILTER (ok = 8) AS used FROM (SELECT site, count(*) FILTER (a + b >= 10 AND q >= 10) AS ok FROM calls GROUP BY 1)) SELECT CAST(used AS BIGINT) AS used, CAST(n AS BIGINT) AS sites FROM t")
def usable_sites(spark: SparkSession, d: str) -> DataFrame:
    return populations.usable_sites(calls(spark, d), list(range(8)), 10, 10)


@query("""WITH m AS (SELECT 0 AS ord, 'even' AS population, s_suppkey AS ind FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT 1, 'third', s_suppkey FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT 2, 'rest', s_suppkey FROM supplier WHERE s_suppkey % 4 = 1)
    SELECT ind, first(population ORDER BY ord) AS population FROM m GROUP BY 1""")
def union_of_populations(spark: SparkSession, d: str) -> DataFrame:
    people, k = load(spark, d, "supplier"), F.col("s_suppkey")
    parts = [people.where(where).select(F.lit(i).alias("ord"), F.lit(name).alias("population"), k.alias("ind")) for i, (name, where) in enumerate((("even", k % 2 == 0), ("third", k % 3 == 0), ("rest", k % 4 == 1)))]
    return populations.union_of_populations(parts[0].union(parts[1]).union(parts[2]))


def fours(spark: SparkSession) -> DataFrame:
    return spark.range(8).select(F.col("id").alias("ind"), F.floor(F.col("id") / 4).cast("long").alias("population"))


@query(f"""{COVARIANCE.replace('round(sum(x.z * y.z), 6) AS product', 'sum(x.z * y.z) AS product').replace('SELECT x.ind AS i', ', k AS (SELECT x.ind AS i')}),
    d AS (SELECT i // 4 AS p, j // 4 AS q, avg((SELECT product FROM k x WHERE x.i = k.i AND x.j = k.i) + (SELECT product FROM k y WHERE y.i = k.j AND y.j = k.j) - 2 * product) AS d FROM k GROUP BY 1, 2)
    SELECT p, q, round(d / (SELECT avg(d) FROM d WHERE p = q), 6) AS divergence FROM d""")
def average_divergence(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.pairs import covariance

    return rounded(populations.average_divergence(covariance(calls(spark, d), 8), fours(spark)), "divergence")


COORDINATES = f"{WITH}, v AS (SELECT ind, ind // 4 AS population, chrom AS component, sum(g)::DOUBLE AS value FROM calls WHERE g >= 0 GROUP BY 1, 2, 3)"
#: Six degrees of freedom have a closed form; theta is the arc tangent of t over the root of six.
ANOVA = f"""{COORDINATES}, t AS (SELECT component, population, count(*) AS n, sum(value) AS s, sum(value * value) AS ss FROM v GROUP BY 1, 2),
    f AS (SELECT x.component, x.population AS p, y.population AS q, x.n + y.n - 2 AS within_df, (x.s * x.s / x.n + y.s * y.s / y.n - (x.s + y.s) * (x.s + y.s) / (x.n + y.n)) / nullif((x.ss + y.ss - x.s * x.s / x.n - y.s * y.s / y.n) / (x.n + y.n - 2), 0) AS f
    FROM t x JOIN t y ON x.component = y.component AND x.population < y.population),
    w AS (SELECT *, atan(sqrt(f / 6)) AS th FROM f)"""


@query(f"{ANOVA} SELECT component, p, q, CAST(within_df AS BIGINT) AS within_df, round(f, 6) AS f, round(1 - sin(th) * (1 + power(cos(th), 2) / 2 + 3 * power(cos(th), 4) / 8), 6) AS p_value FROM w")
def component_anova(spark: SparkSession, d: str) -> DataFrame:
    values = calls(spark, d).where("g >= 0").groupBy("ind", F.col("chrom").alias("component")).agg(F.sum("g").cast("double").alias("value"))
    return rounded(populations.component_anova(values, fours(spark)), "f", "p_value")


@query(f"{ANOVA} SELECT p, q, round(sum(f), 4) AS chi2, CAST(count(f) AS BIGINT) AS df, round(exp(-sum(f) / 2) * (1 + sum(f) / 2 + power(sum(f) / 2, 2) / 2 + power(sum(f) / 2, 3) / 6 + power(sum(f) / 2, 4) / 24), 5) AS p_value FROM f GROUP BY 1, 2")
def population_chi2(spark: SparkSession, d: str) -> DataFrame:
    values = calls(spark, d).where("g >= 0").groupBy("ind", F.col("chrom").alias("component")).agg(F.sum("g").cast("double").alias("value"))
    found = populations.population_chi2(populations.component_anova(values, fours(spark)))
    return found.withColumns({"chi2": F.round("chi2", 4), "p_value": F.round("p_value", 5)})


NODES = """n AS (SELECT DISTINCT CASE WHEN p_size % 10 = 0 THEN 'cfa04070' ELSE 'cfa000' || p_size % 10 END AS pathway, p_size % 13 AS node, 'g' || p_partkey % 50 AS gene FROM part WHERE p_partkey % 5 < 2),
    listed AS (SELECT DISTINCT unnest(['g' || s_suppkey % 50, 'g' || s_suppkey % 37]) AS gene FROM supplier)"""


@query(f"WITH {NODES} SELECT pathway, CAST(node AS BIGINT) AS node FROM n WHERE pathway <> 'cfa04070' GROUP BY 1, 2 HAVING bool_and(gene IN (SELECT gene FROM listed))")
def removed_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Listed genes have names like g3.g7, which are two genes."""
    size, k, s = F.col("p_size"), F.col("p_partkey"), F.col("s_suppkey")
    name = F.when(size % 10 == 0, "cfa04070").otherwise(F.concat(F.lit("cfa000"), (size % 10).cast("string")))
    nodes = load(spark, d, "part").where("p_partkey % 5 < 2").select(name.alias("pathway"), (size % 13).cast("long").alias("node"), F.concat(F.lit("g"), (k % 50).cast("string")).alias("gene")).distinct()
    listed = load(spark, d, "supplier").select(F.concat(F.lit("g"), (s % 50).cast("string"), F.lit(".g"), (s % 37).cast("string")).alias("gene"))
    return graphs.removed_nodes(graphs.without_overview(nodes), listed)


@query("""WITH r AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 > 0 THEN s_suppkey % 17 END AS b, CASE WHEN s_suppkey % 7 > 0 THEN s_suppkey % 11 END AS a FROM supplier),
    o AS (SELECT 'p' || k AS pathway, coalesce(b::VARCHAR, 'C') AS before, coalesce(a::VARCHAR, 'C') AS after, CASE WHEN b IS NULL AND a IS NOT NULL THEN 'C-' || a WHEN b IS NULL THEN '0' ELSE (b - a)::VARCHAR END AS change,
    CASE WHEN b IS NULL AND a IS NOT NULL THEN 2 WHEN b IS NULL THEN 1 ELSE 0 END AS class, CASE WHEN b IS NOT NULL AND a IS NOT NULL THEN b - a ELSE a END AS v FROM r)
    SELECT pathway, before, after, change, CAST(rank() OVER (ORDER BY class DESC, v DESC NULLS LAST) AS BIGINT) AS rank FROM o""")
def change_ranks(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = load(spark, d, "supplier").select(F.concat(F.lit("p"), k.cast("string")).alias("pathway"), F.when(k % 5 > 0, k % 17).alias("b"), F.when(k % 7 > 0, k % 11).alias("a"))
    return graphs.change_ranks(rows, "b", "a", "C")


@query(f"WITH {COUNTS}, r AS ({HYPER}) SELECT k AS count, representation, CAST(rank() OVER (ORDER BY representation DESC) AS BIGINT) AS rank, p_low, p_high, cat FROM r")
def enrichment_report(spark: SparkSession, d: str) -> DataFrame:
    return enrichment.enrichment_report(enrich_hypergeom(spark, d)).withColumn("rank", F.col("rank").cast("long"))


CELLS = f"""{WITH}, cells AS (SELECT site, ind, {SHOWN} AS base FROM calls), n AS (SELECT site, base, count(*) AS n, base IN ('A','C','G','T') AS plain FROM cells WHERE base <> 'N' GROUP BY 1, 2),
    v AS (SELECT site, list(base ORDER BY plain DESC, n DESC, base) AS v FROM n GROUP BY 1)"""


@query(f"""{CELLS} SELECT c.site, ind, coalesce(v[1], 'N') AS ancestral, coalesce(v[2], 'N') AS derived, CAST(CASE WHEN base = 'N' THEN -1 WHEN base = v[1] THEN 2 WHEN base = v[2] THEN 0 ELSE 1 END AS BIGINT) AS g
    FROM cells c LEFT JOIN v ON v.site = c.site""")
def allele_codes(spark: SparkSession, d: str) -> DataFrame:
    return sequences.allele_codes(calls(spark, d).select("site", "ind", genotype_base(F.col("g"), base(0), base(1)).alias("base")))


@query("""WITH c AS (SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 'chr' WHEN 1 THEN 'r' ELSE '' END || p_size AS chrom, p_retailprice::BIGINT AS pos FROM part)
    SELECT k, chrom, CAST(row_number() OVER (ORDER BY ltrim(chrom, 'chr'), pos, k) AS BIGINT) AS place FROM c""")
def site_order(spark: SparkSession, d: str) -> DataFrame:
    """Places of all sites in the order of chromosome names without c, h and r before them, and positions; nulls come last."""
    k = F.col("p_partkey")
    chrom = F.concat(F.when(k % 3 == 0, "chr").when(k % 3 == 1, "r").otherwise(""), F.col("p_size").cast("string"))
    rows = load(spark, d, "part").select(k.alias("k"), chrom.alias("chrom"), F.rint("p_retailprice").cast("long").alias("pos")).withColumn("key", chromosome_key(F.col("chrom")))
    return numbered(rows, "at", F.asc_nulls_last("key"), F.asc_nulls_last("pos"), F.asc_nulls_last("k")).select("k", "chrom", (F.col("at") + 1).alias("place"))


@query("""WITH t AS (SELECT p_partkey AS k, p_name AS name, CASE p_partkey % 4 WHEN 0 THEN p_size || '%' WHEN 1 THEN p_size * 3 || '%' WHEN 2 THEN p_size::VARCHAR ELSE p_name END AS bound, 'p' || p_size || '=' || p_brand || '.q' || p_partkey AS codes FROM part)
    SELECT k, CAST(CASE WHEN regexp_full_match(bound, '[0-9]+%') AND CAST(rtrim(bound, '%') AS INT) <= 100 THEN -CAST(rtrim(bound, '%') AS INT) WHEN regexp_full_match(bound, '[0-9]+') THEN CAST(bound AS INT) ELSE -1000 END AS BIGINT) AS bound,
    regexp_full_match(name, '[0-9A-Z_a-z]+') AS identifier, replace(trim(name), ' ', '_') AS name, split_part(split_part(codes, '.', 1), '=', 1) || ',q' || k AS codes FROM t""")
def text_rules(spark: SparkSession, d: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = F.when(k % 4 == 0, F.concat(size, F.lit("%"))).when(k % 4 == 1, F.concat((F.col("p_size") * 3).cast("string"), F.lit("%"))).when(k % 4 == 2, size).otherwise(F.col("p_name"))
    codes = F.concat(F.lit("p"), size, F.lit("="), F.col("p_brand"), F.lit(".q"), k.cast("string"))
    return load(spark, d, "part").select(k.alias("k"), F.coalesce(bound_value(text), F.lit(-1000)).cast("long").alias("bound"), is_identifier(F.col("p_name")).alias("identifier"), underscored(F.col("p_name")).alias("name"), F.array_join(codes_of(codes), ",").alias("codes"))
