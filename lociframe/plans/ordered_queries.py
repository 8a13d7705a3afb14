"""Queries along chromosomes, over gene categories and over sequences."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nucleotides import genotype_base, genotype_from_vcf, reverse_complement
from ..operators import enrichment as enrich
from ..operators import admixture, ordered, pairs, sequences
from .catalog import query
from .site_queries import COVARIANCE, WITH, base, rounded
from .views import ADMIXED, CALLS, LISTED, MEMBERSHIP, POP1, POP2, RUNS, SPANS, calls, listed_genes, load, membership, runs, spans

SITES = f"{CALLS}, s AS (SELECT DISTINCT site, chrom, pos FROM calls)"


@query(f"""WITH {SITES}, len AS (SELECT CAST(sum(m) AS BIGINT) // 300 AS space FROM (SELECT max(pos) AS m FROM s GROUP BY chrom)),
    t AS (SELECT s.*, row_number() OVER w AS t, pos // space AS f FROM s, len WINDOW w AS (PARTITION BY chrom ORDER BY pos, site)),
    k AS (SELECT *, t + least(0, min(f + 1 - t) OVER (PARTITION BY chrom ORDER BY pos, site)) AS k FROM t)
    SELECT site, chrom, pos FROM k QUALIFY k > coalesce(lag(k) OVER (PARTITION BY chrom ORDER BY pos, site), 0)""")
def sample_uniform(spark: SparkSession, d: str) -> DataFrame:
    sites = calls(spark, d).select("site", "chrom", "pos").distinct()
    length = sites.groupBy("chrom").agg(F.max("pos").alias("m")).agg(F.sum("m")).first()[0]
    return ordered.uniform_sample(sites, length or 1, 300)


@query("""WITH o(n, i) AS (VALUES (5, 1), (6, 2), (7, 3), (8, 4), (3, 5), (2, 6), (1, 7))
    SELECT s_suppkey, s_name, CAST(row_number() OVER (ORDER BY coalesce(i, s_suppkey + 1000000)) AS BIGINT) AS place FROM supplier LEFT JOIN o ON n = s_suppkey""")
def reorder_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "supplier").select("s_suppkey", "s_name")
    out = ordered.reorder(rows, "s_suppkey", "5,6-8,3-1,7")
    return ordered.ranked(out, -F.col("place")).select("s_suppkey", "s_name", F.col("rank").cast("long").alias("place"))


SHIFT = f"{RUNS}, shift AS (SELECT quantile_disc(score, 0.9) AS shift FROM runs)"


@query(f"WITH {SHIFT} SELECT CAST(shift AS BIGINT) AS shift FROM shift")
def percentile_shift(spark: SparkSession, d: str) -> DataFrame:
    return ordered.score_shift(runs(spark, d), 0.9)


def shift_of(spark: SparkSession, d: str) -> int:
    return percentile_shift(spark, d).first()["shift"]  # one row


@query(f"""WITH {SHIFT}, u AS (SELECT chrom, pos, score - shift AS x, sum(score - shift) OVER (PARTITION BY chrom ORDER BY pos) AS upto FROM runs, shift),
    l AS (SELECT *, min(struct_pack(low := upto - x, start := pos)) OVER (PARTITION BY chrom ORDER BY pos) AS least FROM u),
    t AS (SELECT chrom, least.start AS start, pos + 1 AS "end", CAST(upto - least.low AS BIGINT) AS score FROM l)
    SELECT * FROM t WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY chrom ORDER BY score DESC, "end", start) = 1""")
def best_run(spark: SparkSession, d: str) -> DataFrame:
    return ordered.best_run(runs(spark, d), shift_of(spark, d))


#: A run is maximal if all its beginnings and all its ends have positive sums, and no longer run around it is like that.
MAXIMAL = f"""{SHIFT}, u AS (SELECT chrom, pos, row_number() OVER w AS n, sum(score - shift) OVER w AS upto, sum(score - shift) OVER w - (score - shift) AS before FROM runs, shift WINDOW w AS (PARTITION BY chrom ORDER BY pos)),
    ahead AS (SELECT a.chrom, a.n, a.pos, a.before, coalesce(min(k.n), 1000000000) AS falls FROM u a LEFT JOIN u k ON k.chrom = a.chrom AND k.n >= a.n AND k.upto <= a.before GROUP BY 1, 2, 3, 4),
    behind AS (SELECT z.chrom, z.n, z.pos, z.upto, coalesce(max(k.n), 0) AS high FROM u z LEFT JOIN u k ON k.chrom = z.chrom AND k.n <= z.n AND k.before >= z.upto GROUP BY 1, 2, 3, 4),
    good AS (SELECT a.chrom, a.n AS i, max_by(z.n, z.n) AS j, a.pos AS start, max_by(z.pos, z.n) + 1 AS "end", CAST(max_by(z.upto, z.n) - a.before AS BIGINT) AS score FROM ahead a JOIN behind z ON z.chrom = a.chrom AND z.n >= a.n AND z.n < a.falls AND a.n > z.high GROUP BY a.chrom, a.n, a.pos, a.before),
    maximal AS (SELECT chrom, start, "end", score FROM good g WHERE NOT EXISTS (SELECT 1 FROM good h WHERE h.chrom = g.chrom AND h.i <= g.i AND h.j >= g.j AND (h.i < g.i OR h.j > g.j)))"""


@query(f"WITH {MAXIMAL} SELECT * FROM maximal")
def max_runs(spark: SparkSession, d: str) -> DataFrame:
    return ordered.max_runs(runs(spark, d), shift_of(spark, d))


SHUFFLED = """m AS (SELECT k AS shuffle, chrom, pos, md5('1:' || k || ':' || chrom || ':' || pos) AS mark, score - shift AS x FROM runs, shift, (SELECT unnest(range(1, 11)) AS k)),
    c AS (SELECT *, sum(x) OVER (PARTITION BY shuffle, chrom ORDER BY mark, pos) AS upto FROM m),
    t AS (SELECT shuffle, upto - min(upto - x) OVER (PARTITION BY shuffle, chrom ORDER BY mark, pos) AS total FROM c)"""


@query(f"""WITH {SHIFT}, {SHUFFLED}
    SELECT CAST(shuffle AS BIGINT) AS shuffle, CAST(greatest(0, max(total)) AS BIGINT) AS largest FROM t GROUP BY 1""")
def max_runs_shuffle(spark: SparkSession, d: str) -> DataFrame:
    found = ordered.shuffled_threshold(runs(spark, d), shift_of(spark, d), 10)
    return found.select(F.col("shuffle").cast("long").alias("shuffle"), F.col("largest").cast("long").alias("largest"))


@query(f"WITH {MAXIMAL}, {SHUFFLED} SELECT maximal.* FROM maximal WHERE score > (SELECT greatest(0, max(total)) FROM t)")
def significant_runs(spark: SparkSession, d: str) -> DataFrame:
    """Maximal runs above the largest run of ten shuffles."""
    return ordered.significant_runs(runs(spark, d), shift_of(spark, d), 10)


FREQ = """f AS (SELECT site, (sum(CASE WHEN ind IN (0,1) AND g >= 0 THEN g ELSE 0 END) + 1) / (sum(CASE WHEN ind IN (0,1) AND g >= 0 THEN 2 ELSE 0 END) + 2)::DOUBLE AS f1,
    (sum(CASE WHEN ind IN (2,3) AND g >= 0 THEN g ELSE 0 END) + 1) / (sum(CASE WHEN ind IN (2,3) AND g >= 0 THEN 2 ELSE 0 END) + 2)::DOUBLE AS f2,
    (sum(CASE WHEN ind IN (6,7) AND g >= 0 THEN g ELSE 0 END) + 1) / (sum(CASE WHEN ind IN (6,7) AND g >= 0 THEN 2 ELSE 0 END) + 2)::DOUBLE AS f3, 0.75::DOUBLE AS f4 FROM calls GROUP BY 1)"""


def state_sql(pairs: list[tuple[int, int]], logs: bool = True) -> str:
    both = lambda s, t: f"CASE g WHEN 2 THEN {s} * {t} WHEN 0 THEN (1 - {s}) * (1 - {t}) ELSE {s} * (1 - {t}) + {t} * (1 - {s}) END"
    cells = ", ".join(f"round({'ln' if logs else ''}({both(f'f{i}', f'f{j}')}), 6) AS s{n}" for n, (i, j) in enumerate(pairs, 1))
    return f"SELECT chrom, pos, ind, {cells} FROM calls JOIN f USING (site) WHERE ind IN (4,5) AND g >= 0"


TWO, THREE = [(1, 1), (2, 2), (1, 2)], [(1, 1), (2, 2), (3, 3), (1, 2), (1, 3), (2, 3)]
ADMIX = f"{WITH}, {FREQ}"


def path_sql(k: int, penalty: float, dark: str) -> str:
    """The best path as two recursions: forward to the best sums, and back along the choices."""
    each = range(1, k + 1)
    best, kept = ", ".join(f"b{i}" for i in each), ", ".join(f"k{i}" for i in each)
    top = f"greatest({best})"
    first = "CASE " + " ".join(f"WHEN b{i} = {top} THEN {i}" for i in each) + " END"
    return f"""o AS (SELECT *, row_number() OVER (PARTITION BY chrom, ind ORDER BY pos) AS i FROM states WHERE NOT {dark}),
    fwd AS (SELECT chrom, ind, i, pos, {", ".join(f"s{i} AS b{i}" for i in each)}, {", ".join(f"{i} AS k{i}" for i in each)} FROM o WHERE i = 1 UNION ALL
        SELECT o.chrom, o.ind, o.i, o.pos, {", ".join(f"greatest(b{i}, {top} - {penalty}) + s{i}" for i in each)}, {", ".join(f"CASE WHEN b{i} >= {top} - {penalty} THEN {i} ELSE {first} END" for i in each)}
        FROM fwd JOIN o ON o.chrom = fwd.chrom AND o.ind = fwd.ind AND o.i = fwd.i + 1),
    bwd AS (SELECT chrom, ind, i, pos, {first} AS state FROM fwd WHERE i = (SELECT max(z.i) FROM o z WHERE z.chrom = fwd.chrom AND z.ind = fwd.ind) UNION ALL
        SELECT p.chrom, p.ind, p.i, p.pos, CASE bwd.state {" ".join(f"WHEN {i} THEN n.k{i}" for i in each)} END FROM bwd JOIN fwd n ON n.chrom = bwd.chrom AND n.ind = bwd.ind AND n.i = bwd.i JOIN fwd p ON p.chrom = bwd.chrom AND p.ind = bwd.ind AND p.i = bwd.i - 1),
    told AS (SELECT chrom, ind, pos, state FROM bwd UNION ALL SELECT chrom, ind, pos, 0 FROM states WHERE {dark}),
    turned AS (SELECT *, CASE WHEN state = lag(state) OVER (PARTITION BY chrom, ind ORDER BY pos) THEN 0 ELSE 1 END AS turn FROM told),
    stretch AS (SELECT *, sum(turn) OVER (PARTITION BY chrom, ind ORDER BY pos) AS n FROM turned),
    path AS (SELECT chrom, ind, min(pos) AS start, max(pos) + 1 AS "end", CAST(any_value(state) AS BIGINT) AS state FROM stretch GROUP BY chrom, ind, n)"""


RECURSIVE = ADMIX.replace("WITH", "WITH RECURSIVE", 1)
PATH = f"{RECURSIVE}, states AS ({state_sql(TWO)}), {path_sql(3, 2.0, 'false')}"
DARK = "(pos // 1000) % 50 = 7"


@query(f"{PATH} SELECT * FROM path")
def admix_path(spark: SparkSession, d: str) -> DataFrame:
    return admixture.admixture_path(admix_states(spark, d), 2.0)


@query(f"{PATH} SELECT ind, state, round(100 * sum(\"end\" - start) / sum(sum(\"end\" - start)) OVER (PARTITION BY ind)::DOUBLE, 6) AS percent FROM path GROUP BY 1, 2")
def admix_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(admixture.state_shares(admix_path(spark, d)), "percent")


@query(f"""{PATH}, l AS (SELECT p_partkey % 10 AS chrom, max(p_partkey) * 100 + 5000 AS length FROM part GROUP BY 1)
    SELECT chrom, ind, start, CASE WHEN start = max(start) OVER (PARTITION BY chrom, ind) THEN greatest("end", length) ELSE "end" END AS "end", state FROM path LEFT JOIN l USING (chrom)""")
def admix_path_extended(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    lengths = load(spark, d, "part").groupBy((k % 10).alias("chrom")).agg((F.max(k) * 100 + 5000).alias("length"))
    return admixture.extended(admix_path(spark, d), lengths)


@query(f"""{PATH}, l AS (SELECT p_partkey % 10 AS chrom, max(p_partkey) * 100 + 5000 AS length FROM part GROUP BY 1), w AS (SELECT greatest((SELECT max(length) FROM l), (SELECT max("end") FROM path))::DOUBLE AS longest)
    SELECT ind, chrom, round(start / longest, 6) AS "left", round("end" / longest, 6) AS "right", state FROM path, w""")
def karyotype_rows(spark: SparkSession, d: str) -> DataFrame:
    """What a karyotype is drawn from."""
    k = F.col("p_partkey")
    lengths = load(spark, d, "part").groupBy((k % 10).alias("chrom")).agg((F.max(k) * 100 + 5000).alias("length"))
    return rounded(admixture.karyotype_rows(admix_path(spark, d), lengths), "left", "right")


@query(f"{ADMIX} {state_sql(TWO)}")
def admix_states(spark: SparkSession, d: str) -> DataFrame:
    return rounded(admixture.admixture_states(calls(spark, d), ADMIXED, POP1, POP2), "s1", "s2", "s3")


@query(f"{ADMIX} {state_sql(THREE)}")
def admix_states_three(spark: SparkSession, d: str) -> DataFrame:
    return rounded(admixture.admixture_states(calls(spark, d), ADMIXED, POP1, POP2, (6, 7)), *[f"s{i}" for i in range(1, 7)])


@query(f"{ADMIX} {state_sql([(1, 1), (4, 4), (1, 4)], logs=False)}")
def admix_states_reference(spark: SparkSession, d: str) -> DataFrame:
    """The reference as the second source, and plain probabilities."""
    return rounded(admixture.admixture_states(calls(spark, d), ADMIXED, POP1, None, add_logs=False), "s1", "s2", "s3")


@query(f"{RECURSIVE}, states AS ({state_sql(THREE)}), {path_sql(6, 1.5, DARK)} SELECT * FROM path")
def admix_path_heterochromatin(spark: SparkSession, d: str) -> DataFrame:
    """Three sources; every 50th stretch of 1,000 positions is heterochromatin."""
    dark = calls(spark, d).select("chrom", F.floor(F.col("pos") / 1000).alias("k")).distinct().where("k % 50 = 7").select("chrom", (F.col("k") * 1000).alias("start"), (F.col("k") * 1000 + 999).alias("end"))
    return admixture.admixture_path(admix_states_three(spark, d), 1.5, dark)


COUNTS = f"""{MEMBERSHIP}, {LISTED}, size AS (SELECT count(DISTINCT m.gene) AS big_n, count(DISTINCT l.gene) AS n FROM membership m LEFT JOIN listed l ON m.gene = l.gene),
    c AS (SELECT cat, count(l.gene) AS k, count(*) AS big_k FROM membership m LEFT JOIN listed l ON m.gene = l.gene GROUP BY 1),
    cs AS (SELECT * FROM c, size)"""


def hyper_sql(total: str, good: str, drawn: str, first: str, last: str) -> str:
    choose = lambda n, k: f"(lgamma({n} + 1) - CASE WHEN {k} = 0 THEN 0 ELSE lgamma({k} + 1) END - CASE WHEN {n} - ({k}) = 0 THEN 0 ELSE lgamma({n} - ({k}) + 1) END)"
    term = f"exp({choose(good, 'x')} + {choose(f'({total} - {good})', f'({drawn} - x)')} - {choose(total, drawn)})"
    low, high = f"greatest(0, {drawn} - ({total} - {good}))", f"least({good}, {drawn})"
    return f"round(least(1, coalesce(list_sum(list_transform(range(greatest({low}, {first})::BIGINT, (least({high}, {last}) + 1)::BIGINT), lambda x: {term})), 0)), 6)"


HYPER = f"SELECT cat, CAST(k AS BIGINT) AS k, round(CAST(k AS DOUBLE) / big_k, 6) AS representation, {hyper_sql('big_n', 'big_k', 'n', '0', 'k')} AS p_low, {hyper_sql('big_n', 'big_k', 'n', 'k', 'big_k')} AS p_high FROM cs"
FISHER = f"SELECT cat, CAST(k AS BIGINT) AS k, round(CAST(k AS DOUBLE) / big_k, 6) AS representation, {hyper_sql('(big_k + big_n)', '(k + n)', 'big_k', '0', 'k')} AS p_low, {hyper_sql('(big_k + big_n)', '(k + n)', 'big_k', 'k', 'big_k')} AS p_high FROM cs"


def binomial_sql(first: str, last: str) -> str:
    p = "(CAST(n AS DOUBLE) / big_n)"
    ch = "(lgamma(big_k + 1) - CASE WHEN x = 0 THEN 0 ELSE lgamma(x + 1) END - CASE WHEN big_k = x THEN 0 ELSE lgamma(big_k - x + 1) END)"
    return f"round(least(1, list_sum(list_transform(range({first}, {last} + 1), lambda x: exp({ch} + x * ln({p}) + (big_k - x) * ln(1 - {p}))))), 6)"


BINOMIAL = f"SELECT cat, CAST(k AS BIGINT) AS k, round(CAST(k AS DOUBLE) / big_k, 6) AS representation, {binomial_sql('0', 'k')} AS p_low, {binomial_sql('k', 'big_k')} AS p_high FROM cs"


def enriched(spark: SparkSession, d: str, test: str) -> DataFrame:
    return rounded(enrich.enrichment(membership(spark, d), listed_genes(spark, d), test), "representation", "p_low", "p_high")


@query(f"WITH {COUNTS} {HYPER}")
def enrich_hypergeom(spark: SparkSession, d: str) -> DataFrame:
    return enriched(spark, d, "hypergeometric")


@query(f"WITH {COUNTS} {FISHER}")
def enrich_fisher(spark: SparkSession, d: str) -> DataFrame:
    return enriched(spark, d, "fisher")


@query(f"WITH {COUNTS} {BINOMIAL}")
def enrich_binomial(spark: SparkSession, d: str) -> DataFrame:
    return enriched(spark, d, "binomial")


@query(f"WITH {COUNTS} SELECT cat, CAST(k AS BIGINT) AS k, dense_rank() OVER (ORDER BY CAST(k AS DOUBLE) / big_k DESC) AS rank FROM cs")
def rank_dense(spark: SparkSession, d: str) -> DataFrame:
    rows = enrich.category_counts(membership(spark, d), listed_genes(spark, d))
    return ordered.ranked(rows, F.col("k") / F.col("big_k")).select("cat", "k", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {COUNTS} SELECT cat, CAST(k AS BIGINT) AS k, rank() OVER (ORDER BY CAST(k AS DOUBLE) / big_k DESC) AS rank FROM cs")
def rank_standard(spark: SparkSession, d: str) -> DataFrame:
    rows = enrich.category_counts(membership(spark, d), listed_genes(spark, d))
    return ordered.ranked(rows, F.col("k") / F.col("big_k"), "standard").select("cat", "k", F.col("rank").cast("long").alias("rank"))


PAIRS = f"{MEMBERSHIP}, e AS (SELECT x.cat AS c1, y.cat AS c2, CAST(count(*) AS BIGINT) AS weight FROM membership x JOIN membership y ON x.gene = y.gene AND x.cat < y.cat GROUP BY 1, 2)"


@query(f"WITH {PAIRS} SELECT * FROM e")
def cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    return enrich.cooccurrence(membership(spark, d))


CLUSTERING = f"""{PAIRS}, w AS (SELECT c1, c2, weight / (SELECT max(weight) FROM e)::DOUBLE AS w FROM e), b AS (SELECT c1, c2 FROM w UNION ALL SELECT c2, c1 FROM w),
    deg AS (SELECT c1 AS node, CAST(count(*) AS BIGINT) AS degree FROM b GROUP BY 1),
    tri AS (SELECT cbrt(x.w * y.w * z.w) AS t, x.c1 AS n1, x.c2 AS n2, y.c2 AS n3 FROM w x JOIN w y ON x.c2 = y.c1 JOIN w z ON z.c1 = x.c1 AND z.c2 = y.c2),
    t AS (SELECT node, sum(t) AS t FROM (SELECT n1 AS node, t FROM tri UNION ALL SELECT n2, t FROM tri UNION ALL SELECT n3, t FROM tri) GROUP BY 1),
    coef AS (SELECT node, degree, coalesce(2 * t / nullif(degree * (degree - 1), 0), 0) AS coefficient FROM deg LEFT JOIN t USING (node))"""


@query(f"WITH {CLUSTERING} SELECT node, degree, round(coefficient, 6) AS coefficient FROM coef")
def clustering_coefficient(spark: SparkSession, d: str) -> DataFrame:
    return rounded(enrich.clustering_coefficient(enrich.cooccurrence(membership(spark, d))), "coefficient")


@query(f"WITH {SITES}, {SPANS} SELECT name, site, s.chrom, pos FROM s JOIN spans p ON s.chrom = p.chrom AND pos BETWEEN start AND \"end\"")
def interval_join(spark: SparkSession, d: str) -> DataFrame:
    sites = calls(spark, d).select("site", "chrom", "pos").distinct()
    return sequences.in_spans(sites, spans(spark, d)).select("name", "site", "chrom", "pos")


EXONS = f"""{SITES}, {SPANS}, x AS (SELECT name, chrom, name % 2 AS odd, greatest(start + o, start + 100) AS start, least(start + o + l, start + 5000) AS stop FROM spans, (VALUES (0, 900), (2000, 1200), (4500, 600)) v(o, l)),
    y AS (SELECT *, coalesce(sum(stop - start) OVER (PARTITION BY name ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(stop - start) OVER (PARTITION BY name) AS total FROM x WHERE start < stop)"""


@query(f"WITH {EXONS} SELECT name, y.chrom, pos, CAST(CASE WHEN odd = 1 THEN total - (before + pos - start) - 1 ELSE before + pos - start END AS BIGINT) AS \"offset\" FROM s JOIN y ON s.chrom = y.chrom AND pos BETWEEN start AND stop - 1")
def exon_offset(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("start")
    genes = spans(spark, d).select("name", "chrom", F.when(F.col("name") % 2 == 1, "-").otherwise("+").alias("strand"), (s + 100).alias("cds_start"), (s + 5000).alias("cds_end"), F.array(s, s + 2000, s + 4500).alias("starts"), F.array(s + 900, s + 3200, s + 5100).alias("ends"))
    return sequences.coding_offsets(calls(spark, d).select("site", "chrom", "pos").distinct(), sequences.trimmed_exons(genes))


B1, B2 = "substr('ACGT', CAST(site % 4 + 1 AS INT), 1)", "substr('ACGT', CAST((site + 1) % 4 + 1 AS INT), 1)"
SHOWN = f"""CASE g WHEN 2 THEN {B1} WHEN 0 THEN {B2} WHEN 1 THEN CASE least({B1}, {B2}) || greatest({B1}, {B2}) WHEN 'AC' THEN 'M' WHEN 'AG' THEN 'R' WHEN 'AT' THEN 'W'
    WHEN 'CG' THEN 'S' WHEN 'CT' THEN 'Y' WHEN 'GT' THEN 'K' END ELSE 'N' END"""


@query(f"{WITH} SELECT site, ind, {SHOWN} AS base FROM calls")
def iupac_encode(spark: SparkSession, d: str) -> DataFrame:
    return calls(spark, d).select("site", "ind", genotype_base(F.col("g"), base(0), base(1)).alias("base"))


@query(f"{WITH} SELECT site, chrom, pos, ind, CASE WHEN a + b >= 20 AND avg(CASE WHEN a + b >= 20 THEN 1 ELSE 0 END) OVER (PARTITION BY site) >= 0.75 THEN {SHOWN} ELSE 'N' END AS base FROM calls")
def mask_low_coverage(spark: SparkSession, d: str) -> DataFrame:
    return sequences.masked(calls(spark, d), genotype_base(F.col("g"), base(0), base(1)), 20, 0.75)


@query(f"{WITH} SELECT chrom, ind, pos // 20000 AS part, reverse(translate(string_agg({SHOWN}, '' ORDER BY pos), 'ACGTMKRYWSN', 'TGCAKMYRWSN')) AS sequence FROM calls GROUP BY 1, 2, 3")
def revcomp(spark: SparkSession, d: str) -> DataFrame:
    bases = calls(spark, d).select("chrom", "pos", "ind", genotype_base(F.col("g"), base(0), base(1)).alias("base"))
    return sequences.nearby_sequence(bases, 20000).withColumn("sequence", reverse_complement(F.col("sequence")))


@query(f"WITH {SITES} SELECT site, chrom, pos FROM s WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey % 10 = chrom AND p_partkey * 100 = pos AND (p_size % 7 IN (1, 3) OR p_partkey % 3 = 1))")
def enzyme_semi_join(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    enzymes = F.array(F.concat(F.lit("E"), F.col("p_size") % 7), F.concat(F.lit("F"), k % 3))
    table = load(spark, d, "part").select((k % 10).alias("chrom"), (k * 100).alias("pos"), enzymes.alias("enzymes"))
    return sequences.cut_by(calls(spark, d).select("site", "chrom", "pos").distinct(), table, ["E1", "E3", "F1"])


@query(f"""WITH {SITES}, f AS (SELECT p_partkey % 10 AS chrom, p_partkey * 100 AS pos, substr(p_name, 1, CAST(p_size % 5 + 1 AS INT)) AS l, right(p_name, 4) AS r FROM part WHERE p_partkey % 3 = 0)
    SELECT site, s.chrom, s.pos, l || 'n' || r AS sequence, CASE WHEN l IS NOT NULL THEN 'A/C' END AS alleles, CAST(length(l) + 1 - 6 AS VARCHAR) || ',11' AS target FROM s LEFT JOIN f ON s.chrom = f.chrom AND s.pos = f.pos""")
def flank_lookup(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    flank = F.concat(F.substring("p_name", F.lit(1), (F.col("p_size") % 5 + 1).cast("int")), F.lit("[A/C]"), F.right("p_name", F.lit(4)))
    flanks = load(spark, d, "part").where("p_partkey % 3 = 0").select((k % 10).alias("chrom"), (k * 100).alias("pos"), flank.alias("flank"))
    return sequences.flanked(calls(spark, d).select("site", "chrom", "pos").distinct(), flanks)


@query("""SELECT c_custkey AS transcript, coalesce(s_name, 'U') AS gene, coalesce('path' || s_nationkey, 'N') AS pathways FROM customer LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 2 = 0) ON c_custkey = s_suppkey""")
def transcript_map(spark: SparkSession, d: str) -> DataFrame:
    known = load(spark, d, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("transcript"), F.col("s_name").alias("gene"), F.concat(F.lit("path"), "s_nationkey").alias("pathways"))
    rows = load(spark, d, "customer").select(F.col("c_custkey").alias("transcript")).join(known, "transcript", "left")
    return rows.select("transcript", F.coalesce("gene", F.lit("U")).alias("gene"), F.coalesce("pathways", F.lit("N")).alias("pathways"))


@query(f"{WITH} SELECT site, ind, g FROM calls")
def vcf_genotype(spark: SparkSession, d: str) -> DataFrame:
    gt = F.when(F.col("g") == 2, "0/0").when(F.col("g") == 1, F.when(F.col("site") % 2 == 0, "0|1").otherwise("1/0")).when(F.col("g") == 0, "1|1").otherwise("./.")
    return calls(spark, d).select("site", "ind", gt.alias("gt")).select("site", "ind", genotype_from_vcf(F.col("gt")).cast("long").alias("g"))


@query(f"""{WITH}, c AS (SELECT site, {B1} AS base, CAST(sum(g) AS BIGINT) AS n FROM calls WHERE g >= 0 GROUP BY 1, 2 UNION ALL SELECT site, {B2}, CAST(sum(2 - g) AS BIGINT) FROM calls WHERE g >= 0 GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY n DESC, base) AS r FROM c WHERE n > 0)
    SELECT site, max(CASE WHEN r = 1 THEN base END) AS ancestral, coalesce(max(CASE WHEN r = 2 THEN base END), 'N') AS derived, max(r) AS alleles FROM r GROUP BY 1""")
def allele_major_minor(spark: SparkSession, d: str) -> DataFrame:
    both = F.when(F.col("g") == 2, F.array(base(0), base(0))).when(F.col("g") == 0, F.array(base(1), base(1))).otherwise(F.array(base(0), base(1)))
    return sequences.allele_order(calls(spark, d).where("g >= 0").select("site", F.explode(both).alias("base")))


@query(f"""{COVARIANCE.replace('round(sum(x.z * y.z), 6) AS product', 'sum(x.z * y.z) AS product').replace('SELECT x.ind AS i', ', k AS (SELECT x.ind AS i')}),
    m AS (SELECT i // 2 AS p, j // 2 AS q, avg(product) AS k FROM k WHERE i < 6 AND j < 6 GROUP BY 1, 2),
    v AS (SELECT max(CASE WHEN p = 0 AND q = 0 THEN k END) AS k11, max(CASE WHEN p = 0 AND q = 1 THEN k END) AS k12, max(CASE WHEN p = 1 AND q = 1 THEN k END) AS k22,
    max(CASE WHEN p = 2 AND q = 0 THEN k END) AS k31, max(CASE WHEN p = 2 AND q = 1 THEN k END) AS k32 FROM m)
    SELECT round((k32 - k31 - k12 + k11) / (k22 - 2 * k12 + k11), 6) AS fraction FROM v""")
def chord_projection(spark: SparkSession, d: str) -> DataFrame:
    """Where the centre of the third population projects on the chord between the first two, from centres' products."""
    k = pairs.covariance(calls(spark, d), 8).where("i < 6 AND j < 6").groupBy(F.floor(F.col("i") / 2).alias("p"), F.floor(F.col("j") / 2).alias("q")).agg(F.avg("product").alias("k"))
    of = lambda p, q: F.max(F.when((F.col("p") == p) & (F.col("q") == q), F.col("k")))
    k11, k12, k22, k31, k32 = of(0, 0), of(0, 1), of(1, 1), of(2, 0), of(2, 1)
    return k.agg(F.round((k32 - k31 - k12 + k11) / (k22 - 2 * k12 + k11), 6).alias("fraction"))


@query()
def pca_eigen(spark: SparkSession, d: str) -> DataFrame:
    """Eigenvalues scaled to a sum of n - 1 and their percents. The matrix has a row per individual, not per site."""
    n = 8
    m = np.zeros((n, n))
    for r in pairs.covariance(calls(spark, d), n).collect():
        m[r["i"], r["j"]] = r["product"]
    values = np.linalg.eigvalsh(m)[::-1]
    scale = (n - 1) / values.sum() if values.sum() > 0 else 0.0
    return spark.createDataFrame([(i + 1, round(float(v * scale), 6), round(float(100 * v * scale / (n - 1)), 6)) for i, v in enumerate(values)], "component long, eigenvalue double, percent double")


@query()
def pca_points(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates of individuals on the first two axes."""
    rows = pairs.principal_points(pairs.covariance(calls(spark, d), 8), 8)
    return rounded(spark.createDataFrame(rows, "ind long, axis long, coordinate double"), "coordinate")
