"""Gene categories: which are over-represented in a list, and how they share genes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import stored
from ..functions.tails import binomial_tails, hypergeometric_tails
from .prefix import numbered, ranked

#: Categories that say nothing.
NO_CATEGORY = ("", "U", "N")


def split_categories(rows: DataFrame, column: str) -> DataFrame:
    """(gene, ``.``-separated categories) -> distinct (gene, cat)."""
    cats = F.array_except(F.split(column, r"\."), F.array(*[F.lit(x) for x in NO_CATEGORY]))
    return rows.select("gene", F.explode(cats).alias("cat")).distinct()


def category_counts(membership: DataFrame, listed: DataFrame) -> DataFrame:
    """k and big_k (listed genes and all genes of a category), n and big_n (listed genes and all genes with any category)."""
    genes = membership.select("gene").distinct().join(listed.withColumn("listed", F.lit(1)), "gene", "left")
    sizes = genes.agg(F.count("listed").alias("n"), F.count("*").alias("big_n"))
    flagged = membership.join(listed.withColumn("listed", F.lit(1)), "gene", "left")
    counts = flagged.groupBy("cat").agg(F.count("listed").alias("k"), F.count("*").alias("big_k"))
    return counts.crossJoin(F.broadcast(sizes))  # one row


def enrichment(membership: DataFrame, listed: DataFrame, test: str) -> DataFrame:
    """cat, k, share of the category, and the probabilities of as few (low) and as many (high) listed genes."""
    c = category_counts(membership, listed)
    if test == "binomial":
        tails = binomial_tails("k", "big_k", F.col("n") / F.col("big_n"))
    elif test == "fisher":  # second row of the table is the whole universe
        tails = hypergeometric_tails("k", F.col("big_k") + F.col("big_n"), F.col("k") + F.col("n"), "big_k")
    else:
        tails = hypergeometric_tails("k", "big_n", "big_k", "n")
    out = c.withColumn("p", tails)
    return out.select("cat", "k", (F.col("k") / F.col("big_k")).alias("representation"), F.col("p.low").alias("p_low"), F.col("p.high").alias("p_high"))


def enrichment_report(rows: DataFrame) -> DataFrame:
    """Count, representation, rank and both probabilities of each category, from the most represented on; ties by count, probabilities and name."""
    order = [F.desc(c) for c in ("representation", "k", "p_low", "p_high", "cat")]
    told = ranked(rows, "rank", "standard", (F.col("representation"), True))
    return told.select(F.col("k").alias("count"), "representation", "rank", "p_low", "p_high", "cat").orderBy(*order)


#: Categories that are paired within one row.
BLOCK = 256
#: Genes in a set of bits.
BITS = 64


def cooccurrence(membership: DataFrame, block: int = BLOCK) -> DataFrame:
    """Genes that two categories share.

    Genes are taken ``BITS`` at a time. Where they have so few categories together that these make fewer pairs than the genes one by one, a category is the set of those
    genes that have it, and a pair's genes are counted by the bits that two sets share; all other genes are paired one by one.
    """
    rows = stored(membership.select("gene", "cat").distinct())
    sizes = rows.groupBy("gene").agg(F.count("*").alias("n"))
    at = stored(numbered(sizes, "at", F.asc("gene")).select("gene", "n", F.floor(F.col("at") / BITS).alias("set"), (F.col("at") % BITS).cast("int").alias("bit")))
    alone = at.groupBy("set").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("alone"))
    sets = rows.join(at, "gene").groupBy("set", "cat").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    together = sets.groupBy("set").agg(F.array_sort(F.collect_list(F.struct("cat", "bits"))).alias("c"))
    together = stored(together.join(alone, "set").where((F.size("c") <= block) & (F.size("c") * (F.size("c") - 1) < F.col("alone"))).select("set", "c"))
    shared = lambda x, y: F.bit_count(x["bits"].bitwiseAND(y["bits"])).cast("long")
    within = F.flatten(F.transform("c", lambda x: F.transform(F.filter("c", lambda y: y["cat"] > x["cat"]), lambda y: F.struct(x["cat"].alias("c1"), y["cat"].alias("c2"), shared(x, y).alias("weight")))))
    left = at.join(together.select("set"), "set", "left_anti").select("gene")
    pairs = together.select(F.inline(within)).where("weight > 0").union(gene_pairs(rows.join(left, "gene"), block).select("c1", "c2", F.lit(1).cast("long").alias("weight")))
    return pairs.groupBy("c1", "c2").agg(F.sum("weight").alias("weight"))


def gene_pairs(rows: DataFrame, block: int) -> DataFrame:
    """(gene, cat) -> (c1, c2) for each gene that has both.

    Pairs are formed within arrays of a gene's categories. A gene with more than ``block`` categories has them dealt to blocks of about that
    size by hash: pairs within a block as before, pairs across by a join of its blocks, so no row and no task holds all pairs of a gene.
    """
    wide = stored(rows.groupBy("gene").agg(F.count("*").alias("n")).where(F.col("n") > block))
    dealt = rows.join(wide, "gene", "left").withColumn("blocks", F.coalesce(F.ceil(F.col("n") / block), F.lit(1)))
    held = dealt.withColumn("block", F.pmod(F.xxhash64("cat"), F.col("blocks"))).groupBy("gene", "blocks", "block").agg(F.array_sort(F.collect_list("cat")).alias("c"))
    within = F.flatten(F.transform("c", lambda x: F.transform(F.filter("c", lambda y: y > x), lambda y: F.struct(x.alias("c1"), y.alias("c2")))))
    pairs = held.select(F.inline(within))
    if not wide.isEmpty():
        parts = stored(held.where("blocks > 1"))
        other = parts.select("gene", F.col("block").alias("next"), F.col("c").alias("d"))
        across = F.flatten(F.transform("c", lambda x: F.transform("d", lambda y: F.struct(F.least(x, y).alias("c1"), F.greatest(x, y).alias("c2")))))
        pairs = pairs.union(parts.join(other, "gene").where("block < next").select(F.inline(across)))
    return pairs


def clustering_coefficient(edges: DataFrame) -> DataFrame:
    """Weighted (geometric mean of triangle weights over the largest weight) for each node of (c1 < c2, weight).

    Edges point from the node of the lower degree to that of the higher (ties by name): no node has more than the root of twice the
    edges going out, so that the pairs at a hub stay few.
    """
    edges = stored(edges.select("c1", "c2", "weight"))
    degree = stored(edges.select(F.explode(F.array("c1", "c2")).alias("node")).groupBy("node").agg(F.count("*").alias("degree")))
    top = edges.agg(F.max("weight").alias("top"))
    ends = [degree.select(F.col("node").alias(c), F.struct("degree", F.col("node").alias("n")).alias(f"r{c[1]}")) for c in ("c1", "c2")]
    e = edges.join(ends[0], "c1").join(ends[1], "c2").crossJoin(F.broadcast(top))  # one row
    e = stored(e.select(F.least("r1", "r2").alias("lo"), F.greatest("r1", "r2").alias("hi"), (F.col("weight") / F.col("top")).alias("w")))
    x, y, z = e.alias("x"), e.alias("y"), e.alias("z")
    wedges = x.join(y, (F.col("x.lo") == F.col("y.lo")) & (F.col("x.hi") < F.col("y.hi")))
    triangles = wedges.join(z, (F.col("x.hi") == F.col("z.lo")) & (F.col("y.hi") == F.col("z.hi")))
    closed = triangles.select(F.cbrt(F.col("x.w") * F.col("y.w") * F.col("z.w")).alias("t"), F.explode(F.array("x.lo.n", "x.hi.n", "y.hi.n")).alias("node"))
    sums = closed.groupBy("node").agg(F.sum("t").alias("t"))
    value = 2 * F.coalesce("t", F.lit(0.0)) / F.nullif(F.col("degree") * (F.col("degree") - 1), F.lit(0))
    return degree.join(sums, "node", "left").select("node", "degree", F.coalesce(value, F.lit(0.0)).alias("coefficient"))


def well_clustered(edges: DataFrame, percentile: float) -> DataFrame:
    """Edges between nodes whose coefficient reaches the percentile of all coefficients."""
    found = clustering_coefficient(edges)
    bound = found.agg(F.expr(f"percentile(coefficient, {percentile})").alias("bound"))
    kept = found.join(F.broadcast(bound), F.round("coefficient", 9) >= F.round("bound", 9)).select("node")  # one row
    return edges.join(kept.withColumnRenamed("node", "c1"), "c1", "left_semi").join(kept.withColumnRenamed("node", "c2"), "c2", "left_semi")
