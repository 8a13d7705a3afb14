"""Source divergence audit: how far the term frequencies of a language's sources lie apart, by an inverted index with baseline correction.

1. Tasks count terms by (lang, source) in dictionaries of bounded size, so that a hot source or term reaches the shuffle pre-aggregated. A language keeps the
   terms that at least ``MIN_DOCS`` of its documents hold: V of them. N is the sum of a group's counts over kept terms. Postings are the
   rows (lang, term, source, p) of groups that hold the term, p = 1 + floor(10^9 (count + 1) / (N + V)).
2. A group's p for a term it lacks, ``p0``, is one number. So each ordered pair of sources starts at V f(p0, q0), with
   f(p, q) = floor((p - q)^2 / q), and only terms that either holds correct that: f(p, q0) - f(p0, q0) where the one holds it, f(p0, q) - f(p0, q0) where the other does,
   and where both do f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0) on top. The first two depend on a group's p and the other's p0 alone, so they are taken once for
   all terms of a group with the same p. The last meets the postings of a term. Corrections of zero are not emitted.
3. The terms that a group uses more than its language does are ranked in windows; Spark keeps ``TOP_TERMS`` of a group in each task before it shuffles.

Arithmetic is in integers: p in decimals of 38 digits, as 10^9 (count + 1) may pass 64 bits, and the rest in 64-bit integers. A sum of f over
terms is at most some (10^9 + V)^2, and Spark raises an error where one would pass 64 bits.

Null text, lang and source count as ''. A lang with one source has no pairs; one without kept terms has pairs of value 0 and no terms. Rows that repeat are
documents of their own, whatever their ids. Ties in value are ordered by item. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, sent_if_small, small_batches, table, text_or_empty
from .windows import windows

#: Maximal runs of ASCII letters, here in lower case, and anything beyond ASCII; the same in bytes of UTF-8.
TERM = re.compile(rb"[a-z\x80-\xff]+")
MIN_DOCS, TOP_TERMS, SCALE = 3, 200, 1_000_000_000
#: So many terms are held in a task before they are emitted.
HELD = 300_000
COUNTS = "lang string, source string, term string, n long, docs long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang, source) -> counts of terms and of documents that hold them; a row without a term tells that the group occurs."""
    names, types = ["lang", "source", "term", "n", "docs"], [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def emitted() -> pa.RecordBatch:
        rows = [(*group, None, 0, 0) for group in held]
        rows += [(*group, term.decode("utf-8", "replace"), n, docs[term]) for group, (total, docs) in held.items() for term, n in total.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    size = 0
    for b in batches:
        for text, *group in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            total, docs = held.setdefault(tuple(group), (Counter(), Counter()))
            before, own = len(total), set()
            for window in windows(text):
                terms = Counter(TERM.findall(window.encode("utf-8", "surrogatepass").lower()))
                total.update(terms)
                own.update(terms)
            docs.update(own)
            size += len(total) - before
            if size > HELD:
                yield emitted()
                held, size = {}, 0
    if held:
        yield emitted()


def _p(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE (count + 1) / (total + kept)); count and total are below 2^63."""
    return F.when(kept > 0, 1 + F.call_function("div", (count.cast("decimal(20,0)") + 1) * F.lit(SCALE).cast("decimal(10,0)"), total.cast("decimal(20,0)") + kept))


def _f(p: Column | str, q: Column | str) -> Column:
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return F.call_function("div", (p - q) * (p - q), q)


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """Groups (lang, source, v, total, p0), p0 null where v = 0, and postings (lang, source, term, n, p) of kept terms, with the lang's own count and p as lang_n, lang_p."""
    small_batches(docs.sparkSession)
    rows = docs.select(text_or_empty(docs).alias("text"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    counts = cut(rows.mapInArrow(_counted, COUNTS).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    terms = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs")
    kept = cut(counts.drop("docs").join(terms, ["lang", "term"]), "kept")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = cut(kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total")), "langs")
    groups = counts.where("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(F.broadcast(langs) if langs.count() <= 10_000 else langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("v", "total", "lang_total")])
    groups = cut(groups.withColumn("p0", _p(F.lit(0), F.col("total"), F.col("v"))), "groups")
    postings = kept.join(sent_if_small(groups), ["lang", "source"])
    postings = postings.select("lang", "source", "term", "n", _p(F.col("n"), F.col("total"), F.col("v")).alias("p"), "lang_n", _p(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("lang_p"), "p0")
    return groups, cut(postings, "postings")


def source_pairs(groups: DataFrame, postings: DataFrame) -> DataFrame:
    """(lang, source, item, value) for all ordered pairs of a lang's sources, items being the other ones."""
    other = sent_if_small(groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0")))
    apart = F.col("source") != F.col("item")
    start = groups.join(other, "lang").where(apart).select("lang", "source", "item", F.coalesce(F.col("v") * _f("p0", "q0"), F.lit(0)).alias("value"))
    same_p = cut(postings.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms")), "same_p").join(other, "lang").where(apart)
    mine = same_p.select("lang", "source", "item", (F.col("terms") * (_f("p", "q0") - _f("p0", "q0"))).alias("value"))
    # the group whose p is counted is the other one here: its source is the item of the row
    theirs = same_p.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (F.col("terms") * (_f("q0", "p") - _f("q0", "p0"))).alias("value"))
    corrections = start.union(mine.union(theirs).where("value <> 0"))
    # two postings of a term meet once, for both orders of their sources
    met = postings.select("lang", "term", "source", "p", "p0").join(postings.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0")), ["lang", "term"]).where("source < item")
    over = lambda p, q, p0, q0: _f(p, q) - _f(p, q0) - _f(p0, q) + _f(p0, q0)
    both = met.select("lang", "source", "item", over("p", "q", "p0", "q0").alias("value"), over("q", "p", "q0", "p0").alias("turned")).where("value <> 0 OR turned <> 0")
    both = cut(both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("turned").alias("turned")), "both")
    turned = both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("turned").alias("value"))
    return corrections.union(both.drop("turned")).union(turned).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def overused_terms(postings: DataFrame) -> DataFrame:
    """(lang, source, item, value) for the terms that a group uses more than its lang does."""
    return postings.where("p > lang_p").select("lang", "source", F.col("term").alias("item"), _f("p", "lang_p").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    groups, postings = term_counts(docs, min_docs)
    ordered = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = cut(source_pairs(groups, postings), "pairs").withColumn("rank", F.row_number().over(ordered))
    terms = overused_terms(postings).withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= top)
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))).select("lang", "source", "part", "item", "value", "rank")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


def op12_sql() -> str:
    return r"""
WITH docs AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
langs AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
lang_totals AS (SELECT lang, count(*) AS v, sum(lang_n)::HUGEINT AS lang_total FROM langs GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
grid AS (SELECT g.lang, g.source, l.term, l.lang_n, coalesce(c.n, 0)::HUGEINT AS n
         FROM groups g JOIN langs l ON g.lang = l.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = l.term),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM grid GROUP BY lang, source),
p AS (SELECT g.lang, g.source, g.term, g.n, 1 + (1000000000 * (g.n + 1)) // (t.total + v.v) AS p, 1 + (1000000000 * (g.lang_n::HUGEINT + 1)) // (v.lang_total + v.v) AS q
      FROM grid g JOIN totals t ON g.lang = t.lang AND g.source = t.source JOIN lang_totals v ON v.lang = g.lang),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
           UNION ALL
           SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
