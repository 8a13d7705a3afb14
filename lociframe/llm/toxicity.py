"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, found in block-max inverted indexes.

* Examples: labelled rows outside the held-out fold, at most ``MAX_EXAMPLES`` of each class in hash order. The bound is a
  parameter; each class counts by its share of all labels, however many of it were taken.
* Index: every term (letter run in lower case) of every example of both classes; none is left out. For each term it has the
  examples that hold it, with weights, cut in blocks of ``BLOCK`` examples of which the largest weight is known. A query adds
  these bounds up, scores the most promising blocks first, and then all blocks whose bound reaches the k-th best: the nearest
  neighbours are exact. Examples stand in order of class, most frequent term and length of their vector, which keeps the bounds tight. A term is known by
  its 64-bit hash.
* Weights: (1 + log tf) * idf * emphasis. The inverse document frequency comes from all documents. The emphasis is 1 + (G - ``CHANCE``)+
  * (log lift)+, with the root of the likelihood ratio G of a term and the toxic class, and is 1 for all terms whose tie to a class could be
  chance among a million terms. Without it, words that two texts share by chance outweigh the toxic ones (README). Examples that
  agree in three minimum hashes of their terms are near copies and count once there.
* Votes: the ``K`` nearest vote with weight 1 / (distance + ``NEAR``). Leave-one-out votes of the examples, made
  monotone, calibrate the score; neighbours and similarities are the evidence. A text that shares no term with any example gets the
  toxic share of all labels.

Null and empty texts have no terms. Labels that are null are ignored; of contradicting labels of a doc_id the toxic one
holds. Rows that repeat a labelled doc_id are examples each. Without any toxic example every score is 0. Equal rows get equal scores; an empty table an empty result.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, small_batches, table, tasks, text_or_empty
from .tokens import distinct, run_places, strings

TERM = re.compile(r"[^\W\d_]+")
NO_LETTERS = string.punctuation + string.digits
MAX_EXAMPLES = 1500
CHANCE = 5.5  # one term in a million is that far from its expectation by chance, roughly
K, NEAR, BLOCK, FIRST_BLOCKS = 10, 0.1, 64, 3
MEMO, TEXTS, SLICE_BYTES = 5_000, 250, 1 << 20
HASHES = (2654435761, 2246822519, 3266489917)  # odd multipliers
EVIDENCE = "score double, evidence array<struct<doc_id: bigint, similarity: double, toxic: int>>"


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_examples(labels: DataFrame, label: str, train: Column, limit: int) -> tuple[DataFrame, list[float]]:
    """(doc_id, label) of at most ``limit`` training rows of each class, and how many rows each taken one stands for."""
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & train).groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y"))
    counts = dict(rows.groupBy("y").count().collect())
    parts = [rows.where(f"y = {y}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit) for y in (0, 1)]
    return parts[0].union(parts[1]), [counts.get(y, 0) / max(1, min(limit, counts.get(y, 0))) for y in (0, 1)]


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct terms, in order, and how often each occurs."""
    counts = Counter(TERM.findall(text.lower()))
    hashes = np.fromiter((xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in counts), "uint64", len(counts))
    order = np.argsort(hashes)
    return hashes[order], np.fromiter(counts.values(), "int64", len(counts))[order]


class Vocabulary:
    """Places of terms among hashes in order."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes

    def place(self, terms: list[str]) -> np.ndarray:
        """-1 for a term that is not there."""
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, terms), "uint64", len(terms))  # of UTF-8
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, at, -1) if len(self.hashes) else np.full(len(terms), -1)

    def word_terms(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the known terms in words, and where each word's run of them begins and how long it is."""
        stems, stem = distinct(pc.utf8_trim(words, NO_LETTERS))
        texts = list(map(str.lower, strings(stems)))
        alone = np.fromiter(map(str.isalpha, texts), bool, len(texts))
        rest = [(i, t) for i in np.flatnonzero(~alone).tolist() for t in TERM.findall(texts[i])]
        of = np.r_[np.flatnonzero(alone), np.array([i for i, _ in rest], "int64")]
        place = self.place(list(compress(texts, alone.tolist())) + [t for _, t in rest])
        order = np.flatnonzero(place >= 0)
        order = order[np.argsort(of[order], kind="stable")]
        lengths = np.bincount(of[order], minlength=len(texts))
        return place[order], (np.cumsum(lengths) - lengths)[stem], lengths[stem]

    def found(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the text, place of a term, how often it occurs there), in order."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))  # white space is in no term; other letters are lowered word by word
        words, word = distinct(split.flatten())
        place, starts, lengths = self.word_terms(words)
        text = np.repeat(np.arange(len(texts)) * len(self.hashes), pc.list_value_length(split).to_numpy())
        key = np.repeat(text, lengths[word]) + place[run_places(starts[word], lengths[word])]
        key.sort()
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        return *np.divmod(key[new], max(1, len(self.hashes))), np.diff(np.r_[new, len(key)])

    def places(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text, the places of its distinct terms, in order, and how often each occurs."""
        out = []
        for part in slices(pa.array(texts, pa.string())):
            text, place, n = self.found(part)
            cuts = np.searchsorted(text, np.arange(len(part) + 1)).tolist()
            out += [(place[a:b], n[a:b]) for a, b in pairwise(cuts)]
        return out


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Of at most ``TEXTS`` texts, and ``SLICE_BYTES`` bytes if more than one."""
    sizes, at = np.cumsum(pc.binary_length(texts).to_numpy()), 0
    while at < len(texts):
        end = int(np.searchsorted(sizes, SLICE_BYTES + (sizes[at - 1] if at else 0), "right"))
        end = min(max(end, at + 1), at + TEXTS)
        yield texts.slice(at, end - at)
        at = end


def copies_key(hashes: np.ndarray) -> tuple[int, ...]:
    low = hashes & np.uint64(0xFFFFFFFF)
    return tuple(int((low * np.uint64(m) & np.uint64(0xFFFFFFFF)).min()) for m in HASHES) if len(hashes) else ()


def emphasis(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    """Of terms in so many toxic and other example groups."""
    a, c = toxic.astype("float64"), other.astype("float64")
    expected = (a + c) * n_toxic / max(1, n_toxic + n_other)
    with np.errstate(divide="ignore", invalid="ignore"):
        g2 = 2 * (np.where(a > 0, a * np.log(a / expected), 0.0) + np.where(c > 0, c * np.log(c / (a + c - expected)), 0.0))
    lift = np.log((a + 0.5) / (n_toxic + 1)) - np.log((c + 0.5) / (n_other + 1))
    return 1 + np.maximum(np.sqrt(np.maximum(np.nan_to_num(g2), 0)) - CHANCE, 0) * np.maximum(lift, 0)


@dataclass
class Index:
    """TF-IDF vectors of examples, of length 1, by term. An entry is a term in a block of examples: its largest weight, and its postings."""

    terms: np.ndarray  # hashes in order
    weight: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    shares: list[float]

    @staticmethod
    def of(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: np.ndarray, shares: list[float], terms: np.ndarray, weight: np.ndarray) -> Index:
        rows = [(np.searchsorted(terms, h), (1 + np.log(n)) * weight[np.searchsorted(terms, h)]) for h, n in vectors]
        norms = np.array([np.sqrt((w * w).sum()) for _, w in rows])
        lead = np.array([at[weight[at].argmin()] if len(at) else -1 for at, _ in rows])  # its most frequent term: texts of one language have one
        order = np.lexsort((ids, norms, lead, labels))
        index = Index(terms, weight, labels[order], ids[order], shares)
        index.n, index.blocks = len(order), -(-len(order) // BLOCK)
        lengths = [len(rows[i][0]) for i in order]
        at = np.repeat(np.arange(len(order), dtype="int32"), lengths)
        term = np.concatenate([rows[i][0] for i in order]) if len(order) else np.zeros(0, "int64")
        w = np.concatenate([rows[i][1] / norms[i] for i in order]) if len(order) else np.zeros(0)
        by = np.lexsort((at, term))
        at, term, index.posting_weight = at[by], term[by], w[by]
        index.posting_at = at
        block = at // BLOCK
        first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])]) if len(at) else np.zeros(0, "int64")
        index.entry_block = block[first]
        index.entry_top = np.maximum.reduceat(index.posting_weight, first) if len(at) else np.zeros(0)
        index.entry_first = np.r_[first, len(at)].astype("int32")
        index.term_first = np.searchsorted(term[first], np.arange(len(terms) + 1)).astype("int32")
        return index

    def known(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the terms that the index has, and their counts."""
        if not len(self.terms):
            return np.zeros(0, "int64"), np.zeros(0, "int64")
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        held = self.terms[at] == hashes
        return at[held], counts[held]

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int, skip: int | None = None) -> list[tuple[float, int]]:
        """(similarity, position) of the k nearest examples with any term in common; ties go to the lower position. ``skip``: an id that stays out."""
        query = (1 + np.log(counts)) * self.weight[terms]
        query = query / max(np.sqrt((query * query).sum()), 1e-300)
        sizes = self.term_first[terms + 1] - self.term_first[terms]
        entries = run_places(self.term_first[terms], sizes)
        q, block = np.repeat(query, sizes), self.entry_block[entries]
        bound = np.bincount(block, q * self.entry_top[entries], self.blocks)
        order = np.argsort(-bound, kind="stable")
        best: list[tuple[float, int]] = []
        chosen = np.zeros(self.blocks, bool)
        chosen[order[:FIRST_BLOCKS]] = True
        for rest in (True, False):
            mine = chosen[block]
            e = entries[mine]
            sizes = self.entry_first[e + 1] - self.entry_first[e]
            postings = run_places(self.entry_first[e], sizes)
            score = np.bincount(self.posting_at[postings], np.repeat(q[mine], sizes) * self.posting_weight[postings], self.n)
            if skip is not None:
                score[self.ids == skip] = 0
            some = np.flatnonzero(score > 0)
            some = some[np.argsort(-score[some], kind="stable")[:k]]
            best = sorted(best + [(-score[i], int(i)) for i in some])[:k]
            if rest:
                chosen = bound >= (-best[-1][0] - 1e-12 if len(best) == k else 1e-300)
                chosen[order[:FIRST_BLOCKS]] = False
                if not chosen.any():
                    break
        return [(-s, at) for s, at in best]

    def vote(self, near: list[tuple[float, int]]) -> float:
        weight = np.array([self.shares[self.labels[at]] / (1 - min(s, 1.0) + NEAR) for s, at in near])
        return float(weight @ self.labels[[at for _, at in near]] / weight.sum())


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares non-decreasing fit: knots and their values, for linear interpolation."""
    pools: list[list[float]] = []
    at, place = np.unique(x, return_inverse=True)
    for a, b, c in zip(at.tolist(), np.bincount(place, y * w).tolist(), np.bincount(place, w).tolist(), strict=True):
        pools.append([a, a, b, c])
        while len(pools) > 1 and pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3]:
            last = pools.pop()
            pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
    return np.array([v for p in pools for v in p[:2]]), np.array([p[2] / p[3] for p in pools for _ in "ab"])


@dataclass
class ToxicityModel:
    index: Index | None
    none: float  # score of a text that shares no term with any example
    knots: np.ndarray
    values: np.ndarray

    def judge(self, terms: np.ndarray, counts: np.ndarray) -> tuple[float, list[tuple[float, int]]]:
        near = self.index.nearest(terms, counts, K) if len(terms) else []
        return float(np.interp(self.index.vote(near), self.knots, self.values)) if near else self.none, near

    def evidence(self, near: list[tuple[float, int]]) -> list[dict]:
        return [{"doc_id": int(self.index.ids[at]), "similarity": float(s), "toxic": int(self.index.labels[at])} for s, at in near]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [term_counts(t) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([h.view("int64") for h, _ in found], pa.list_(pa.int64())), pa.array([n for _, n in found], pa.list_(pa.int64()))], ["doc_id", "y", "terms", "counts"])


def term_emphasis(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Each term's emphasis, by the example groups that hold it."""
    groups: dict[tuple, int] = {}
    group = np.array([groups.setdefault((*copies_key(h), y), len(groups)) for (h, _), y in zip(vectors, labels.tolist(), strict=True)])
    toxic = np.array([k[-1] for k in groups])
    pairs = np.unique(np.concatenate([np.searchsorted(terms, h) * len(groups) + g for (h, _), g in zip(vectors, group, strict=True)]))
    term, bad = pairs // len(groups), toxic[pairs % len(groups)]
    return emphasis(np.bincount(term[bad == 1], minlength=len(terms)), np.bincount(term[bad == 0], minlength=len(terms)), int(toxic.sum()), int((toxic == 0).sum()))


def document_frequencies(texts: DataFrame, terms: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of texts, and of those that hold each term: a task leaves one row for each term that it met."""
    held = texts.sparkSession.sparkContext.broadcast(terms)  # of a bounded sample

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(held.value)
        seen, n = np.zeros(len(terms), "int64"), 0
        for b in batches:
            for part in slices(b.column(0)):
                seen += np.bincount(vocabulary.found(part)[1], minlength=len(terms))
            n += b.num_rows
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some], pa.int32()), pa.array(np.r_[n, seen[some]])], ["t", "n"])

    found = texts.mapInArrow(frequencies, "t int, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    t, n = found["t"].to_numpy(), found["n"].to_numpy()
    df = np.zeros(len(terms), "int64")
    df[t[t >= 0]] = n[t >= 0]
    return int(n[t < 0].sum()), df


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column, max_examples: int = MAX_EXAMPLES) -> ToxicityModel:
    spark = docs.sparkSession
    small_batches(spark)
    chosen, shares = labelled_examples(labels, "toxic", train, max_examples)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    chosen = cut(chosen.select(F.col("doc_id").cast("long").alias("doc_id"), "y"), "chosen")
    examples = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")  # at most 2 * max_examples ids
    found = cut(examples.mapInArrow(_vectors, "doc_id long, y int, terms array<long>, counts array<long>"), "examples")
    if found.count() > 2 * max_examples:  # an id may have any number of rows
        first = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("doc_id", "terms", "counts")))
        found = cut(found.withColumn("at", first).where(F.col("at") <= max_examples).drop("at"), "examples")
    rows = found.orderBy("doc_id", "terms", "counts").toArrow().combine_chunks()
    labels_of, ids = rows["y"].to_numpy().astype("int64"), rows["doc_id"].to_numpy()
    if not labels_of.sum():
        return ToxicityModel(None, 0.0, np.zeros(0), np.zeros(0))
    hashes, counts = (pc.list_flatten(rows[c]).to_numpy() for c in ("terms", "counts"))  # arrays, not Python numbers: the driver is small
    cuts = np.cumsum(pc.list_value_length(rows["terms"]).to_numpy())[:-1]
    vectors = list(zip(np.split(hashes.view("uint64"), cuts), np.split(counts, cuts), strict=True))
    terms = np.unique(np.concatenate([h for h, _ in vectors]))
    if not len(terms):
        return ToxicityModel(None, 0.0, np.zeros(0), np.zeros(0))
    n, df = document_frequencies(texts.select("text"), terms)
    weight = (np.log((n + 1) / (df + 1)) + 1) * term_emphasis(vectors, labels_of, terms)
    index = Index.of(vectors, labels_of, ids, shares, terms, weight)
    held = spark.sparkContext.broadcast(index)  # bounded by max_examples

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            votes = []
            for i, h, c in zip(*(b.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                near = held.value.nearest(*held.value.known(np.array(h, "int64").view("uint64"), np.array(c, "int64")), K, skip=i) if h else []
                votes.append(held.value.vote(near) if near else None)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(votes, pa.float64())], ["y", "vote"])

    votes = found.repartition(tasks(spark)).mapInArrow(left_out, "y int, vote double").where("vote IS NOT NULL").toArrow()
    y = votes["y"].to_numpy().astype("int64")
    knots, values = isotonic(np.r_[votes["vote"].to_numpy(), 0.0, 1.0], np.r_[y, 0, 1], np.array([shares[k] for k in y] + [1.0, 1.0]))
    sums = [shares[k] * (labels_of == k).sum() for k in (0, 1)]
    return ToxicityModel(index, float(sums[1] / sum(sums)), knots, values)


def toxicity(spark: SparkSession, model: ToxicityModel):
    """A function of a text column: score and evidence."""
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)  # bounded by max_examples

    @F.pandas_udf(EVIDENCE)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = held.value
        vocabulary = Vocabulary(model.index.terms if model.index else np.zeros(0, "uint64"))
        memo: dict = {}  # copies are judged once, within bounds
        for texts in batches:
            rows = []
            for at in range(0, len(texts), TEXTS):
                part = [t or "" for t in texts[at : at + TEXTS]]
                if model.index is None:
                    rows += [(0.0, [])] * len(part)
                    continue
                keys = [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in part]
                if len(memo) > MEMO:
                    memo = {}
                new = {k: t for k, t in zip(keys, part, strict=True) if k not in memo}
                memo.update(zip(new, (model.judge(*x) for x in vocabulary.places(list(new.values()))), strict=True))
                rows += [memo[k] for k in keys]
            yield pd.DataFrame({"score": [s for s, _ in rows], "evidence": [model.evidence(n) for _, n in rows]})

    return judge


def score_documents(docs: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
    """The rows of ``docs`` as struct ``row``, with score and evidence."""
    judge = toxicity(docs.sparkSession, fit_toxicity(docs, labels, train))
    return docs.select(F.struct("*").alias("row"), judge(text_or_empty(docs)).alias("at")).select("row", "at.score", "at.evidence")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    scored = score_documents(docs, labels, fold(F.col("doc_id"), 5) != 0).select("row.doc_id", "score")
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
