"""Quality by positive-unlabelled learning: a small network that minimises the non-negative unbiased risk.

* Trusted positives: rows labelled good outside the held-out fold, at most ``MAX_SAMPLE`` in hash order. Unlabelled text:
  as many documents of the whole table in hash order, whatever their labels; bad labels are never used.
* Features of a whole text are its content, a profile of its byte trigrams hashed to ``PROFILE`` places, and measures of its form
  (``features``): how words repeat, how many are in capitals or carry odd marks, over the text and in its worst window of ``WINDOW``
  words. Profiles are standardised on the sample and scaled by ``SCALE``, measures are binned at its quantiles.
* The class prior is the least ratio, over thresholds that keep enough positives, of the share of unlabelled to the share of
  held-back positives above the threshold (best bin estimate).
* Risk: prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the sigmoid loss (Kiryo et al., 2017). The network's output is
  turned into a probability by prior * density of positives / density of unlabelled, made monotone.

Null and empty texts have all-zero measures and profiles and a score like any other text. Null labels are ignored; of contradicting labels
of a doc_id the good one holds. Without positives every score is 0. Equal rows get equal scores; an empty table an empty
result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_hash, small_batches, table, text_or_empty
from .toxicity import fold, isotonic, labelled_examples

MAX_SAMPLE = 6000
WINDOW, CHUNK = 24, 1 << 16
BINS = 12
HIDDEN, ROUNDS, BATCH, RATE, DECAY = 24, 400, 1024, 0.01, 1e-3
GOOD = 0.7
ODD = re.compile(r"[^\w\s.,;:'\"()?-]")
N_FORM, PROFILE, SCALE = 16, 128, 0.1


def worst(flags: np.ndarray) -> float:
    """The largest share in a window of ``WINDOW`` words; shorter texts are one window."""
    if len(flags) <= WINDOW:
        return float(flags.mean()) if len(flags) else 0.0
    sums = np.cumsum(np.r_[0, flags])
    return float((sums[WINDOW:] - sums[:-WINDOW]).max()) / WINDOW


def features(text: str) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_FORM
    same = np.fromiter(map(eq, words, words[1:]), "int64", n - 1)
    upper = np.fromiter((w.isupper() and len(w) > 1 for w in words), "int64", n)
    odd = np.fromiter((not w.isalnum() for w in (w.strip(".,;:'\"()?-") for w in words)), "int64", n)
    marks = len(ODD.findall(text))
    lines = text.split("\n")
    return [
        math.log1p(n),
        len(set(words)) / n,
        math.log(len(set(words))) / math.log(n) if n > 1 else 1.0,
        float(same.mean()) if n > 1 else 0.0,
        worst(same),
        float(upper.mean()),
        worst(upper),
        float(odd.mean()),
        worst(odd),
        marks / len(text),
        text.count("!") / n,
        text.count("|") / n,
        sum(map(len, words)) / n,
        sum(map(str.isdigit, words)) / n,
        1 - len(set(lines)) / len(lines),
        text.count(".") / n,
    ]


def profile(text: str) -> np.ndarray:
    """Roots of the shares of the places that byte trigrams are hashed to; it has length 1 unless the text is shorter than a trigram."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), "u1")
    counts = np.zeros(PROFILE)
    for at in range(0, max(0, len(b) - 2), CHUNK):
        part = b[at : at + CHUNK + 2].astype("uint32")
        h = ((part[:-2] * np.uint32(65599) + part[1:-1]) * np.uint32(65599) + part[2:]) * np.uint32(2654435761)
        counts += np.bincount(h >> np.uint32(16) & np.uint32(PROFILE - 1), minlength=PROFILE)
    return np.sqrt(counts / max(1.0, counts.sum()))


def described(texts: list[str]) -> np.ndarray:
    """A row of measures and profile for each text."""
    return np.array([np.r_[features(t), profile(t)] for t in texts]).reshape(-1, N_FORM + PROFILE)


@dataclass
class QualityModel:
    edges: list[np.ndarray]
    mean: np.ndarray
    spread: np.ndarray
    weights: list[np.ndarray]
    knots: np.ndarray
    values: np.ndarray

    def inputs(self, x: np.ndarray) -> np.ndarray:
        """One column for each edge of a measure, whether it is above it, and the standardised profile."""
        above = [(x[:, i : i + 1] > e).astype("float64") for i, e in enumerate(self.edges)]
        return np.hstack([*above, SCALE * np.clip((x[:, N_FORM:] - self.mean) / self.spread, -4, 4)])

    def logit(self, b: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum(b @ w1 + b1, 0) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots) or not len(x):
            return np.zeros(len(x))
        return np.interp(self.logit(self.inputs(x)), self.knots, self.values)


def best_bin(p: np.ndarray, u: np.ndarray, least: float = 0.5) -> float:
    """The class prior: least ratio of the shares above a threshold that keeps at least ``least`` of the positives."""
    cuts = np.quantile(p, np.linspace(0, 1 - least, 101))
    shares_p, shares_u = (p[None] >= cuts[:, None]).mean(axis=1), (u[None] >= cuts[:, None]).mean(axis=1)
    slack = np.sqrt(math.log(200) / 2 / len(p)) + np.sqrt(math.log(200) / 2 / len(u))
    at = ((shares_u + slack) / shares_p).argmin()
    return float(min(0.99, max(0.01, shares_u[at] / shares_p[at])))


def train(p: np.ndarray, u: np.ndarray, prior: float, seed: int = 3, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Adam on the non-negative risk with the sigmoid loss."""
    rng = np.random.default_rng(seed)
    d = p.shape[1]
    w = [rng.normal(0, 1 / math.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    for step in range(1, rounds + 1):
        xp, xu = p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]
        x = np.vstack([xp, xu])
        h = np.maximum(x @ w[0] + w[1], 0)
        s = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3][0], -30, 30)))
        sp, su = s[:BATCH], s[BATCH:]
        slope = s * (1 - s)
        negative = su.mean() - prior * sp.mean()
        if negative >= 0:  # risk = prior * mean(1 - sp) + mean(su) - prior * mean(sp)
            g = np.r_[np.full(BATCH, -2 * prior / BATCH), np.full(BATCH, 1 / BATCH)] * slope
        else:  # step back from the part that fell below zero
            g = np.r_[np.full(BATCH, prior / BATCH), np.full(BATCH, -1 / BATCH)] * slope
        dh = g[:, None] * w[2][None] * (h > 0)
        grads = [x.T @ dh + DECAY * w[0] / len(w[0]), dh.sum(axis=0), h.T @ g, np.array([g.sum()])]
        for i, grad in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad**2
            w[i] = w[i] - RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return w


def fit(p: np.ndarray, u: np.ndarray, seed: int = 3) -> QualityModel:
    """From the features of positives and of unlabelled texts."""
    if not len(p) or not len(u):
        return QualityModel([], np.zeros(0), np.zeros(0), [], np.zeros(0), np.zeros(0))
    both = np.vstack([p, u])
    quantiles = np.r_[np.linspace(0, 1, BINS + 1)[1:-1], 0.95, 0.98, 0.99]
    edges = [np.unique(np.quantile(both[:, i], quantiles)) for i in range(N_FORM)]
    shape = both[:, N_FORM:]
    model = QualityModel(edges, shape.mean(axis=0), shape.std(axis=0) + 1e-6, [], np.zeros(0), np.zeros(0))
    bp, bu = model.inputs(p), model.inputs(u)
    back = np.random.default_rng(seed).random(len(p)) < 0.25 if len(p) >= 40 else np.zeros(len(p), bool)
    held = bp[back] if back.any() else bp
    prior = 0.5
    for _ in range(2):  # the second round learns with the prior that the first one finds
        model.weights = train(bp[~back], bu, prior, seed)
        prior = best_bin(model.logit(held), model.logit(bu))
    model.weights = train(bp[~back], bu, prior, seed)
    zp, zu = model.logit(held), model.logit(bu)
    cuts = np.unique(np.quantile(np.r_[zp, zu], np.linspace(0, 1, min(41, 3 + len(zp) // 20))))
    ip, iu = (np.bincount(np.searchsorted(cuts, z, "right"), minlength=len(cuts) + 1) for z in (zp, zu))
    share_p, share_u = ip / len(zp), (iu + 0.5) / (len(zu) + 0.5 * len(iu))
    used, z = (ip + iu) > 0, np.r_[zp, zu]
    centre = np.bincount(np.searchsorted(cuts, z, "right"), z, len(ip))[used] / (ip + iu)[used]
    model.knots, values = isotonic(centre, (prior * share_p / share_u)[used], share_u[used])
    model.values = np.minimum(1, values)
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, train_rows: Column, max_sample: int = MAX_SAMPLE) -> QualityModel:
    small_batches(docs.sparkSession)
    good = labelled_examples(labels, "quality", train_rows, max_sample)[0].where("y = 1")
    texts = docs.select("doc_id", text_or_empty(docs).alias("text"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            h = [row_hash(i, t) for i, t in zip(b.column(0).to_pylist(), texts, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(list(described(texts)), pa.list_(pa.float64()))], ["h", "x"])

    def sample(rows: DataFrame) -> np.ndarray:
        """Numbers of at most max_sample rows: an id may have any number of them."""
        found = rows.select("doc_id", "text").mapInArrow(measured, "h long, x array<double>").orderBy("h").limit(max_sample).toPandas()["x"]
        return np.stack(found.to_numpy()) if len(found) else np.empty((0, N_FORM + PROFILE))

    ids = docs.select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(max_sample).distinct()
    positives = sample(texts.join(F.broadcast(good.select("doc_id")), "doc_id"))
    return fit(positives, sample(texts.join(F.broadcast(ids), "doc_id")))


def quality(spark: SparkSession, model: QualityModel):
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)  # bounded: some ten thousand numbers

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(held.value.score(described([t or "" for t in texts])))

    return score


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    score = quality(spark, fit_quality(docs, labels, fold(F.col("doc_id"), 4) != 2))
    scored = docs.select("doc_id", score(text_or_empty(docs)).alias("score"))
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
