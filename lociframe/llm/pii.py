"""Personal data: fixed patterns, and candidates that boosted trees select.

* Base spans: the leftmost non-overlapping matches of one pattern per kind; matches that fail the kind's check are dropped
  without another try. They always stay.
* Generators propose more spans, which may overlap: addresses with a written-out at sign, digit groups in the forms of cards
  and phone numbers that the base patterns or checks refuse, other notations of network addresses.
* Gradient-boosted trees score every candidate by its kind, its format (lengths, digit groups, separators, beginning) and its context, not by whether a base check passes. What lies beyond all labels of a kind counts as what is usual for the kind. They learn
  from every labelled span of every row. True ones are base
  spans and phone numbers within one; false ones are matches of the base patterns that fail their check, candidates in the form of a card that fail its check, and candidates within a
  longer match that failed. What else a generator proposes, or overlaps a base span, has no label and is left out. The spans of three rows in ten are held back and calibrate the score; each kind's threshold is halfway between the lowest
  of their scores that keeps ``PRECISION`` of them right and the next lower one. A kind of which no base match fails a check has no false ones: all its candidates in a
  context that the others do not speak against are added.
* Spans that are described alike are counted together, quantiles are exact, and gradients are summed as whole numbers, so neither the order of rows nor how Spark deals them changes the trees.
  The sums of a level are one Spark job; the driver gets a number per node, feature and bin. At most ``FEW_ROWS`` counted rows of bins are summed on the driver itself, with the same result.
* Candidates above their threshold are added, save those known to be false, best first, where they overlap no span chosen before.

Positions are code points, end exclusive. Null and empty texts have no spans. Every scan is linear in the text, whatever
its length. Without both true and false candidates to learn from, only base spans are found. Equal rows get equal spans; an empty table gives an
empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, row_hash, small_batches, table, text_or_empty
from .toxicity import isotonic

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
TREES, DEPTH, RATE, CUTS = 40, 3, 0.2, 32
CONTEXT = 24
#: Gradients are whole multiples of 1 / SCALE, scores before calibration of 1 / GRID, from -LIMIT to LIMIT.
SCALE, GRID, LIMIT = 1 << 24, 256, 16
#: So many rows of bins with their counts (2 MB) may go to the driver.
FEW_ROWS = 50_000
#: Rows of bins that are summed at once.
BLOCK = 16_384

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # no match begins inside a run of digits
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
GROUP = re.compile(r"[0-9]+")
MORE = {
    "email": re.compile(r"(?<![\w.+-])[\w.+-]{1,64}\s?(?:\(at\)|\[at\])\s?[\w-]{1,64}(?:\s?(?:\.|\(dot\)|\[dot\])\s?[\w-]{1,64}){1,8}", re.I),
    "ip": re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![\w:])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ .-]{0,2}[0-9]{4}){2,3}(?:[ .-]{0,2}[0-9]{1,3})?(?![0-9])"),
    "phone": re.compile(r"(?<![\w+(])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![\w])"),
}
CUES = re.compile(r"mail|contact|tel|phone|call|mobile|fax|card|visa|pay|ip|host|server|addr", re.I)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def digits_of(s: str) -> str:
    return "".join(DIGIT.findall(s))


def small_parts(s: str) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or "0") <= 255 for x in s.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the pattern, found from their at sign: what is before it is the longest run of local characters."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if small_parts(m[0])]
        out += [("card", *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Base spans first, then what the generators add."""
    out = dict.fromkeys(base)
    if DIGIT.search(text):
        out.update(dict.fromkeys(("ip", *m.span()) for m in IP.finditer(text)))
        out.update(dict.fromkeys(("card", *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 11))
        if "+" in text:
            out.update(dict.fromkeys(("phone", *m.span()) for m in PHONE.finditer(text)))
        for kind in ("card", "phone"):
            out.update(dict.fromkeys((kind, *m.span()) for m in MORE[kind].finditer(text)))
    if "::" in text or text.count(":") > 2:
        out.update(dict.fromkeys(("ip", *m.span()) for m in MORE["ip"].finditer(text)))
    if re.search(r"[\[(]at[\])]", text, re.I):
        out.update(dict.fromkeys(("email", *m.span()) for m in MORE["email"].finditer(text)))
    return list(out)


def disjoint(spans: list[tuple[str, int, int]]) -> list[list[int]]:
    """What the spans cover, as intervals in order that do not overlap."""
    covers: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if covers and a <= covers[-1][1]:
            covers[-1][1] = max(covers[-1][1], b)
        else:
            covers.append([a, b])
    return covers


def free(covers: list[list[int]], a: int, b: int) -> bool:
    i = bisect.bisect_left(covers, [b])
    return not i or covers[i - 1][1] <= a


def checked_matches(text: str, base: list[tuple[str, int, int]]) -> list[tuple[tuple[str, int, int], float]]:
    """Base spans, and matches of the base patterns that failed their check and overlap no base span."""
    failed = []
    if DIGIT.search(text):
        failed += [("ip", *m.span()) for m in IP.finditer(text)]
        failed += [("card", *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 11]
        if "+" in text:
            failed += [("phone", *m.span()) for m in PHONE.finditer(text)]
    covers = disjoint(base)
    return [(s, 1.0) for s in base] + [(s, 0.0) for s in failed if free(covers, s[1], s[2])]


def labelled_parts(text: str, known: list[tuple[tuple[str, int, int], float]]) -> list[tuple[tuple[str, int, int], float]]:
    """Generators' candidates whose label follows from the checked matches: a phone number within a longer true one is true, within a longer failed match
    of any kind false; digit groups in the form of a card that fail its check are false."""
    if not DIGIT.search(text):
        return []
    true, wrong = disjoint([s for s, y in known if y and s[0] == "phone"]), disjoint([s for s, y in known if not y])
    covers, met = disjoint([s for s, y in known if y]), {s for s, _ in known}
    within = lambda spans, a, b: (i := bisect.bisect_right(spans, [a, math.inf])) and spans[i - 1][1] >= b and spans[i - 1] != [a, b]
    parts = [(("card", *m.span()), 0.0) for m in MORE["card"].finditer(text) if free(covers, *m.span()) and not luhn(digits_of(m[0]))]
    for m in MORE["phone"].finditer(text):
        if within(true, *m.span()):
            parts.append((("phone", *m.span()), 1.0))
        elif free(covers, *m.span()) and within(wrong, *m.span()):
            parts.append((("phone", *m.span()), 0.0))
    return [(s, y) for s, y in parts if s not in met]


def drawn(rows: list, n: int) -> list:
    """At most ``n`` labelled spans, in order of their hash."""
    return rows if len(rows) <= n else sorted(rows, key=lambda r: (zlib.crc32(repr(r[0]).encode()), r[0]))[:n]


def shape(s: str) -> list[float]:
    """The format of a candidate: lengths, groups of digits, separators, and what it begins with."""
    groups = [len(g) for g in GROUP.findall(s)]
    separators = [c for c in s if not c.isalnum()]
    first = s[0]
    return [
        float(len(s)),
        float(sum(groups)),
        float(len(groups)),
        float(max(groups, default=0)),
        float(min(groups, default=0)),
        float(groups[0] if groups else 0),
        float(groups[-1] if groups else 0),
        float(len(set(groups)) == 1),
        float(len(set(separators))),
        float(sum(map(str.isspace, separators))),
        float(separators.count("-")),
        float(separators.count(".")),
        float(sum(c in "()[]" for c in separators)),
        float(separators.count(":")),
        float(sum(map(str.isalpha, s))),
        0.0 if first.isalpha() else 1.0 if first.isdigit() else 2.0 if first == "+" else 3.0,
        float(int(first)) if first in "0123456789" else -1.0,
    ]


def described(text: str, span: tuple[str, int, int]) -> list[float]:
    """Kind, format and context of a candidate; whether a base check passes is no part of it."""
    kind, a, b = span
    before, after = text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT]
    one = lambda c: 0.0 if not c else 1.0 if c.isspace() else 2.0 if c.isalpha() else 3.0 if c.isdigit() else 4.0
    return [
        float(KINDS.index(kind)),
        one(before[-1:]),
        one(after[:1]),
        float(bool(CUES.search(before))),
        float(len(DIGIT.findall(before)) + len(DIGIT.findall(after))),
        float("=" in before[-12:] or '"' in before[-2:]),
        *shape(text[a:b]),
    ]


N_FEATURES = 23


@dataclass
class Trees:
    """Boosted regression trees of one depth on the logistic loss; nodes are in heap order."""

    start: float = 0.0
    splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # feature, threshold, leaf values

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, threshold, leaves in self.splits:
            node = np.zeros(len(x), "int64")
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaves[node - (2**DEPTH - 1)]
        return out

    def grow(self, share: float, sums: Sums) -> Trees:
        """Trees on bins of the features; a threshold is the last bin on the left."""
        share = min(0.999, max(0.001, share))
        self.start = math.log(share / (1 - share))
        for _ in range(TREES):
            feature, threshold, leaves = np.zeros(2**DEPTH - 1, "int64"), np.full(2**DEPTH - 1, np.inf), np.zeros(2**DEPTH)
            for level in range(DEPTH):
                first = 2**level - 1
                left = (sums(self, feature, threshold, level) / SCALE).cumsum(axis=3)
                for k, (gs, hs) in enumerate(left.swapaxes(0, 1)):
                    g, h = gs[0, -1], hs[0, -1]
                    gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                    j, c = np.unravel_index(gain.argmax(), gain.shape)
                    a, b = g, h
                    if gain[j, c] > 1e-6:
                        feature[first + k], threshold[first + k] = j, c
                        a, b = gs[j, c], hs[j, c]
                    if level == DEPTH - 1:
                        leaves[2 * k : 2 * k + 2] = RATE * a / (b + 1), RATE * (g - a) / (h - b + 1)
            self.splits.append((feature, threshold, leaves))
        return self

    def unbinned(self, edges: list[np.ndarray]) -> Trees:
        """The same trees on the features themselves."""
        value = lambda j, c: edges[j][int(c)] if c < np.inf else np.inf
        self.splits = [(f, np.array([value(j, c) for j, c in zip(f, t, strict=True)]), leaves) for f, t, leaves in self.splits]
        return self

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        edges = [np.unique(np.quantile(x[:, j], QUANTILES)) for j in range(x.shape[1])]
        return self.grow(y.mean(), Binned(binned(x, edges), y, np.ones(len(y), "int64")).sums).unbinned(edges)


#: Of trees and the features and thresholds of one more, down to a level: gradient and curve by node of that level, feature and bin, times SCALE.
Sums = Callable[[Trees, np.ndarray, np.ndarray, int], np.ndarray]
QUANTILES = np.linspace(0, 1, CUTS + 1)[1:-1]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bins of each feature, feature by feature."""
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)]).astype("uint8")


class Binned:
    """Rows of bins, feature by feature, with their labels and how often each occurs."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, n: np.ndarray):
        self.bins, self.y, self.n = bins, y, n
        self.raw, self.trees = None, 0

    def place(self, feature: np.ndarray, threshold: np.ndarray, level: int) -> np.ndarray:
        """The node of each row in a level, from 0."""
        node = np.zeros(len(self.y), "uint8")
        for first in (2**x - 1 for x in range(level)):
            goes = lambda k: self.bins[feature[k]] > np.uint8(min(threshold[k], 255))
            right = goes(first)
            for k in range(1, first + 1):
                right = np.where(node == k, goes(first + k), right)
            node = 2 * node + right
        return node

    def sums(self, trees: Trees, feature: np.ndarray, threshold: np.ndarray, level: int) -> np.ndarray:
        self.raw = np.full(len(self.y), trees.start) if self.raw is None else self.raw
        for f, t, leaves in trees.splits[self.trees :]:
            self.raw += leaves[self.place(f, t, DEPTH)]
        self.trees = len(trees.splits)
        p = 1 / (1 + np.exp(-self.raw))
        features = len(self.bins)
        cells = ((self.place(feature, threshold, level).astype("int64") * features + np.arange(features)[:, None]) * CUTS + self.bins).ravel()
        out = np.zeros((2, 2**level * features * CUTS), "int64")
        for part, each in zip(out, (self.y - p, p * (1 - p)), strict=True):
            np.add.at(part, cells, np.tile(np.rint(each * SCALE).astype("int64") * self.n, features))
        return out.reshape(2, 2**level, features, CUTS)


@dataclass
class PiiModel:
    trees: Trees
    knots: np.ndarray
    values: np.ndarray
    thresholds: dict[str, float]
    #: Of each kind, between which values its labelled spans lie, and what is usual for true ones.
    low: np.ndarray = field(default_factory=lambda: np.full((len(KINDS), N_FEATURES), -np.inf))
    high: np.ndarray = field(default_factory=lambda: np.full((len(KINDS), N_FEATURES), np.inf))
    usual: np.ndarray = field(default_factory=lambda: np.zeros((len(KINDS), N_FEATURES)))

    def known(self, x: np.ndarray) -> np.ndarray:
        """A format or context beyond what labels of the kind cover says nothing for or against: it counts as the usual one."""
        kind = x[:, 0].astype("int64")
        return np.where((x < self.low[kind]) | (x > self.high[kind]), self.usual[kind], x)

    def place(self, x: np.ndarray) -> np.ndarray:
        return np.rint(np.clip(self.trees.raw(self.known(x)), -LIMIT, LIMIT) * GRID).astype("int64")

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.place(x) / GRID, self.knots, self.values)

    def calibrate(self, kind: np.ndarray, place: np.ndarray, n: np.ndarray, right: np.ndarray) -> PiiModel:
        """From how many held-back spans of a kind are at a place, and how many of them are right."""
        z = place / GRID
        self.knots, self.values = isotonic(z, right / n, n.astype("float64"))
        p = np.interp(z, self.knots, self.values)
        for i, name in enumerate(KINDS):
            scores, at = np.unique(-p[kind == i], return_inverse=True)
            share = np.cumsum(np.bincount(at, right[kind == i], len(scores))) / np.cumsum(np.bincount(at, n[kind == i], len(scores)))
            good = np.flatnonzero(share >= PRECISION)
            below = -np.append(scores, 0.0)
            self.thresholds[name] = max(0.5, float(below[good[-1] : good[-1] + 2].mean())) if len(good) else 2.0
        return self


def untaught() -> PiiModel:
    return PiiModel(Trees(), np.zeros(1), np.zeros(1), dict.fromkeys(KINDS, 2.0))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 5) -> PiiModel:
    """From labelled spans in memory."""
    if not len(y) or y.min() == y.max():
        return untaught()
    back = np.random.default_rng(seed).random(len(y)) < 0.3
    if not back.any() or back.all() or y[~back].min() == y[~back].max():
        back = np.zeros(len(y), bool)
    held = back if back.any() else ~back
    model = PiiModel(Trees().fit(x[~back], y[~back]), np.zeros(1), np.zeros(1), {})
    for i in range(len(KINDS)):
        if len(mine := x[x[:, 0] == i]) and len(true := x[(x[:, 0] == i) & (y > 0)]):
            model.low[i], model.high[i], model.usual[i] = mine.min(axis=0), mine.max(axis=0), np.median(true, axis=0)
    return model.calibrate(x[held, 0], model.place(x[held]), np.ones(held.sum(), "int64"), y[held])


def described_in(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, N_FEATURES)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of bins, labels and counts; some ``BLOCK`` of them become one row of numbers behind each other."""
    held: list[pa.RecordBatch] = []
    for b in itertools.chain(batches, [None]):
        held += [b] if b else []
        if (size := sum(x.num_rows for x in held)) >= BLOCK or (b is None and size):
            bins = np.frombuffer(b"".join(r for x in held for r in x.column(0).to_pylist()), "uint8").reshape(-1, N_FEATURES).T
            y, n = (np.concatenate([x.column(k).to_numpy() for x in held]).astype("int64") for k in (1, 2))
            yield pa.RecordBatch.from_arrays([pa.array([size]), *(pa.array([v.tobytes()], pa.binary()) for v in (bins, y, n))], ["size", "bins", "y", "n"])
            held = []


def split_sums(blocks: DataFrame) -> Sums:
    """Of packed rows of bins. Sums are of whole numbers, so they are the same wherever they are taken."""

    def block(row: dict) -> Binned:
        return Binned(np.frombuffer(row["bins"], "uint8").reshape(N_FEATURES, -1), np.frombuffer(row["y"], "int64"), np.frombuffer(row["n"], "int64"))

    if blocks.agg(F.sum("size")).first()[0] <= FEW_ROWS:
        few = [block(r) for r in blocks.collect()]
        return Binned(np.concatenate([b.bins for b in few], axis=1), np.concatenate([b.y for b in few]), np.concatenate([b.n for b in few])).sums

    def sums(trees: Trees, feature: np.ndarray, threshold: np.ndarray, level: int) -> np.ndarray:
        shape = (2, 2**level, N_FEATURES, CUTS)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape, "int64")
            for r in (r for b in batches for r in b.to_pylist()):
                total += block(r).sums(trees, feature, threshold, level)
            g, h = total.reshape(2, -1)
            cells = np.flatnonzero(h | g)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (cells, g[cells], h[cells])], ["cell", "g", "h"])

        out = np.zeros((2, math.prod(shape[1:])), "int64")
        for r in blocks.mapInArrow(add, "cell long, g long, h long").groupBy("cell").agg(F.sum("g"), F.sum("h")).collect():  # at most a row per node, feature and bin
            out[:, r[0]] = r[1:]
        return out.reshape(shape)

    return sums


def fit_spans(spans: DataFrame) -> PiiModel:
    """From all labelled ``spans``: what describes one (x), its label (y), whether it is held back, and how often that occurs (n)."""
    forms = cut(spans.groupBy("x", "y", "held").agg(F.sum("n").alias("n")), "spans")
    found = {(r["held"], r["y"]): r["n"] for r in forms.groupBy("held", "y").agg(F.sum("n").alias("n")).collect()}
    if len({y for _, y in found}) < 2:
        return untaught()
    apart = {(False, 0), (False, 1)} <= set(found) and len(found) > 2
    taught, judged = (~F.col("held"), F.col("held")) if apart else (F.lit(True), F.lit(True))
    of = {y: sum(n for (held, label), n in found.items() if label == y and not (apart and held)) for y in (0, 1)}

    values = forms.where(taught).select("n", F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.percentile("v", QUANTILES.tolist(), F.col("n")).alias("at"))
    edges = [np.unique(at) for _, at in sorted(values.collect())]
    kinds = forms.select(F.col("x")[0].alias("kind"), (F.col("n") * F.col("y")).alias("n"), F.posexplode("x").alias("j", "v")).groupBy("kind", "j")
    model = PiiModel(Trees(), np.zeros(1), np.zeros(1), {})
    for kind, j, low, high, usual in kinds.agg(F.min("v"), F.max("v"), F.percentile("v", 0.5, F.col("n"))).collect():
        if usual is not None:  # the kind has true spans
            model.low[kind, j], model.high[kind, j], model.usual[kind, j] = low, high, usual

    def in_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = binned(described_in(b.column(0)), edges)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in bins.T], pa.binary()), b.column(1), b.column(2)], ["bins", "y", "n"])

    rows = forms.where(taught).select("x", "y", "n").mapInArrow(in_bins, "bins binary, y int, n long").groupBy("bins", "y").agg(F.sum("n").alias("n"))
    blocks = cut(rows.mapInArrow(packed, "size long, bins binary, y binary, n binary"), "bins")
    model.trees = Trees().grow(of[1] / (of[0] + of[1]), split_sums(blocks)).unbinned(edges)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = described_in(b.column(0)).astype("float64")
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0].astype("int32")), pa.array(model.place(x)), b.column(1), b.column(2)], ["kind", "at", "y", "n"])

    at = forms.where(judged).select("x", "y", "n").mapInArrow(placed, "kind int, at long, y int, n long")
    at = at.groupBy("kind", "at").agg(F.sum("n"), F.sum(F.col("n") * F.col("y"))).collect()  # at most a row per kind and place on the grid
    return model.calibrate(*np.array(sorted(at), "int64").T)


def fit_pii(docs: DataFrame, max_documents: int | None = None, max_candidates: int | None = None) -> PiiModel:
    """From all rows and spans, or, if a caller asks for less, from the first rows in hash order and so many spans of each."""
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", text_or_empty(docs).alias("text"))

    def labelled(batch: pa.RecordBatch) -> Iterator[tuple[int, list[tuple[list[float], float]]]]:
        """The hash of each text with labelled spans, what describes them, and their labels."""
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            known = checked_matches(text, base_spans(text))
            known += labelled_parts(text, known)
            if known := known if max_candidates is None else drawn(known, max_candidates):
                yield row_hash(i, text), [(described(text, c), y) for c, y in known]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if n := Counter((tuple(map(int, x)), int(y), h % 10 < 3) for h, known in labelled(b) for x, y in known):
                x, y, held = zip(*n, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.int32())), pa.array(y, pa.int32()), pa.array(held), pa.array(list(n.values()), pa.int64())], ["x", "y", "held", "n"])

    if max_documents is None:
        return fit_spans(texts.mapInArrow(counted, "x array<int>, y int, held boolean, n long"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if rows := [(h, [v for x, _ in known for v in x], [y for _, y in known]) for h, known in labelled(b)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())], strict=True)], ["h", "x", "y"])

    ids = docs.select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(max_documents).distinct()
    found = texts.join(F.broadcast(ids), "doc_id").select("doc_id", "text").mapInArrow(measured, "h long, x array<double>, y array<double>")
    found = found.orderBy("h").limit(max_documents).toPandas()  # an id may have any number of rows
    x, y = (np.concatenate(found[c].to_numpy()) if len(found) else np.empty(0) for c in ("x", "y"))
    return fit(x.reshape(-1, N_FEATURES), y)


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def proposed(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Candidates beyond base spans that are not known to be false."""
    more = candidates(text, base)[len(base) :]
    if not more:
        return []
    known = checked_matches(text, base)
    false = {s for s, y in known + labelled_parts(text, known) if not y}
    return [c for c in more if c not in false]


def all_spans(texts: list[str], model: PiiModel) -> list[tuple[list, list]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    more = [(i, c) for i, t in enumerate(texts) for c in proposed(t, base[i])]
    out = [list(b) for b in base]
    if more:
        scores = model.score(np.array([described(texts[i], c) for i, c in more]))
        taken = [disjoint(spans) for spans in out]
        for s, (i, c) in sorted(zip(scores.tolist(), more, strict=True), key=lambda x: (-x[0], x[1])):
            if s >= model.thresholds[c[0]] and free(taken[i], c[1], c[2]):
                out[i].append(c)
                bisect.insort(taken[i], [c[1], c[2]])
    return list(zip(base, out, strict=True))


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted string"


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span (of overlapping ones, all they cover) replaced by its kind in brackets."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join(out) + text[end:]


def find_pii(docs: DataFrame, model: PiiModel, redact: bool = True) -> DataFrame:
    """The rows of ``docs`` as struct ``row``, with counts and digest of base spans, all spans, and the text without them."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded: a few thousand numbers

    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        whole = [t or "" for t in texts]
        for text, (base, spans) in zip(whole, all_spans(whole, held.value), strict=True):
            counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            rows.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), redacted(text, spans) if redact else None))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in FOUND.split(", ")])

    return docs.select(F.struct("*").alias("row"), find(text_or_empty(docs)).alias("at")).select("row", "at.*")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs, fit_pii(docs), redact=False)
    return found.select("row.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
