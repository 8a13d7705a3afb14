"""Spelling variant grouping by rolling-hash deletions.

1. Words and their counts: tasks count in dictionaries of bounded size, so that a word of any frequency reaches the shuffle pre-aggregated.
2. A word of L letters has L + 1 keys: the hash of the whole word, and for each place that of the word without the letter there.
   A word's keys come from its prefix and suffix polynomial hashes (modulo 2^64, letters spread over 64 bits first), all places of
   all words of one length at once in NumPy: ``prefix * BASE^rest + suffix``. Two words one replacement apart share the key of that place; where a letter is inserted, the
   longer word's key there is the shorter one's whole key. Keys travel with a word's number and the place, 20 bytes a row whatever the word's length.
3. Rows are radix-partitioned by the first bits of the key and sorted by it within a partition; only rows with an equal key beside them stay.
4. Those rows get their word, and the word without the letter, a string, takes the place of the key: unequal strings with one hash
   part here. Words without the same place's letter are a replacement group: as many as there are letters, at most. Groups are counted and their two first words kept; no
   pairs are made. A longer word meets the shorter one it contains; in a run of one letter the first place alone counts, so no link is met twice.
5. Forms are followed to the last by doubling: each form has at least ``RATIO`` times its word's count, so a chain has at most 62 steps.

Words may have any length. Null and empty texts have no words; repeated rows count again, and rows with one doc_id are changed alike, a null doc_id being written as nothing before the colon. Ties go
to the smallest word in code-point order. Without words the result is empty. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, small_batches, table, tasks, text_or_empty
from .windows import windows

RUN = re.compile("[a-zÀ-ÿ]+")
MIN_LETTERS, MIN_COUNT, MODULUS, RATIO = 5, 3, 97, 2
HELD = 300_000
BASE, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Letters of words whose keys are made at once.
BLOCK = 1 << 18
WHOLE = -1


def lower_ascii(text: str) -> str:
    """A-Z in lower case; ``bytes.lower`` touches ASCII letters only."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def word_in(run: str, crc: int, modulus: int = MODULUS) -> str:
    """The run itself, or without the letter that ``crc`` points at, if ``modulus`` divides it."""
    return run[: (at := crc % len(run))] + run[at + 1 :] if crc % modulus == 0 else run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> (word, n): a document's runs are counted first, so that each of them is hashed once."""
    held: Counter = Counter()
    size = 0

    def emitted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for b in batches:
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            head = zlib.crc32(f"{'' if i is None else i}:".encode())
            for window in windows(text):
                for run, n in Counter(RUN.findall(lower_ascii(window))).items():
                    if len(word := word_in(run, zlib.crc32(run.encode(), head))) >= MIN_LETTERS:
                        held[word] += n
                        size += len(word) >> 6
            if len(held) + size > HELD:
                yield emitted()
                held, size = Counter(), 0
    if held:
        yield emitted()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n, wid) for words of at least ``MIN_LETTERS`` letters and ``MIN_COUNT`` occurrences; wid is any number of its own."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty(docs).alias("text"))
    counts = rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)
    return cut(counts.withColumn("wid", F.monotonically_increasing_id()), "words")


def deletion_keys(words: list[str]) -> np.ndarray:
    """Keys of words of one length, a row each: column i without letter i, and the whole word last."""
    n, length = len(words), len(words[0])
    with np.errstate(over="ignore"):
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(n, length).astype(np.uint64) + np.uint64(1)
        codes *= SPREAD
        codes ^= codes >> np.uint64(32)
        powers = np.ones(length + 1, np.uint64)
        powers[1:] = np.multiply.accumulate(np.full(length, BASE, np.uint64))
        # prefix[i]: hash of the i first letters; suffix[i]: of those from i on. As prefix[i + 1] = prefix[i] * BASE + letter,
        # prefix[i] * BASE^(length - i) is a running sum of letters times their power.
        places = codes * powers[length - 1 :: -1]
        ahead = np.zeros((n, length + 1), np.uint64)
        np.cumsum(places, axis=1, out=ahead[:, 1:])
        suffix = ahead[:, -1:] - ahead
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        keys = np.empty((n, length + 1), np.uint64)
        keys[:, :length] = ahead[:, :length] * inverse + suffix[:, 1:]
        keys[:, length] = ahead[:, length]
    return keys


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, wid) -> (key, place, wid), a row for each key."""
    for b in batches:
        by_length: dict[int, list[int]] = {}
        words, ids = b.column(0).to_pylist(), b.column(1).to_numpy()
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for length, rows in by_length.items():
            step = max(1, BLOCK // length)
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                keys = deletion_keys([words[i] for i in part])
                places = np.tile(np.append(np.arange(length, dtype=np.int32), np.int32(WHOLE)), len(part))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(places), pa.array(np.repeat(ids[part], length + 1))], ["key", "place", "wid"])


def _beside_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those with the key of the row before or behind them. The last row of a batch waits for the next one."""
    last, last_equal = None, False
    for b in batches:
        if not b.num_rows:
            continue
        rows = b if last is None else pa.Table.from_batches([last, b]).combine_chunks().to_batches()[0]
        keys = rows.column(0).to_numpy()
        equal = keys[1:] == keys[:-1]
        before, behind = np.append(last_equal, equal), np.append(equal, False)
        stay = before | behind
        last, last_equal = rows.slice(len(keys) - 1), bool(before[-1])
        if stay[:-1].any():
            yield rows.slice(0, len(keys) - 1).filter(pa.array(stay[:-1]))
    if last is not None and last_equal:
        yield last


def candidates(words: DataFrame, bits: int | None = None) -> DataFrame:
    """(wid, place) of words that share a deletion key with another word, by radix partitions of the first ``bits`` of keys."""
    spark = words.sparkSession
    bits = (tasks(spark) - 1).bit_length() if bits is None else bits
    keys = words.select("word", "wid").repartition(tasks(spark)).mapInArrow(_keyed, "key long, place int, wid long")
    radix = F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0)
    parts = keys.repartition(1 << bits, radix).sortWithinPartitions("key")
    return parts.mapInArrow(_beside_equal, "key long, place int, wid long").select("wid", "place")


def near_words(words: DataFrame, found: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) for words with near words: how many, and the one of largest count. ``found``: candidates, or any rows that hold them."""
    found = found.join(words, "wid")
    left = F.expr("CASE WHEN place < 0 THEN word ELSE overlay(word PLACING '' FROM place + 1 FOR 1) END")
    first = F.expr("place = 0 OR substr(word, place, 1) <> substr(word, place + 1, 1)")
    found = cut(found.select("word", "n", "place", left.alias("rest"), first.alias("first")), "rests")
    best = Window.partitionBy("rest", "place").orderBy(F.desc("n"), "word")
    whole = best.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    named = F.struct((-F.col("n")).alias("less"), F.col("word").alias("form"))
    replaced = found.where("place >= 0").select("word", F.row_number().over(best).alias("at"), F.count("*").over(whole).alias("size"), F.first(named).over(whole).alias("one"), F.nth_value(named, 2).over(whole).alias("two"))
    replaced = replaced.where("size > 1").select("word", (F.col("size") - 1).alias("links"), F.when(F.col("at") == 1, F.col("two")).otherwise(F.col("one")).alias("best"))
    longer, shorter = found.where("place >= 0 AND first").select("rest", "word", "n"), found.where("place < 0").select("rest", F.col("n").alias("short_n"))
    met = longer.join(shorter, "rest")
    one = F.lit(1).cast("long").alias("links")
    inserted = met.select("word", one, F.struct((-F.col("short_n")).alias("less"), F.col("rest").alias("form")).alias("best"))
    deleted = met.select(F.col("rest").alias("word"), one, named.alias("best"))
    near = replaced.union(inserted).union(deleted).groupBy("word").agg(F.sum("links").alias("n_near"), F.min("best").alias("best"))
    return near.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word that forms lead to, by doubling. Forms must not lead in a circle."""
    held = cut(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = held.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        further = cut(held.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "roots")
        held = further.select("word", "root")
        if further.where("moved").isEmpty():
            return held


def variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    words = word_counts(docs)
    told = words.join(near_words(words, cut(candidates(words), "candidates")), "word", "left")
    holds = F.col("form_n") >= ratio * F.col("n")
    told = cut(told.select("word", F.when(holds, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(holds, F.col("form_n")).alias("form_n")), "told")
    ends = roots(told.where("form IS NOT NULL"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op11_sql() -> str:
    """CRC-32 is folded over bytes by its table of 256 remainders, which one rule gives."""
    return r"""
WITH RECURSIVE steps(i, c, k) AS (
  SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
remainders AS (SELECT list(c ORDER BY i) AS of FROM steps WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
spelled AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes FROM counted),
hashed AS (SELECT run, n, xor(list_reduce(list_transform(range(1, length(bytes), 2), lambda i: ('0x' || substr(bytes, i, 2))::BIGINT), lambda c, b: xor(c >> 8, of[xor(c & 255, b) + 1]), 4294967295), 4294967295) AS h FROM spelled, remainders),
placed AS (SELECT run, n, h, (h % length(run))::INTEGER AS place FROM hashed),
changed AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, place) || substr(run, place + 2) ELSE run END AS word, n FROM placed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
links AS (SELECT DISTINCT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT DISTINCT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
          UNION SELECT DISTINCT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word),
near AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS form, max(n) AS form_n FROM links GROUP BY word),
told AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN near ON near.word = w.word),
followed(word, reached) AS (SELECT word, word FROM told UNION ALL SELECT f.word, t.form FROM followed f JOIN told t ON t.word = f.reached WHERE t.form IS NOT NULL),
ends AS (SELECT f.word, f.reached AS root FROM followed f JOIN told t ON t.word = f.reached WHERE t.form IS NULL)
SELECT told.word, form, root, n, n_near, form_n FROM told JOIN ends ON ends.word = told.word
"""
