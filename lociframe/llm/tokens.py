"""Token ids by the tokenizers library, with a memo of the words that texts are made of.

A batch of texts is handled in slices of bounded length. A slice is cut into words and joined to the memo as Arrow arrays; only
words that the memo lacks go to the library, each of them once, and the ids of all texts are gathered at the end. The memo holds
at most ``MEMO_WORDS`` words of at most ``MEMO_CHARS`` characters in flat arrays, so its size in bytes is bounded; the words met least go first.
A worker serves task after task, and its allocators keep what was freed; before and after each slice, also at a task's begin, they return it.
"""

from __future__ import annotations

import ctypes
import os
import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Where white space stands alone, no token and no rule of these vocabularies reaches over the end of a word, so a text's
#: ids are those of its words, each with the white space before it. Other texts are encoded whole.
TWO_SPACES = r"[\t-\r\x1c-\x1f \x{85}\p{Z}]{2}"
MEMO_WORDS, MEMO_CHARS, SLICE_CHARS, JOINED = 600_000, 32, 1 << 21, 1000
#: Both vocabularies cut between letters and a run of these, which is a token's piece of its own (an apostrophe is not).
MARKS = string.punctuation.replace("'", "")
ID = np.dtype("<u4")


#: Letters in one composed form whose lower case is one letter each, in every edition of Unicode.
LETTERS = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}\x{391}-\x{3A1}\x{3A3}-\x{3A9}\x{3B1}-\x{3C9}\x{410}-\x{44F}]+$"


def run_places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places in runs of these starts and lengths, one run behind the other."""
    ends = np.cumsum(lengths)
    places = np.repeat(starts - ends + lengths, lengths)
    places += np.arange(len(places))
    return places


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return values[run_places(starts, lengths)]


def strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist


def distinct(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    found = words.dictionary_encode()
    return found.dictionary, found.indices.to_numpy()


@dataclass
class Runs:
    """Runs of ids, one behind the other."""

    ids: np.ndarray
    lengths: np.ndarray

    @staticmethod
    def of(runs: list[np.ndarray]) -> Runs:
        return Runs(np.concatenate([np.zeros(0, ID), *runs]), np.array([len(x) for x in runs], "int64"))

    @staticmethod
    def joined(parts: list[Runs]) -> Runs:
        return Runs(np.concatenate([np.zeros(0, ID), *(x.ids for x in parts)]), np.concatenate([np.zeros(0, "int64"), *(x.lengths for x in parts)]))

    def take(self, at: np.ndarray) -> Runs:
        lengths = self.lengths[at]
        return Runs(gathered(self.ids, (np.cumsum(self.lengths) - self.lengths)[at], lengths), lengths)


class Encoder:
    """``batch(texts)`` gives the ids of ``Tokenizer.encode(text, add_special_tokens=False)`` and the end id behind them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends = bool(suffix)  # else a word begins with a blank
        self.line = " " if self.ends else " \n"  # with word ends, white space leaves no trace
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for t, i in vocabulary.items() if (t.endswith(suffix) if suffix else t.startswith("Ġ"))]] = True
        self.memo, self.met, self.runs = pa.array([], pa.string()), np.zeros(0, "int64"), Runs.of([])
        self.hashes, self.places = np.zeros(0, "int64"), np.zeros(0, "int64")  # in order of the hash

    def whole(self, texts: list[str]) -> Runs:
        return Runs.of([np.array(e.ids, ID) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def words(self, words: pa.Array) -> Runs:
        """Words of letters only, as they are behind a blank: one call for many, cut at the words' edge tokens."""
        out = []
        for at in range(0, len(words), JOINED):
            part = words.slice(at, JOINED)
            ids = self.whole([" " + " ".join(strings(part))]).ids
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) != len(part):
                out.append(self.whole([" " + w for w in strings(part)]))
            else:
                out.append(Runs(ids, np.diff(np.r_[0, edges + 1] if self.ends else np.r_[edges, len(ids)])))
        return Runs.joined(out)

    def unseen(self, words: pa.Array) -> Runs:
        """Distinct words behind a blank, or behind the line end that they begin with."""
        letters = pc.utf8_rtrim(words, MARKS)
        plain = pc.match_substring_regex(letters, LETTERS).to_numpy(zero_copy_only=False)
        at, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        stems, stem = distinct(letters.take(pa.array(at)))
        ends = [w[n:] for w, n in zip(strings(words.take(pa.array(at))), pc.utf8_length(letters.take(pa.array(at))).to_pylist(), strict=True)]
        marks, mark = distinct(pa.array(ends, pa.string()))
        others = self.whole([w if w[:1] == "\n" else " " + w for w in strings(words.take(pa.array(rest)))])
        parts = Runs.joined([self.words(stems), self.whole(strings(marks)), others, Runs.of([np.zeros(0, ID)])])
        code = np.full((len(words), 2), len(parts.lengths) - 1)  # the last is empty
        code[at, 0], code[at, 1], code[rest, 0] = stem, len(stems) + mark, len(stems) + len(marks) + np.arange(len(rest))
        lengths = parts.lengths[code]
        return Runs(parts.take(code.reshape(-1)).ids, lengths.sum(axis=1))

    def _known(self, words: list[str], column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each word's hash, and its place in the memo or -1: found by the hash, held to the word itself."""
        hashes = np.fromiter(map(hash, words), "int64", len(words))
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        if not len(self.hashes):
            return hashes, np.full(len(words), -1)
        place = self.places[at]
        same = pc.equal(self.memo.take(pa.array(place)), column).to_numpy(zero_copy_only=False)
        return hashes, np.where(same, place, -1)

    def _remember(self, words: pa.Array, hashes: np.ndarray, found: Runs, met: np.ndarray) -> None:
        short = np.flatnonzero(pc.utf8_length(words).to_numpy() <= MEMO_CHARS)
        _, once = np.unique(hashes[short], return_index=True)
        short = short[once]  # in order of the hash
        at = np.searchsorted(self.hashes, hashes[short])
        new = (at == len(self.hashes)) | (self.hashes[np.minimum(at, len(self.hashes) - 1)] != hashes[short]) if len(self.hashes) else np.ones(len(short), bool)
        short, at = short[new], at[new]
        self.places = np.insert(self.places, at, len(self.memo) + np.arange(len(short)))
        self.hashes = np.insert(self.hashes, at, hashes[short])
        self.memo = pa.concat_arrays([self.memo, words.take(pa.array(short))])
        self.met = np.r_[self.met, met[short]]
        self.runs = Runs.joined([self.runs, found.take(short)])
        if len(self.memo) > MEMO_WORDS:
            kept = np.zeros(len(self.memo), bool)
            kept[np.argsort(-self.met, kind="stable")[: MEMO_WORDS * 2 // 3]] = True
            stays = kept[self.places]
            self.hashes = self.hashes[stays]  # one after the other, each old one goes before the next is made
            self.places = (np.cumsum(kept) - 1)[self.places[stays]]
            self.memo = self.memo.filter(pa.array(kept))
            self.met = self.met[kept] // 2
            self.runs = self.runs.take(np.flatnonzero(kept))

    def _plain(self, texts: pa.Array, end_id: int) -> list[np.ndarray]:
        """Texts in which white space stands alone."""
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", self.line), " ")
        offsets, flat = parts.offsets.to_numpy().astype("int64"), parts.values
        offsets, flat = offsets - offsets[0], flat.slice(offsets[0], offsets[-1] - offsets[0])
        first = offsets[:-1]
        words, at = distinct(flat)
        firsts = self.whole(strings(flat.take(pa.array(first))))
        del parts, flat
        hashes, place = self._known(strings(words), words)
        held, missing = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        new = words.take(pa.array(missing))
        found = self.unseen(new)
        # of the memo, only the words of these texts are copied
        all_runs = Runs.joined([self.runs.take(place[held]), found, firsts, Runs.of([np.array([end_id], ID)])])
        met = np.bincount(at, minlength=len(words))
        self.met[place[held]] += met[held]
        place[np.r_[held, missing]] = np.arange(len(words))
        code = place[at]
        code[first] = len(words) + np.arange(len(first))
        out = all_runs.take(np.insert(code, offsets[1:], len(words) + len(first)))
        del all_runs, code, place, at
        self._remember(new, hashes[missing], found, met[missing])
        ends = np.cumsum(out.lengths)[offsets[1:] + np.arange(len(first))]
        return np.split(out.ids, ends[:-1])

    def batch(self, texts: pa.Array, end_id: int) -> list[np.ndarray]:
        alone = pc.match_substring_regex(texts, TWO_SPACES)
        for token in self.special:
            alone = pc.or_(alone, pc.match_substring(texts, token))
        out: list[np.ndarray | None] = [None] * len(texts)
        at = np.flatnonzero(alone.to_numpy(zero_copy_only=False))
        found = self.whole(strings(texts.take(pa.array(at))))
        for i, ids in zip(at, np.split(found.ids, np.cumsum(found.lengths)[:-1]) if len(at) else [], strict=True):
            out[i] = np.append(ids, ID.type(end_id))
        rest = np.flatnonzero(~alone.to_numpy(zero_copy_only=False))
        if len(rest):
            for i, ids in zip(rest, self._plain(texts.take(pa.array(rest)), end_id), strict=True):
                out[i] = ids
        return out


#: One for each vocabulary and worker process: later tasks find the words of earlier ones.
encoder = lru_cache(maxsize=1)(Encoder)


def give_back() -> None:
    """Returns the memory that is free in this process to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[pa.RecordBatch]:
    """Smaller batches: texts of at most ``SLICE_CHARS`` bytes together, or a single longer one."""
    give_back()  # what tasks of other kinds left
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy()
        edges = np.cumsum(sizes.astype("int64"))
        at = 0
        while at < b.num_rows:
            before = edges[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(edges, before + SLICE_CHARS, "right")))
            yield b.slice(at, to - at)
            give_back()
            at = to


def encoded(path: str, texts: pa.Array, end_id: int) -> list[np.ndarray]:
    """The ids of each text with the end id behind them."""
    return encoder(path).batch(texts, end_id)
