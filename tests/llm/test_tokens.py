"""Packing and token files."""

import random
import re
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import clashing, documents
from tokenizers import Tokenizer

from lociframe.llm import packing, token_files, tokens

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@lru_cache
def tokenizer(path):
    return Tokenizer.from_file(path)


def ids(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


ODD = ["a", "B", "é", "ß", "Σ", "ς", "İ", "SENİ", "ı", "Ǆ", "1", "²", ",", ".", "!", "'s", "'", "\n", " ", " ", "  ", "\t", "\x1c", "漢", "\u0307", "क\u093c", "\u0958", "<|endoftext|>", "<|startoftext|>", "<|", "don't", "ﬁ", "\u212a", "\x85", "\u3000", "ж", "_", "🙂", "\u200d", "ª"]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_memo_gives_the_library_ids(path):
    rng = random.Random(0)
    texts = ["".join(rng.choices(ODD, k=rng.randrange(30))) for _ in range(3000)] + ["", " ", "\n", "w" * 100 + " " + "v" * 99 + ",,"]
    texts += ["".join(rng.choice([chr(rng.randrange(0x250)), chr(rng.randrange(0x3000)), chr(rng.randrange(0xD7FF)), " ", "a", ","]) for _ in range(rng.randrange(20))) for _ in range(2000)]
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        for text, got in zip(part, tokens.encoded(path, pa.array(part), 7), strict=True):
            assert got.tolist() == [*ids(path, text), 7], repr(text)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_special_tokens_and_letters_that_grow(path):
    texts = ["Merkezi SENİ, geldi", "a SENİ. b", "ANKARA TÜRKİ!", "see <|endoftext|> here", "<|endoftext|>", "x<|startoftext|>, y"]
    for text, got in zip(texts, tokens.encoded(path, pa.array(texts), 3), strict=True):
        assert got.tolist() == [*ids(path, text), 3]


def test_memo_evicts(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_WORDS", 5)
    e = tokens.Encoder(BYTE)
    for _ in range(3):
        for text in ("a b c d e f g", "a b h i j k l m", "a b", "a a a b " + "x" * 50):
            assert e.batch(pa.array([text]), 0)[0].tolist() == [*ids(BYTE, text), 0]
    assert len(e.memo) <= 5 == len({*"abcde"}) and len(e.memo) == len(e.met) == len(e.runs.lengths) == len(e.hashes) == len(e.places)


def test_slices_bound_their_texts(monkeypatch):
    monkeypatch.setattr(tokens, "SLICE_CHARS", 10)
    b = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4, 5]), pa.array(["x" * 6, "y" * 4, "z" * 30, "", "v"])], ["doc_id", "text"])
    assert [x.column(0).to_pylist() for x in tokens.slices(iter([b]))] == [[1, 2], [3], [4, 5]]


def resident_mb():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nAnonymous:\s+(\d+)", f.read())[1]) / 1024


def test_slices_give_back_what_was_freed():
    left = [bytes(4000) for _ in range(20_000)]  # as an earlier task's
    last = left.pop()  # it holds the end of the heap, so the allocator keeps the rest
    del left
    before = resident_mb()
    b = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a b", "c"])], ["doc_id", "text"])
    assert [x.num_rows for x in tokens.slices(iter([b]))] == [2]
    assert resident_mb() < before - 40, len(last)


def test_words_of_the_memo_are_copied_only_as_texts_need_them(monkeypatch):
    e = tokens.Encoder(BYTE)
    e.batch(pa.array([" ".join(f"w{i}x" for i in range(3000))]), 0)
    most, joined = [], tokens.Runs.joined
    monkeypatch.setattr(tokens.Runs, "joined", staticmethod(lambda parts: most.append(len((x := joined(parts)).lengths)) or x))
    monkeypatch.setattr(e, "_remember", lambda *_: None)
    text = "a w7x b w7x w2999x, new"
    assert e.batch(pa.array([text]), 0)[0].tolist() == [*ids(BYTE, text), 0] and max(most) < 20


def check_packed(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_edge_cases(spark):
    docs = clashing(documents(spark))
    got = packing.pack(docs, BYTE).collect()
    check_packed(got, 2048)
    want = []
    for r in docs.collect():
        x = np.array([*ids(BYTE, r["text"]), 0], "<u4")
        first = len(x) % 2048 or 2048
        cuts = [0, *range(first, len(x) + 1, 2048)]
        want += [(r["doc_id"], i, a, b - a, zlib.crc32(x[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=repr) == sorted(want, key=repr)
    assert packing.pack(docs.limit(0), BYTE).isEmpty()


def test_plan_is_near_the_bound():
    rng = random.Random(1)
    for capacity in (7, 30, 2048):
        for _ in range(20):
            counts = {}
            for _ in range(rng.randrange(1, 400)):
                x = rng.randint(1, capacity) if rng.random() < 0.5 else rng.randint(1, max(1, capacity // 4))
                counts[x] = counts.get(x, 0) + rng.choice([1, 1, 5])
            placed, fill = {}, {}
            for length, first, count, each, sequence, offset in packing.plan(counts, capacity):
                for j in range(count):
                    assert (length, first + j) not in placed
                    placed[length, first + j] = sequence + j // each
                    fill.setdefault(sequence + j // each, []).append((offset + j % each * length, length))
            assert len(placed) == sum(counts.values()) and {k[0]: 0 for k in placed}.keys() == counts.keys()
            for parts in fill.values():
                at = 0
                for offset, length in sorted(parts):
                    assert offset == at
                    at += length
                assert at <= capacity
            large = sum(n for x, n in counts.items() if 2 * x > capacity)
            bound = max(large, -(-sum(x * n for x, n in counts.items()) // capacity))
            assert len(fill) <= bound * 11 / 9 + 1


def test_sequences_hold_the_ids(spark):
    docs = documents(spark, [(i, "some words here " * (1 + i * 7 % 40)) for i in range(40)])
    placed = packing.pack(docs, BYTE, 128)
    by = {r["sequence_id"]: r for r in packing.sequences(docs, placed, BYTE, 128).collect()}
    whole = {r["doc_id"]: [*ids(BYTE, r["text"]), 0] for r in docs.collect()}
    for p in placed.collect():
        assert by[p["sequence_id"]]["input_ids"][p["offset"] : p["offset"] + p["length"]] == whole[p["doc_id"]][p["start"] : p["start"] + p["length"]]
    assert all(len(r["input_ids"]) == len(r["segment"]) <= 128 for r in by.values())


def test_token_files_round_trip(spark, tmp_path):
    docs = clashing(documents(spark))
    folder = f"file://{tmp_path}/t"
    manifest = token_files.write_token_files(docs, folder, WORD, length=16)
    got = sorted(((r["start"], r["n_tokens"], r["doc_id"], r["ids_crc32"]) for r in token_files.read_token_files(manifest, folder).collect()), key=lambda x: x[0])
    want, at = [], 0
    for r in sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "")):
        x = np.array([*ids(WORD, r["text"]), 2], "<u4")
        want.append((at, len(x), r["doc_id"], zlib.crc32(x.tobytes())))
        at += len(x)
    assert got == want
    shard = max(manifest.collect(), key=lambda r: r["n_ids"])
    file = token_files.TokenFile(folder, shard["file"])
    rows = -(-shard["n_ids"] // 16)
    sequence, mask = zip(*(file.sequence(i) for i in range(rows)), strict=True)
    assert sum(m.sum() for m in mask) == shard["n_ids"] and all(len(s) == 16 for s in sequence)
    flat = np.concatenate(sequence)[: shard["n_ids"]]
    assert np.array_equal(flat, np.concatenate([x for _, _, x in file.documents()]))
    assert not file.sequence(0)[0].flags.owndata  # a view of the mapped file


def test_token_files_of_an_empty_table(spark, tmp_path):
    manifest = token_files.write_token_files(documents(spark).limit(0), str(tmp_path / "e"), WORD)
    assert manifest.isEmpty() and token_files.read_token_files(manifest, str(tmp_path / "e")).isEmpty()
