"""Byte-level BPE against the tiktoken library, and the exact round trip."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import CLASHES, TEXTS, clashing, documents

from lociframe.llm import byte_bpe, registry
from lociframe.llm.windows import windows

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = ["a", "B", "é", "漢", " ", "  ", "\n", "'", "'ll", "'r", "1", "٣", "!", "_", "\x1c", "\x85", "\xa0", "​", "́", "😀", "\t", "<unk>", "▁", "Ā", "s", "t", "\0"]


def library(path):
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tk():
    return library(PATH)


def ids(encoder, text):
    return np.frombuffer(encoder.ids(text), byte_bpe.ID).tolist()


def test_ids_equal_the_library(tk):
    encoder, decoder, r = byte_bpe.encoder(PATH, PATTERN), byte_bpe.decoder(PATH), random.Random(5)
    for _ in range(5000):
        text = "".join(r.choices(ODD, k=r.randint(0, 30)))
        assert ids(encoder, text) == tk.encode_ordinary(text), repr(text)
        assert decoder.text(encoder.ids(text)) == text.encode()


def test_windows_do_not_change_ids(tk, monkeypatch):
    encoder, r = byte_bpe.encoder(PATH, PATTERN), random.Random(6)
    for size in (1, 2, 7):
        monkeypatch.setattr(byte_bpe, "windows", lambda t, size=size: windows(t, size))
        for _ in range(1500):
            text = "".join(r.choices(ODD, k=r.randint(0, 40)))
            assert "".join(windows(text, size)) == text
            assert ids(encoder, text) == tk.encode_ordinary(text), repr(text)


def test_memo_is_bounded(tk, monkeypatch):
    encoder = byte_bpe.Encoder(PATH, PATTERN)
    monkeypatch.setattr(byte_bpe, "MEMO_WORDS", 50)
    for at in range(40):
        text = " ".join(f"w{at}x{k}" for k in range(20)) + " " + "long" * 40
        assert ids(encoder, text) == tk.encode_ordinary(text)
        assert len(encoder.memo) <= 50 + 41 and all(len(w) <= byte_bpe.MEMO_CHARS for w in encoder.memo)


def test_entries_that_no_merge_reaches(tmp_path):
    entries = [bytes([b]) for b in range(256)] + [b"bc", b"abc", b"abcd", b" xyz", b"ab"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(e) + b" %d\n" % i for i, e in enumerate(entries)))
    encoder, tk = byte_bpe.Encoder(str(path), PATTERN), library(str(path))
    assert encoder.unreached
    for text in ("abc", "abcd", "abcde xyz", " xyz xyza xyz", "ab bc abab", "dabcd"):
        assert ids(encoder, text) == tk.encode_ordinary(text)


def test_ranks_are_checked(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(bytes([b])) + b" %d\n" % b for b in range(255)))
    with pytest.raises(ValueError):
        byte_bpe.read_ranks(str(path))


def test_tables(spark, tk):
    docs = clashing(documents(spark, [*TEXTS, (10, "no spaces" * 50_000), (11, "x" * 100_000)]))
    encoded = byte_bpe.encode(docs, PATH, PATTERN)
    assert [*encoded.columns] == [*(c for c in docs.columns if c != "text"), "token_ids"] and set(CLASHES) <= set(encoded.columns)
    got = byte_bpe.decode(encoded.withColumn("kept_ids", encoded["token_ids"]), PATH).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"])
    want = sorted([*TEXTS, (10, "no spaces" * 50_000), (11, "x" * 100_000)], key=lambda x: (x[0] is None, x[0] or 0, len(x[1] or "")))
    for row, (i, text) in zip(sorted(got, key=key), want, strict=True):
        assert row["doc_id"] == i and bytes(row["decoded"]) == (text or "").encode()
        assert np.frombuffer(row["kept_ids"], "<u4").tolist() == tk.encode_ordinary(text or "")
    assert byte_bpe.decode(byte_bpe.encode(documents(spark, []), PATH, PATTERN), PATH).count() == 0


def test_query(spark, small, tk):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in registry.QUERIES["op13_byte_bpe"](spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = tk.encode_ordinary(d["text"] or "")
        assert got[d["doc_id"]] == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest(), hashlib.sha256((d["text"] or "").encode()).hexdigest())
