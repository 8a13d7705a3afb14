"""Byte-level BPE by a sentencepiece model that is serialised directly from a rank file; decoding by the inverse mapping.

* Each byte is written as the letter ``chr(256 + byte)``, so a vocabulary entry of any bytes is a piece of text. The model holds one
  piece per rank, at the id of the rank and with the score ``-rank``, an unknown piece behind them, type BPE, and an identity
  normaliser that touches no white space. Its merges then are those of the ranks: best score first, of equal ones the leftmost.
* A text is cut by the pattern of the vocabulary; each match is encoded on its own. Matches that a memo of bounded size lacks go to
  the model, each once. An entry that its own merges do not reach is its id when a match is all of it: the model is asked for every entry
  once, and the ids of those that it splits are kept beside it.
* Long texts are cut and encoded in windows that end between a visible character and a space, where every match ends.
* ``decode`` looks up each id's piece in the model and maps its letters back to bytes.

Null and empty texts have no ids and decode to no bytes. Rows, ids and texts may repeat. All other columns are kept as they are, save that ``token_ids``
and ``decoded`` are replaced; an empty table gives an empty result. A null ``token_ids`` decodes to no bytes, and an id outside the
vocabulary, or bytes that are no whole ids, raise an error.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table, text_or_empty
from .windows import windows

#: White space as the pattern's own library reads it: the separators U+001C to U+001F are none.
SPACE = r"[\t-\r \x85\p{Z}]"
MEMO_WORDS, MEMO_CHARS = 300_000, 64
ID = np.dtype("<u4")
#: Fixed values of the model's format: kinds of pieces, the type of model, field numbers.
NORMAL, UNKNOWN, BPE = 1, 2, 2
PIECES, TRAINER, NORMALIZER = 1, 2, 3


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file by their ids, which must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        found = {int(rank): base64.b64decode(entry) for entry, rank in (line.split() for line in f if line.strip())}
    entries = [found[i] for i in sorted(found)]
    if sorted(found) != list(range(len(found))) or len(set(entries)) < len(entries) or not {bytes([b]) for b in range(256)} <= set(entries):
        raise ValueError(f"{path}: ranks must be without gaps, entries unequal, and each byte one of them")
    return entries


def letters(entry: bytes) -> str:
    return (np.frombuffer(entry, np.uint8) + np.uint16(256)).astype("<u2").tobytes().decode("utf-16-le")


def entry_of(piece: str) -> bytes:
    return (np.frombuffer(piece.encode("utf-16-le"), "<u2") - 256).astype(np.uint8).tobytes()


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _message(field: int, said: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(said)) + said


def serialised(entries: list[bytes]) -> bytes:
    """The model as sentencepiece stores it: one piece per entry, then the unknown piece that the format asks for."""

    def piece(text: str, score: float, kind: int) -> bytes:
        return _message(PIECES, _message(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    n = len(entries)
    trainer = _number(3, BPE) + _number(4, n + 1) + _number(40, n)
    normalizer = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(piece(letters(e), -rank, NORMAL) for rank, e in enumerate(entries)) + piece("<unk>", 0, UNKNOWN) + _message(TRAINER, trainer) + _message(NORMALIZER, normalizer)


class Encoder:
    def __init__(self, path: str, pattern: str):
        entries = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised(entries))
        self.pattern = regex.compile(pattern.replace(r"[^\s", rf"[^{SPACE[1:-1]}").replace(r"\s", SPACE).replace(r"\S", f"[^{SPACE[1:]}"))
        self.unreached = {e: i for i, (e, ids) in enumerate(zip(entries, self._merged(entries), strict=True)) if ids != [i]}
        self.memo: dict[str, bytes] = {}

    def _merged(self, entries: list[bytes]) -> list[list[int]]:
        spelled = letters(b"".join(entries))
        return self.model.encode([spelled[a:b] for a, b in pairwise(accumulate(map(len, entries), initial=0))], num_threads=1)

    def ids(self, text: str) -> bytes:
        """All ids of a text, 32 bits each."""
        parts = []
        for window in windows(text):
            words = self.pattern.findall(window)
            if new := list(set(words).difference(self.memo)):
                if len(self.memo) + len(new) > MEMO_WORDS:
                    self.memo = {}
                    new = list(set(words))
                spelled = [w.encode("utf-8", "surrogatepass") for w in new]
                found = [[self.unreached[e]] if e in self.unreached else ids for e, ids in zip(spelled, self._merged(spelled), strict=True)]
                flat = np.array(list(chain.from_iterable(found)), ID).tobytes()
                self.memo.update((w, flat[a:b]) for w, (a, b) in zip(new, pairwise(accumulate((ID.itemsize * len(x) for x in found), initial=0)), strict=True))
            parts.append(b"".join(map(self.memo.__getitem__, words)))
            for w in new:
                if len(w) > MEMO_CHARS:
                    del self.memo[w]
        return b"".join(parts)


class Decoder:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_proto=serialised(read_ranks(path)))
        self.entries = [entry_of(p) for p in model.id_to_piece(list(range(model.get_piece_size() - 1)))]

    def text(self, ids: bytes) -> bytes:
        return b"".join(map(self.entries.__getitem__, np.frombuffer(ids, ID).tolist()))


@lru_cache(2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _with_column(df: DataFrame, source: str, name: str, made) -> DataFrame:
    """``df`` with the binary column ``name``: ``made()`` gives, on an executor, the function of the values of ``source``."""
    kept = [c for c in df.columns if c not in (source, name)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = made()
        for b in batches:
            column = pa.array([value(x) for x in b.column(len(kept)).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], column], [*kept, name])

    small_batches(df.sparkSession)
    return df.select(*[F.col(f"`{c}`") for c in kept], source).mapInArrow(add, T.StructType([*df.select(*[F.col(f"`{c}`") for c in kept]).schema.fields, T.StructField(name, T.BinaryType(), False)]))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``token_ids``, little-endian unsigned 32-bit integers, in the place of ``text``."""
    return _with_column(docs.withColumn("text", text_or_empty(docs)), "text", "token_ids", lambda: encoder(path, pattern).ids)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of the text, in the place of ``token_ids``."""
    return _with_column(encoded, "token_ids", "decoded", lambda: lambda ids: decoder(path).text(ids or b""))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    told = encode(docs, path, public_tokenizers.PATTERN).withColumn("n_tokens", F.expr("octet_length(token_ids) div 4")).withColumn("ids_sha256", F.sha2("token_ids", 256))
    return decode(told, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
