"""The JSON header of variant tables: which columns mean what. Text of a few lines, handled on the driver."""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

WIDTH = 200


@dataclass(frozen=True)
class Metadata:
    """Column numbers count from 1; 0 means there is none."""

    column_names: tuple[str, ...] = ()
    individuals: tuple[tuple[str, int], ...] = ()
    scaffold: int = 0
    pos: int = 0
    ref: int = 0
    rPos: int = 0  # noqa: N815  the header's own key
    species: str = "?"
    dbkey: str = "?"
    kegg_gene: int = 0
    kegg_path: int = 0
    extra: dict = field(default_factory=dict)


def parse_header(lines: list[str], columns: int | None = None) -> Metadata:
    """From the leading comment lines. Numbers outside the table are dropped, as is an individual without a column; text that is not JSON raises."""
    text = "".join(x[1:].rstrip("\n") for x in lines if x.startswith("#"))
    try:
        found = json.loads(text) if text.strip() else {}
    except json.JSONDecodeError as error:
        raise ValueError(f"the header is not JSON: {text[:80]}") from error
    found = found if isinstance(found, dict) else {}
    names = tuple(found.get("column_names", ()))
    width = columns or len(names)
    number = lambda k: v if isinstance(v := found.get(k, 0), int) and 0 <= v <= width else 0
    people = tuple((str(n), c) for n, c in found.get("individuals", ()) if isinstance(c, int) and 0 < c <= width)
    known = {k: number(k) for k in ("scaffold", "pos", "ref", "rPos", "kegg_gene", "kegg_path")}
    return Metadata(names, people, **known, species=found.get("species", "?"), dbkey=found.get("dbkey", "?"))


def header_lines(meta: Metadata) -> list[str]:
    """JSON after ``#``, folded at commas outside strings so that no line is longer than ``WIDTH`` characters."""
    keep = {k: v for k, v in asdict(meta).items() if k != "extra" and v not in (0, ())}
    text = json.dumps(keep | meta.extra, separators=(",", ":"), sort_keys=True)
    places, inside, escaped = [], False, False
    for i, c in enumerate(text):
        if escaped:
            escaped = False
        elif c == "\\":
            escaped = True
        elif c == '"':
            inside = not inside
        elif c == "," and not inside:
            places.append(i + 1)
    lines, start, last = [], 0, 0
    for p in [*places, len(text)]:
        if p - start > WIDTH - 1 and last > start:
            lines.append("#" + text[start:last])
            start = last
        last = p
    return [*lines, "#" + text[start:]]


def leading_lines(spark: SparkSession, path: str) -> Iterator[str]:
    """Lines from the beginning of the first file on, on the driver, for as long as they are asked for; in a folder, files are in order of name."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(conf)
    found = store.globStatus(root)
    if found is None or not len(found):
        raise FileNotFoundError(path)
    files = [x for f in found for x in (store.listStatus(f.getPath()) if f.isDirectory() else [f]) if x.isFile()]
    for name in sorted((x.getPath() for x in files if x.getPath().getName()[0] not in "._" or len(files) == 1), key=lambda p: p.toString()):
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(name)
        stream = store.open(name)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream if codec is None else codec.createInputStream(stream), "UTF-8"))
        try:
            while (line := reader.readLine()) is not None:
                yield line
        finally:
            reader.close()


def read_header(spark: SparkSession, path: str, columns: int | None = None) -> Metadata:
    """From all comment lines before the first row; no more is read."""
    lines: list[str] = []
    for line in leading_lines(spark, path):
        if line.startswith("#"):
            lines.append(line)
        elif line.strip():
            break
    return parse_header(lines, columns)


def wrap(value: dict) -> str:
    return base64.b64encode(zlib.compress(json.dumps(value).encode())).decode()


def unwrap(text: str) -> dict:
    return json.loads(zlib.decompress(base64.b64decode(text)))
