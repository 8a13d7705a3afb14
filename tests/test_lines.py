"""True line numbers, tables built from checked lines, and the data source."""

import bz2
import gzip
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from lociframe.plans import views
from lociframe.registry import QUERIES
from lociframe.sources import lines, metadata, readers, variant_source, writers


def small_splits(spark, size):
    """Files are read in splits of this many bytes."""

    class Setting:
        def __enter__(self):
            self.old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")

        def __exit__(self, *_):
            for k, v in self.old.items():
                spark.conf.set(k, v)

    return Setting()


def test_numbers_of_lines_in_splits(spark, tmp_path):
    r = random.Random(1)
    for name, n in (("a.txt", 400), ("b.txt", 1), ("c.txt", 77)):
        (tmp_path / name).write_text("".join(f"{name}:{i + 1}:{'x' * r.randrange(40)}\n" for i in range(n)))
    for size in (37, 500, 1 << 20):
        with small_splits(spark, size):
            got = lines.numbered_lines(spark, str(tmp_path)).collect()
        assert len(got) == 478
        for x in got:
            name, number, _ = x["value"].split(":")
            assert x["line"] == int(number) and x["file"].endswith(name)


def test_the_bad_line_is_named(spark, tmp_path):
    rows = [f"c1\t{i}\tA\t{i * 2}" for i in range(300)]
    path = tmp_path / "t"
    for at, row, said in ((211, "c1\tx1\tA\t4", "pos in column 2"), (57, "c1\t3", "too few columns"), (120, "c1\t3\tA\t1.5", "rPos in column 4"), (0, "", "too few"), (299, "c1\t99999999999999999999\tA\t1", "pos in")):
        bad = ["# a remark", *rows]
        bad[at + 1] = row
        bad[min(at + 3, 300)] = bad[min(at + 3, 300)] if at > 290 else "short"
        path.write_text("\n".join(bad) + "\n")
        for size in (64, 1 << 20):
            with small_splits(spark, size), pytest.raises(ValueError, match=rf"line {at + 2}: bad row: {said}"):
                lines.checked_lines(spark, str(path), 4, {"pos": 2, "rPos": 4})


def test_built_table(spark, tmp_path):
    meta = lines.table_metadata(["chr", "pos", "r"], ["one", "two"], 1, 1, 2, 1, 3, "a_b", "x1")
    assert meta.column_names == ("chr", "pos", "r", "1G", "2G") and meta.individuals == (("one", 4), ("two", 5))
    (tmp_path / "raw").write_text("#top\n" + "".join(f"junk\t{i}\tc{i % 3}\t{i % 4 - 1}\t{(i + 1) % 3}\t{i * 10}\textra\r\n" for i in range(50)))
    with small_splits(spark, 100):
        table = lines.build_table(spark, str(tmp_path / "raw"), meta, [3, 2, 6, 4, 5])
        writers.write_table(table, str(tmp_path / "out"), meta)
    back, found = readers.variant_table(spark, str(tmp_path / "out"))
    assert found == meta
    assert [(r["scaffold"], r["pos"], r["ref_pos"], [c["g"] for c in r["calls"]]) for r in back.orderBy("line").collect()] == [(f"c{i % 3}", i, i * 10, [i % 4 - 1, (i + 1) % 3]) for i in range(50)]
    for wrong in (lambda: lines.table_metadata(["a"], ["x", "x"], 1, 1, 1, 1, 1, "s", "d"), lambda: lines.table_metadata(["a"], ["x"], 2, 1, 1, 1, 1, "s", "d"), lambda: lines.table_metadata(["a"], ["x"], 1, 1, 9, 1, 1, "s", "d")):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(ValueError, match="species"):
        lines.build_table(spark, str(tmp_path / "raw"), lines.table_metadata(["a", "b", "c"], ["x"], 1, 1, 2, 1, 3, "s p", "d"))
    with pytest.raises(ValueError, match="picked"):
        lines.build_table(spark, str(tmp_path / "raw"), meta, [1, 2])


def variants(tmp_path, n=500):
    meta = lines.table_metadata(["chr", "pos", "A"], ["p", "q"], 4, 1, 2, 1, 2, "s", "d")
    r = random.Random(2)
    rows = [(f"c{i % 3}", i * 3, r.choice("ACGT") + "é" * r.randrange(30), *(r.randrange(-1, 50) for _ in range(8))) for i in range(n)]
    text = "".join(x + "\n" for x in metadata.header_lines(meta))
    for i, row in enumerate(rows):
        text += "\t".join(map(str, row)) + "\n" + ("\n" if i % 50 == 7 else "# remark\n" if i % 50 == 9 else "")
    return meta, rows, text


def test_data_source(spark, tmp_path):
    meta, rows, text = variants(tmp_path)
    (tmp_path / "t.txt").write_text(text)
    with gzip.open(tmp_path / "t.txt.gz", "wt") as f:
        f.write(text)
    with bz2.open(tmp_path / "t.txt.bz2", "wt") as f:
        f.write(text)
    for name, size in (("t.txt", 1 << 20), ("t.txt", 700), ("t.txt", 61), ("t.txt.gz", 700), ("t.txt.bz2", 1 << 20)):
        found = variant_source.read_variants(spark, str(tmp_path / name), range_bytes=size)
        assert found.columns == list(meta.column_names)
        assert [f.dataType for f in found.schema.fields[:4]] == [StringType(), LongType(), StringType(), LongType()]
        assert sorted(tuple(r) for r in found.collect()) == sorted(rows), (name, size)
    picked = variant_source.read_variants(spark, f"file://{tmp_path}/t.txt", ["2G", "pos"], 997)
    assert sorted(tuple(r) for r in picked.collect()) == sorted((x[9], x[1]) for x in rows)
    assert picked.count() == 500 and picked.where("pos < 30").count() == 10
    with pytest.raises(Exception, match="no column"):
        spark.read.format("variants").schema("nothing long").load(str(tmp_path / "t.txt")).collect()


def test_ranges_hold_each_line_once(tmp_path):
    meta, rows, text = variants(tmp_path, 120)
    (tmp_path / "t.txt").write_text(text)
    raw = (tmp_path / "t.txt").read_bytes()
    for size in (1, 2, 17, 64, 333, len(raw) - 1, len(raw)):
        reader = variant_source.VariantReader(str(tmp_path / "t.txt"), variant_source.table_schema(meta), size)
        for block in (7, 1 << 20):
            variant_source.BLOCK_BYTES, old = block, variant_source.BLOCK_BYTES
            try:
                assert b"".join(b for p in reader.partitions() for b in reader._blocks(p)) == raw, (size, block)
            finally:
                variant_source.BLOCK_BYTES = old


def test_odd_cells(spark, tmp_path):
    meta, _, text = variants(tmp_path, 3)
    (tmp_path / "t.txt").write_text(text + 'c1\tx\t"A\t1\t2\t3\t4\t5\t6\t7\t8\tmore\nc1\t5\tB\t9\n')
    got = {r["A"][:2]: r for r in variant_source.read_variants(spark, str(tmp_path / "t.txt")).where("chr = 'c1' AND (pos IS NULL OR pos = 5)").collect()}
    assert got['"A']["pos"] is None and got['"A']["2Q"] == 8 and got["B"]["1A"] == 9 and got["B"]["2Q"] is None
    (tmp_path / "only").write_text("".join(x + "\n" for x in metadata.header_lines(meta)))
    assert variant_source.read_variants(spark, str(tmp_path / "only")).isEmpty()


def test_only_the_head_is_read(spark, tmp_path):
    meta, _, text = variants(tmp_path, 2)
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "part-0").write_text("\n" + text)
    (tmp_path / "f" / "part-1").write_text("# not a header {\nc1\t5\n")
    (tmp_path / "f" / "_SUCCESS").write_text("")
    assert metadata.read_header(spark, str(tmp_path / "f")) == meta == variant_source.header_of(str(tmp_path / "f"))
    with gzip.open(tmp_path / "t.gz", "wt") as f:
        f.write(text)
    assert metadata.read_header(spark, str(tmp_path / "t.gz")) == meta
    with pytest.raises(Exception, match="nowhere"):
        metadata.read_header(spark, str(tmp_path / "nowhere"))


def test_lines_of_sites_meet_wherever_files_are_split(spark, small):
    with small_splits(spark, 900):
        found = {r["site"]: r["genotypes"] for r in QUERIES["eigenstrat_round_trip"](spark, small).collect()}
    held = views.calls(spark, small).groupBy("site").agg(F.array_sort(F.collect_list(F.struct("ind", "g"))).alias("v")).collect()
    assert found == {r["site"]: "".join("9" if x["g"] < 0 else str(x["g"]) for x in r["v"]) for r in held}
