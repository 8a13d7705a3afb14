"""Files written here and read back."""

import gzip

import pytest
from lociframe.sources import metadata, readers, writers
from pyspark.sql import functions as F

HEAD = '#{"column_names":["chr","pos","A","B","Q","1A","1B","1G","1Q","2A","2B","2G","2Q"],"dbkey":"x",\n#"individuals":[["one",6],["two",10],["gone",40]],"pos":2,"rPos":2,"ref":1,"scaffold":1,"species":"y"}\n'


def put(path, text):
    path.write_text(text)
    return str(path)


def test_variant_table_round_trip(spark, tmp_path):
    path = put(tmp_path / "t.txt", HEAD + "c1\t10\tA\tC\t9.5\t3\t0\t2\t40\t0\t0\t-1\t0\n\nc1\t20\tG\tT\t8\t1\t1\t1\t30\t0\t5\t0\t20\n")
    table, meta = readers.variant_table(spark, path)
    assert meta.individuals == (("one", 6), ("two", 10)) and meta.species == "y"
    calls = [(r["pos"], r["ind"], r["a"], r["b"], r["g"], r["q"]) for r in readers.long_calls(table).orderBy("pos", "ord").collect()]
    assert calls == [(10, "one", 3, 0, 2, 40), (10, "two", 0, 0, None, 0), (20, "one", 1, 1, 1, 30), (20, "two", 0, 5, 0, 20)]
    out = str(tmp_path / "out")
    writers.write_table(table, out, meta)
    again, same = readers.variant_table(spark, out)
    assert same.individuals == meta.individuals and again.count() == 2
    with gzip.open(tmp_path / "t.txt.gz", "wt") as f:
        f.write((tmp_path / "t.txt").read_text())
    assert readers.data_rows(spark, str(tmp_path / "t.txt.gz")).count() == 2


def test_header_folds():
    meta = metadata.Metadata(column_names=tuple(f"column {i}, so" for i in range(60)), individuals=(("a", 3),), pos=2)
    lines = metadata.header_lines(meta)
    assert len(lines) > 2 and max(map(len, lines)) <= metadata.WIDTH + 1
    assert metadata.parse_header(lines).column_names == meta.column_names
    assert metadata.parse_header(["no header"]) == metadata.Metadata()
    assert metadata.unwrap(metadata.wrap({"a": 1})) == {"a": 1}


def test_long_header_is_read_whole(spark, tmp_path):
    people = tuple((f"individual number {i}", 5 + 4 * i) for i in range(7000))
    meta = metadata.Metadata(column_names=tuple(f"c{i}" for i in range(1, 28_005)), individuals=people, pos=2)
    lines = metadata.header_lines(meta)
    assert len(lines) > 1000
    path = put(tmp_path / "long.txt", "\n".join(lines) + "\nc1\t10\n# a remark below\nc1\t20\n")
    assert metadata.read_header(spark, path) == meta
    table, found = readers.variant_table(spark, put(tmp_path / "two.txt", HEAD + "c1\t10\n"))
    assert len(found.individuals) == 2 and table.count() == 1
    with pytest.raises(ValueError, match="not JSON"):
        metadata.parse_header(lines[:1000])
    with pytest.raises(ValueError, match="not JSON"):
        metadata.read_header(spark, put(tmp_path / "cut.txt", lines[0] + "\nc1\t10\n"))


def test_vcf_round_trip(spark, tmp_path):
    text = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\nc1\t7\t.\tA\tC\t5\t.\t.\tGT:GQ:AD\t1/1:44:0,31\t./.\nc1\t9\t.\tG\tT\t5\t.\t.\tGT\t0|1\t0/0\n"
    rows = readers.vcf_genotypes(spark, put(tmp_path / "v.vcf", text)).orderBy("pos", "ind")
    assert [(r["pos"], r["ind"], r["g"], r["a"], r["b"], r["q"]) for r in rows.collect()] == [(7, "s1", 0, 0, 31, 44), (7, "s2", -1, None, None, None), (9, "s1", 1, None, None, None), (9, "s2", 2, None, None, None)]
    sites = rows.groupBy("chrom", "pos", F.col("ref").alias("a"), F.col("alt").alias("b"), "qual").agg(F.sum(F.when(F.col("g") >= 0, 2).otherwise(0)).alias("na"), F.sum(F.when(F.col("g") >= 0, 2 - F.col("g")).otherwise(0)).alias("ac"))
    lines = [r["value"] for r in writers.vcf_lines(sites, "P").collect()]
    assert lines[0] == "##fileformat=VCFv4.1" and lines[-2].split("\t")[-1] == "2:2" and lines[-1].split("\t")[-1] == "4:1"


def test_other_genotype_formats(spark, tmp_path):
    want = [("s9", 5150, "a", 0), ("s9", 5150, "b", 0), ("s9", 5151, "a", -1), ("s9", 5151, "b", 1)]
    csv = put(tmp_path / "c.csv", ",a,b\ns9 5150,22,22\ns9 5151,00,12\n")
    fstat = put(tmp_path / "f.dat", "2 2 2 1\ns9 5150\ns9 5151\n a 22 00\n b 22 12\n")
    genepop = put(tmp_path / "g.txt", "title\ns9 5150, s9 5151\nPOP\na, 0202 0000\nPop\nb, 0202 0102\n")
    for rows in (readers.csv_genotypes(spark, csv), readers.fstat_genotypes(spark, fstat), readers.genepop_genotypes(spark, genepop)):
        assert [(r["chrom"], r["pos"], r["ind"], r["g"]) for r in rows.orderBy("pos", "ind").collect()] == want


def test_small_files(spark, tmp_path):
    assert [tuple(r) for r in readers.fasta(spark, put(tmp_path / "x.fa", ">one desc\nAC\nGT\n>two\nTT\n")).orderBy("name").collect()] == [("one", "ACGT"), ("two", "TT")]
    assert [r["alias"] for r in readers.individuals(spark, put(tmp_path / "i", "9\tPB1\t\n13\tPB2\tx\n")).orderBy("ord").collect()] == ["", "x"]
    ped = readers.pedigree(spark, put(tmp_path / "p", "a - -\nb - -\nc a b\n")).orderBy("ord").collect()
    assert [(r["id"], r["p1"], r["p2"]) for r in ped] == [("a", None, None), ("b", None, None), ("c", "a", "b")]
    assert readers.weighted_edges(spark, put(tmp_path / "e", "m f 0.5\nshort\n")).first()["weight"] == 0.5
    loc = put(tmp_path / "l", "# c\nk\tv1\nk\tv2\n")
    assert (readers.locations(spark, loc).first()["value"], readers.locations(spark, loc, True).first()["value"]) == ("v1", "v2")
    assert readers.conflicting_locations(spark, loc).count() == 1
    assert readers.primers(spark, put(tmp_path / "q", ">s1 5\nE1, E2\nACG\n")).first()["enzymes"] == ["E1", "E2"]
    kgml = '<?xml version="1.0"?>\n<pathway name="path:x1" org="o" number="1"><entry id="1" name="g:1 g:2" type="gene"/><entry id="2" name="c" type="compound"/><reaction id="1" type="reversible"><substrate id="2"/><product id="3"/></reaction></pathway>'
    genes, edges = readers.pathway_graphs(spark, put(tmp_path / "k.xml", kgml))
    assert genes.count() == 2 and {(r["src"], r["dst"]) for r in edges.collect()} == {(2, 1), (1, 3), (1, 2), (3, 1)}


def test_ped_and_matrices(spark, tmp_path):
    calls = spark.createDataFrame([("x", 1, 2), ("x", 2, -1), ("y", 1, 1), ("y", 2, 0)], "ind string, site long, g long")
    path = str(tmp_path / "ped")
    writers.ped_lines(calls, F.col("site")).write.text(path)
    assert [(r["ind"], r["snp"], r["g"]) for r in readers.ped_genotypes(spark, path).orderBy("ind", "snp").collect()] == [("x", 0, 2), ("x", 1, 9), ("y", 0, 1), ("y", 1, 0)]
    assert [r["value"] for r in writers.eigenstrat_lines(calls).collect()] == ["21", "90"]
    cells = spark.createDataFrame([(i, j, float(i != j)) for i in "ab" for j in "ab"], "i string, j string, d double")
    assert [r["value"] for r in writers.matrix_lines(cells, "d").collect()] == ["2", "a          0.0000 1.0000", "b          1.0000 0.0000"]


def test_other_readers(spark, tmp_path):
    csv = put(tmp_path / "c.csv", "x,a,b,c\ns1 5,A,M,C\ns1 6,G,G,N\ns1 7,12,22,00\n")
    assert [tuple(r)[1:] for r in readers.csv_allele_codes(spark, csv).orderBy("pos", "ind").collect()] == [(5, "a", 2), (5, "b", 1), (5, "c", 0), (6, "a", 2), (6, "b", 2), (6, "c", -1), (7, "a", 1), (7, "b", 0), (7, "c", -1)]
    with pytest.raises(Exception, match="not two alleles"):
        readers.csv_allele_codes(spark, put(tmp_path / "d.csv", "x,a,b,c\ns1 5,A,G,C\n")).collect()
    assert [tuple(r)[1:] for r in readers.map_sites(spark, put(tmp_path / "m", "1 snp4 0 88\n2 snp5 0.1 99\n")).orderBy("line").collect()] == [("1", "snp4", 88), ("2", "snp5", 99)]
    assert tuple(readers.founder_kinship(spark, put(tmp_path / "k", "a b 0.125\n")).first()) == ("a", "b", 0.125)
    assert [tuple(r)[1:] for r in readers.option_list(spark, put(tmp_path / "o", "# c\nE1\nx01\tName of x\n")).orderBy("line").collect()] == [("E1", "E1"), ("x01", "Name of x")]
    good = readers.checked_primers(spark, put(tmp_path / "p", ">s1 5\nE1\nACG\n>s1 6\nE2\nACG\n"))
    assert good.count() == 2 and good.select("entry").collect()
    with pytest.raises(Exception, match="repeated primer"):
        readers.checked_primers(spark, put(tmp_path / "q", ">s1 5\nE1\nACG\n>s1 5\nE2\nACG\n")).collect()
    with pytest.raises(Exception, match="line 2: bad row"):
        readers.checked_table(spark, put(tmp_path / "t", "c1\t5\nc1\tx\n"), 2, [2]).collect()


def test_other_writers(spark):
    cells = spark.createDataFrame([(i, j, float(i != j)) for i in "abc" for j in "abc"], "i string, j string, d double")
    assert [r["value"] for r in writers.mega_lines(cells, "d", "t").collect()] == ["#mega", "!Title: t;", "!Format DataType=Distance DataFormat=LowerLeft;", "#a", "#b", "#c", "1.0000", "1.0000 1.0000"]
    runs = spark.createDataFrame([("c2", 5, 9), ("c1", 7, 8)], "chrom string, start long, end long")
    assert [r["value"] for r in writers.link_lines(runs).collect()] == ["c1 7 8", "c2 5 9"]
    people = spark.createDataFrame([(1, "two words"), (0, "one")], "ord long, population string")
    assert [r["value"] for r in writers.eigenstrat_ind_lines(people).collect()] == ["ind_0 M one", "ind_1 M two_words"]
    assert writers.eigenstrat_parameters("g", "s", "i", "v", "w")[-1] == "numoutevec: 2"
    lines = writers.submission_lines("H", "B", ["p", "q"])
    assert lines.count("||") == 6 and lines.count("HANDLE: H") == 6 and "BATCH: B" in lines and "ID: q" in lines


def test_a_table_in_several_files(spark, tmp_path):
    """Spark deals files to partitions by size: the head is in the first file by name, not in the largest one."""
    (tmp_path / "csv").mkdir()
    put(tmp_path / "csv" / "part-0", "site,x,y\na 1,11,12\n")
    put(tmp_path / "csv" / "part-1", "".join(f"a {i},22,11\n" for i in range(2, 900)))
    rows = readers.csv_genotypes(spark, str(tmp_path / "csv")).select("chrom", "pos", "ind", "g").collect()
    assert sorted(map(tuple, rows)) == sorted([("a", 1, "x", 2), ("a", 1, "y", 1)] + [("a", i, n, g) for i in range(2, 900) for n, g in (("x", 0), ("y", 2))])
    (tmp_path / "keys").mkdir()
    put(tmp_path / "keys" / "part-0", "k\tfirst\n")
    put(tmp_path / "keys" / "part-1", "k\tlast\n" * 900)
    assert readers.locations(spark, str(tmp_path / "keys")).first()["value"] == "first"
    assert readers.first_line(readers.text_lines(spark, str(tmp_path / "csv")).limit(0)) is None
