"""Lines of text files with their true numbers, and the tables that are built from checked lines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.prefix import carried
from .metadata import Metadata


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, start, at): each line with its file, the byte at which its split of the file begins, and a number that rises within the split."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value), lines counted from 1 in each file.

    A counting pass leaves a row for each split of a file: how many lines it holds, and the number of its first. Lines of
    earlier splits of the file are added up and carried to the split, so a file of any size is numbered where its splits are read.
    """
    lines = placed_lines(spark, path)
    splits = lines.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("at").alias("first")).withColumnRenamed("start", "chunk")
    before = carried(splits, ["file"], {"before": F.sum("n")}, {"before": F.sum}).select("file", F.col("chunk").alias("start"), "first", "before")
    told = lines.join(before, ["file", "start"])
    return told.select("file", (F.col("at") - F.col("first") + F.coalesce("before", F.lit(0)) + 1).alias("line"), "value")


def ordered_lines(lines: DataFrame) -> DataFrame:
    """Rows of ``placed_lines``, whichever are left, with their number ``n`` from 1 over all files in order of name, counted in the same two levels."""
    parts = lines.withColumn("chunk", F.struct("file", "start"))
    parts = parts.withColumn("local", F.row_number().over(Window.partitionBy("chunk").orderBy("at")))
    told = carried(parts, [], {"ahead": F.count("*")}, {"ahead": F.sum})
    return told.withColumn("n", F.coalesce("ahead", F.lit(0)) + F.col("local")).drop("chunk", "local", "ahead")


def checked_lines(spark: SparkSession, path: str, columns: int, integers: dict[str, int]) -> DataFrame:
    """(file, start, at, cell array) of lines that are no comments, all of which have enough columns and whole numbers where ``integers`` (name: column from 1) says so.

    One pass looks for the first bad line, in order of file and place; only if there is one, lines are counted, and its true number is named in the error.
    """
    lines = placed_lines(spark, path).where(~F.col("value").startswith("#"))
    cells = lines.withColumn("cell", F.split(F.regexp_replace("value", "[\r\n]+$", ""), "\t"))
    reason = F.when(F.size("cell") < columns, F.concat(F.lit(f"too few columns: {columns} are asked for, there are "), F.size("cell").cast("string")))
    for name, c in integers.items():
        cell = F.get("cell", F.lit(c - 1))
        reason = reason.when(cell.try_cast("long").isNull() | ~cell.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.concat(F.lit(f"{name} in column {c} is no whole number: "), F.coalesce(cell, F.lit(""))))
    bad = cells.withColumn("reason", reason).where("reason IS NOT NULL").agg(F.min(F.struct("file", "start", "at", "reason", "value")).alias("b")).first()["b"]
    if bad is not None:
        # lines before it in its file: all of earlier splits, and those of its own split with a smaller number
        earlier = placed_lines(spark, path).where((F.col("file") == bad["file"]) & ((F.col("start") < bad["start"]) | (F.col("start") == bad["start"]) & (F.col("at") < bad["at"])))
        raise ValueError(f"line {earlier.count() + 1}: bad row: {bad['reason']}, in {bad['file']}")
    return cells.select("file", "start", "at", "cell")


#: Columns that an individual has: reads of both alleles, genotype and quality; or the genotype alone.
COLUMNS = {4: "ABGQ", 1: "G"}


def table_metadata(preamble: list[str], individuals: list[str], columns: int, scaffold: int, pos: int, ref: int, ref_pos: int, species: str, dbkey: str) -> Metadata:
    """The header of a table with these columns before those of individuals, who are numbered from 1."""
    if columns not in COLUMNS:
        raise ValueError(f"an individual has {' or '.join(map(str, COLUMNS))} columns, not {columns}")
    names = [*preamble, *(f"{i}{c}" for i in range(1, len(individuals) + 1) for c in COLUMNS[columns])]
    for role, c in {"scaffold": scaffold, "pos": pos, "ref": ref, "rPos": ref_pos}.items():
        if not 0 < c <= len(names):
            raise ValueError(f"{role} is column {c} of {len(names)}")
    if len(set(individuals)) < len(individuals):
        raise ValueError("individuals' names repeat")
    people = tuple((n, len(preamble) + 1 + columns * i) for i, n in enumerate(individuals))
    return Metadata(tuple(names), people, scaffold, pos, ref, ref_pos, species, dbkey)


def build_table(spark: SparkSession, path: str, meta: Metadata, picked: list[int] | None = None) -> DataFrame:
    """(line, cell array) for ``write_table``: the checked lines of a file under the header ``meta``.

    ``picked``: the file's columns (from 1) that make the table's, in order; None: the file's as they are. Lines keep their order; ``line`` tells it and is no line number.
    """
    if not re.fullmatch("[0-9A-Z_a-z]+", meta.species):
        raise ValueError(f"species is no identifier: {meta.species}")
    places = picked or list(range(1, len(meta.column_names) + 1))
    if len(places) != len(meta.column_names):
        raise ValueError(f"{len(places)} columns are picked, the table has {len(meta.column_names)}")
    rows = checked_lines(spark, path, max(places), {"pos": places[meta.pos - 1], "rPos": places[meta.rPos - 1]})
    cells: Column = F.array(*[F.get("cell", F.lit(c - 1)) for c in places]) if picked else F.col("cell")
    return rows.select(F.struct("file", "start", "at").alias("line"), cells.alias("cell"))
