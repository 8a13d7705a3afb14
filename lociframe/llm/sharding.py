"""Sharding by size-tiered compaction, in DataFrame functions only.

A store is a folder of immutable Parquet shards and of manifests, one per version. A manifest is a table with a row per
live shard, so it is read, joined and counted as one; only the bounded list of shards of one merge passes through the driver.

* ``append`` writes an arrival as it is partitioned, without a shuffle: each task's file is a small shard.
* ``compact`` takes shards below half the target size, by the bytes of their files. A tier holds shards within a factor ``FAN``
  in size; of the shards of a tier, in hash slots of bounded length, those that follow each other up to the target size are a
  run. Runs that reach the target, or hold ``FAN`` shards, become one file each, written by a task of its own. Only rows that
  are merged are shuffled, and full shards are never written again.
* A commit writes the next manifest under a name of its own, and then the file of its version aside, which it names in one step that only one
  writer can do: a hard link on local disks, a rename that does not overwrite elsewhere. So a reader sees a whole version or none, also where a writer
  dies in between; what it wrote aside is no version. The writer that comes second
  starts again from the version that it lost to: an append adds its shards to it, a merge is dropped if its shards are gone.
* ``vacuum`` removes data that no retained version names and that is older than a grace period, as other writers may be about to
  commit younger data. Nothing else deletes, and old versions stay readable until then.

A failed task or a lost executor leaves files that no manifest names. Equal rows, nulls and all other columns are kept as they
are; columns named ``shard``, ``part`` or ``merged`` are refused, and so is a column that changes its type. Appending an empty
table commits a version without new shards. An empty store reads as no rows, with the columns of what was appended.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, new_path, table

TARGET_BYTES = 128 << 20
FAN = 4
BASE_BYTES = 1 << 16
SLOT = 10_000
ARRIVALS = 4
RETRIES = 20
#: A merge begins no run beyond so many shards; the next one goes on.
PLANNED = 20_000
MANIFEST = "shard string, part string, rows long, bytes long, version int"


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, fan: int = FAN):
        self.spark, self.root, self.target, self.fan = spark, root.rstrip("/"), target_bytes, fan

    def _path(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        store = found.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return store.makeQualified(found), store

    def _publish(self, version: int, said: str) -> bool:
        """Makes the file of a version, unless it is there: written aside, and then named in one step that fails if the name is taken."""
        final, store = self._path(f"versions/v={version}")
        aside, _ = self._path(f"versions/_{uuid.uuid4().hex}")
        store.mkdirs(final.getParent())
        try:
            out = store.create(aside, False)
            out.write(bytearray(said.encode()))
            out.close()
            self._name(store, aside, final)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.toString():
                return False
            raise
        finally:
            store.delete(aside, False)
        return True

    def _name(self, store, aside, final) -> None:
        """A local disk renames over what is there, but does not link over it; elsewhere the file system's own rename without overwriting is one step."""
        jvm = self.spark._jvm
        if store.getUri().getScheme() == "file":
            paths = jvm.java.nio.file.Paths
            jvm.java.nio.file.Files.createLink(paths.get(final.toUri()), paths.get(aside.toUri()))
        else:
            self._rename(aside, final)

    def _rename(self, aside, final) -> None:
        jvm = self.spark._jvm
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.spark._jsc.hadoopConfiguration()).rename(aside, final, options)

    def versions(self) -> list[int]:
        path, store = self._path("versions")
        if not store.exists(path):
            return []
        return sorted(int(n[2:]) for n in (x.getPath().getName() for x in store.listStatus(path)) if n.startswith("v="))

    def _said(self, version: int) -> dict:
        path, store = self._path(f"versions/v={version}")
        stream = store.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def schema(self, version: int | None = None) -> T.StructType:
        known = self.versions()
        return T.StructType.fromJson(self._said(known[-1] if version is None else version)["schema"]) if known else T.StructType()

    def manifest(self, version: int | None = None) -> DataFrame:
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifests/{self._said(known[-1] if version is None else version)['table']}")

    def commit(self, change: Callable[[DataFrame, int], DataFrame | None], schema: T.StructType | None = None) -> int | None:
        """Publishes what ``change`` makes of the last version's shards and the next version's number; again if another writer was first.

        ``change`` may give None where its merge no longer holds; then nothing is committed.
        """
        for _ in range(RETRIES):
            before = max([0, *self.versions()])
            shards = change(self.manifest(before) if before else self.manifest(), before + 1)
            if shards is None:
                return None
            name, columns = uuid.uuid4().hex, self.schema(before) if before else T.StructType()
            shards.write.parquet(f"{self.root}/manifests/{name}")
            for field in (schema or T.StructType()).fields:
                if field.name not in columns.names:
                    columns = columns.add(T.StructField(field.name, field.dataType, True))
                elif columns[field.name].dataType != field.dataType:
                    raise ValueError(f"column {field.name} is of another type in the store")
            if self._publish(before + 1, json.dumps({"table": name, "schema": columns.jsonValue(), "time": time.time()})):
                return before + 1
            path, store = self._path(f"manifests/{name}")
            store.delete(path, True)
        raise RuntimeError("other writers were always first")

    def _rows(self, paths: list[str], schema: T.StructType) -> DataFrame:
        """All rows in these folders or files, live or not, with the file that holds each."""
        return self.spark.read.schema(schema).parquet(*paths).withColumn("shard", F.col("_metadata.file_path"))

    def _listed(self, part: str, version: int) -> DataFrame:
        """The shards of a folder: one per file, by the path that Spark gives each row."""
        files = self.spark.read.schema(T.StructType()).parquet(f"{self.root}/data/{part}").select(F.col("_metadata.file_path").alias("shard"), F.col("_metadata.file_size").alias("n"))
        found = files.groupBy("shard").agg(F.count("*").alias("rows"), F.max("n").alias("bytes"))
        return found.select("shard", F.lit(part).alias("part"), "rows", "bytes", F.lit(version).alias("version"))

    def append(self, rows: DataFrame) -> int:
        if {"shard", "part", "merged"} & {c.lower() for c in rows.columns}:
            raise ValueError("columns may not be named shard, part or merged")
        part = uuid.uuid4().hex
        rows.write.parquet(f"{self.root}/data/{part}")
        return self.commit(lambda live, version: live.union(self._listed(part, version)), rows.schema)

    def plan(self) -> DataFrame:
        """(shard, merged): shards to merge and the number of the file that they go to; runs as they begin within ``PLANNED`` shards, the others next time."""
        small = self.manifest().where(F.col("bytes") < self.target / 2)
        tier = F.floor(F.log(float(self.fan), F.greatest(F.col("bytes"), F.lit(BASE_BYTES)) / BASE_BYTES))
        slots = F.ceil(F.count("*").over(Window.partitionBy("tier")) / SLOT)
        placed = small.withColumn("tier", tier).withColumn("slot", F.pmod(F.xxhash64("shard"), slots))
        order = Window.partitionBy("tier", "slot").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumn("run", F.floor(F.coalesce(F.sum("bytes").over(order), F.lit(0)) / self.target))
        run = Window.partitionBy("tier", "slot", "run")
        full = (F.count("*").over(run) >= self.fan) | (F.sum("bytes").over(run) >= self.target)
        chosen = cut(placed.withColumn("full", full).where("full").select("shard", "part", "tier", "slot", "run"), "plan")
        runs = chosen.groupBy("tier", "slot", "run").agg(F.count("*").alias("shards"))
        order = Window.orderBy("tier", "slot", "run")  # a row per file to write
        before = F.coalesce(F.sum("shards").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        runs = runs.withColumn("merged", F.row_number().over(order) - 1).withColumn("before", before).where(F.col("before") < PLANNED).drop("shards", "before")
        return cut(chosen.join(runs, ["tier", "slot", "run"]).select("shard", "merged"), "plan")

    def compact(self) -> int:
        """Merges until no run is full; returns the version."""
        while True:
            plan = self.plan()
            files = plan.collect()  # fewer than PLANNED + SLOT paths: the files of this merge, and no others, are read
            if not files:
                return max([0, *self.versions()])
            part, schema, shards = uuid.uuid4().hex, self.schema(), len(files)
            moved = self._rows([unquote(r["shard"]) for r in files], schema).join(F.broadcast(plan), "shard")
            moved.repartitionById(1 + max(r["merged"] for r in files), F.col("merged").cast("int")).drop("shard", "merged").write.parquet(f"{self.root}/data/{part}")

            def merged(live: DataFrame, version: int, part: str = part, plan: DataFrame = plan, shards: int = shards) -> DataFrame | None:
                if live.join(plan.select("shard"), "shard", "left_semi").count() < shards:
                    return None
                return live.join(plan.select("shard"), "shard", "left_anti").unionByName(self._listed(part, version))

            self.commit(merged)

    def vacuum(self, retain: int = 10, grace_seconds: float = 86_400.0) -> None:
        """Removes versions before the last ``retain``, and folders that the others do not name; nothing younger than the grace period goes."""
        known, said = self.versions(), {v: self._said(v) for v in self.versions()}
        old = [v for v in known[:-retain] if said[v]["time"] <= time.time() - grace_seconds]
        kept = [v for v in known if v not in old]
        for v in old:
            path, store = self._path(f"versions/v={v}")
            store.delete(path, False)
        named: set[str] = set()
        for v in kept:
            named |= {r["part"] for r in self.manifest(v).select("part").distinct().collect()}  # folders, not shards
        for folder, live in (("data", named), ("manifests", {said[v]["table"] for v in kept})):
            path, store = self._path(folder)
            for x in store.listStatus(path) if store.exists(path) else []:
                if x.getPath().getName() not in live and x.getModificationTime() / 1000 <= time.time() - grace_seconds:
                    store.delete(x.getPath(), True)

    def read(self, version: int | None = None) -> DataFrame:
        """All live rows with their shard."""
        shards, schema = self.manifest(version), self.schema(version)
        parts = [r["part"] for r in shards.select("part").distinct().collect()]
        rows = self._rows([f"{self.root}/data/{p}" for p in parts], schema) if parts else self.spark.createDataFrame([], schema.add("shard", "string") if "shard" not in schema.names else schema)
        return rows.join(shards.select("shard", "rows", "bytes", "version"), "shard")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in ``ARRIVALS`` arrivals, each appended and compacted; per document, the shard that holds it in the end.

    The store has one writer here, so data that a merge has replaced goes at once.
    """
    docs, store = table(spark, sf_dir, "documents"), ShardStore(spark, new_path(spark, "shards"))
    for arrival in range(ARRIVALS):
        store.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS)) == arrival))
        store.compact()
        store.vacuum(retain=1, grace_seconds=0)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = store.read().select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("text_sha256"), "shard", F.col("rows").alias("shard_rows"), F.col("bytes").alias("shard_bytes"), "version")
    return found.withColumn("shard", F.substring_index("shard", "/data/", -1))
