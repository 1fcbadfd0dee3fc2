"""Versioned Parquet tables: writes go to new folders and a numbered manifest then names them.

The manifest with the highest number is the table.  It appears by one rename
and is never changed or replaced, so a reader sees a version whole or not at
all, and a job that dies leaves the last one.  Of two writers that start from
the same version, the second finds its number taken and raises.  Folders and
manifests that the current one doesn't need are removed by :meth:`Store.vacuum`.

A table may be kept in buckets by key; an upsert then rewrites the buckets its
rows fall into and the new manifest names the other folders again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockmill.operators.collection import insert_ignore, latest_wins

DERIVED = ["condensed_comments", "theme_hierarchy", "entity_taxonomy", "comment_entities", "theme_summaries", "comment_themes", "theme_scoring_status", "comment_theme_extracts"]
_MANIFEST = "MANIFEST-"


class Store:
    """Tables of one collection below a folder that Hadoop's file systems reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        path = self.jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path.getFileSystem(self.conf), path

    def _names(self, table: str, folders: bool) -> list[str]:
        fs, path = self._path(table)
        return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() == folders) if fs.exists(path) else []

    def versions(self, table: str) -> list[str]:
        """Folders of the table, those of earlier versions too."""
        return self._names(table, True)

    def _manifests(self, table: str) -> list[str]:
        return [n for n in self._names(table, False) if n.startswith(_MANIFEST)]

    def manifest(self, table: str) -> dict | None:
        """``parts`` (folder by bucket; the bucket of an unbucketed table is ""), ``buckets``, ``schema``."""
        found = self._manifests(table)
        if not found:
            return None
        fs, path = self._path(table, found[-1])
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def exists(self, table: str) -> bool:
        return bool(self._manifests(table))

    def columns(self, table: str) -> list[str]:
        return self.read(table).columns if self.exists(table) else []

    def read(self, table: str) -> DataFrame:
        return self._read(table, self.manifest(table))

    def _read(self, table: str, manifest: dict, buckets: list[str] | None = None) -> DataFrame:
        from pyspark.sql.types import StructType

        paths = [f"{self.root}/{table}/{p}" for b, p in manifest["parts"].items() if buckets is None or b in buckets]
        schema = StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _commit(self, table: str, manifest: dict, after: list[str]) -> DataFrame:
        """Name the table's parts, as the successor of the manifests ``after``."""
        number = int(after[-1].removeprefix(_MANIFEST)) + 1 if after else 0
        fs, final = self._path(table, f"{_MANIFEST}{number:012d}")
        _, draft = self._path(table, f".draft-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise RuntimeError(f"{table}: another writer has made version {number}")
        return self.read(table)

    def overwrite(self, table: str, df: DataFrame) -> DataFrame:
        """A new version; it becomes current when it is written in full."""
        after = self._manifests(table)
        folder = f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{table}/{folder}")
        return self._commit(table, {"parts": {"": folder}, "buckets": None, "schema": df.schema.jsonValue()}, after)

    def insert(self, table: str, df: DataFrame, key: list[str]) -> DataFrame:
        """Append; raises if a key is there already or twice in ``df``."""
        both = self.read(table).unionByName(df) if self.exists(table) else df
        if both.groupBy(*key).count().where("count > 1").limit(1).count():
            raise ValueError(f"{table}: repeated key {key}")
        return self.overwrite(table, both)

    def insert_ignore(self, table: str, df: DataFrame, key: list[str]) -> DataFrame:
        if not self.exists(table):
            return self.overwrite(table, df.dropDuplicates(key))
        return self.overwrite(table, self.read(table).unionByName(insert_ignore(self.read(table), df, key)))

    def upsert(self, table: str, df: DataFrame, key: list[str], *, order: Column | None = None, buckets: int | None = None) -> DataFrame:
        """Rows of ``df`` replace stored ones with the same key; of rows of ``df`` with one key the last in ``order`` counts.

        Without ``order`` that is the last as read.  A table that is made with
        ``buckets`` keeps them: later calls rewrite only those that ``df`` touches.
        """
        after, manifest = self._manifests(table), self.manifest(table)
        n = buckets if manifest is None else manifest["buckets"]
        new = df.withColumn("__version", F.struct(F.lit(1).alias("fresh"), (F.monotonically_increasing_id() if order is None else order).alias("at")))
        at = new.schema["__version"].dataType["at"].dataType
        first = F.struct(F.lit(0).alias("fresh"), F.lit(None).cast(at).alias("at"))
        if n is None:
            old = (self.read(table) if manifest else df.limit(0)).withColumn("__version", first)
            return self.overwrite(table, latest_wins(old, new, key, version="__version").drop("__version"))
        bucket = F.pmod(F.xxhash64(*key), F.lit(n)).cast("string")
        touched = sorted(r[0] for r in df.select(bucket).distinct().collect())  # n at most
        stored = self._read(table, manifest, touched) if manifest else df.limit(0)
        merged = latest_wins(stored.withColumn("__version", first), new, key, version="__version").drop("__version")
        folder = f"v-{uuid.uuid4().hex}"
        merged.withColumn("__bucket", bucket).write.partitionBy("__bucket").parquet(f"{self.root}/{table}/{folder}")
        parts = (manifest["parts"] if manifest else {}) | {b: f"{folder}/__bucket={b}" for b in touched}
        return self._commit(table, {"parts": parts, "buckets": n, "schema": df.schema.jsonValue()}, after)

    def delete(self, table: str, condition) -> DataFrame:
        return self.overwrite(table, self.read(table).where(~F.coalesce(condition, F.lit(False))))

    def clear(self, table: str) -> DataFrame:
        """An empty version with the same columns."""
        return self.overwrite(table, self.read(table).limit(0))

    def clear_derived(self, cache: bool = False) -> dict[str, int]:
        """Drop what is computed from comments and transcriptions; returns the row counts dropped."""
        gone = {}
        for t in [*DERIVED, *(["llm_cache"] if cache else [])]:
            if self.exists(t):
                gone[t] = self.read(t).count()
                fs, path = self._path(t)
                fs.delete(path, True)
        return gone

    def size(self, table: str) -> int:
        fs, path = self._path(table)
        return fs.getContentSummary(path).getLength() if fs.exists(path) else 0

    def vacuum(self, table: str, files: int | None = None) -> tuple[int, int]:
        """Rewrite into fewer files if asked, remove what earlier versions left; bytes before and after."""
        before = self.size(table)
        if files is not None and self.manifest(table)["buckets"] is None:
            self.overwrite(table, self.read(table).repartition(files))
        needed = set(self.manifest(table)["parts"].values())
        for v in self.versions(table):
            inner = self._names(f"{table}/{v}", True)
            for gone in [v] if not any(p == v or p.startswith(f"{v}/") for p in needed) else [f"{v}/{b}" for b in inner if f"{v}/{b}" not in needed and v not in needed]:
                fs, path = self._path(table, gone)
                fs.delete(path, True)
        for m in self._manifests(table)[:-1]:
            fs, path = self._path(table, m)
            fs.delete(path, False)
        return before, self.size(table)
