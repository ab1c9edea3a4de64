"""Versioned tables in a folder: immutable parts, and a numbered manifest per version.

A manifest appears under its number as a whole or not at all, and no two writers get the same number: a writer that comes
second looks at what the first one did and tries the next number. Readers take the highest one, so a crash before it
appears leaves the version before. The manifest holds the properties of its version, so data and state can't come apart.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.files import Folder

#: How often a writer tries the next number before it gives up.
_ATTEMPTS = 50


class Conflict(RuntimeError):
    """Another writer has made a version in the meantime."""


class Table:
    """One table; parts are folders that versions share, so appending costs what is appended."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, Folder(spark, root)

    @property
    def root(self) -> str:
        return self.folder.root

    def manifest(self) -> dict:
        """parts and properties of the current version; no parts if there is none."""
        names = [n for n in self.folder.names() if n.startswith("manifest-")]
        return json.loads(self.folder.read(names[-1])) if names else {"version": 0, "parts": [], "properties": {}}

    def exists(self) -> bool:
        return self.manifest()["version"] > 0

    def properties(self) -> dict[str, str]:
        return self.manifest()["properties"]

    def read(self) -> DataFrame:
        return self._parts(self.manifest()["parts"])

    def _parts(self, parts: list[str]) -> DataFrame:
        if not parts:
            raise FileNotFoundError(f"no version of {self.root}")
        # a part within a bucket's folder: the number of the bucket is no column of the table
        how = ("recursiveFileLookup", "true") if any("=" in p for p in parts) else ("basePath", self.root)
        return self.spark.read.option(*how).parquet(*[self.folder.path(p) for p in parts])

    def _write(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        part = f"part-{uuid.uuid4().hex}"
        w = df.write.mode("errorifexists")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(self.folder.path(part))
        return part

    def commit(self, change: Callable[[dict], list[str]], properties: dict | None = None) -> dict:
        """A new version with the parts that change makes of the current manifest; change is asked again after a conflict."""
        for _ in range(_ATTEMPTS):
            m = self.manifest()
            new = {"version": m["version"] + 1, "parts": change(m), "properties": m["properties"] | {k: str(v) for k, v in (properties or {}).items()}, "committed_at": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")}
            if self.folder.publish(f"manifest-{new['version']:010d}.json", json.dumps(new).encode()):
                return new
        raise Conflict(f"{self.root} is written by others all the time")

    def overwrite(self, df: DataFrame, properties: dict | None = None, partition_by: list[str] | None = None) -> dict:
        part = self._write(df, partition_by)
        return self.commit(lambda m: [part], properties)

    def append(self, df: DataFrame, properties: dict | None = None) -> dict:
        part = self._write(df)
        return self.commit(lambda m: [*m["parts"], part], properties)


class KeyedTable(Table):
    """A table in buckets by the hash of its key, of which those that a change touches are read and written again."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 32):
        super().__init__(spark, root)
        self.key = key
        self.buckets = int(self.properties().get("buckets", buckets))

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def touched(self, df: DataFrame) -> list[int]:
        """The buckets of the rows' keys."""
        return sorted(r[0] for r in df.select(self.bucket()).distinct().collect())

    def _in(self, part: str) -> int:
        return int(part.rpartition("=")[2])

    def rows(self, buckets: Iterable[int], like: DataFrame) -> DataFrame:
        """The rows in these buckets, with the columns of like; none if there are no parts."""
        wanted = set(buckets)
        parts = [p for p in self.manifest()["parts"] if self._in(p) in wanted]
        return self._parts(parts).select(*like.columns) if parts else like.limit(0)

    def _write_buckets(self, df: DataFrame) -> list[str]:
        part = self._write(df.withColumn("_bucket", self.bucket()).repartition("_bucket"), ["_bucket"])
        return [f"{part}/{n}" for n in self.folder.names(part) if n.startswith("_bucket=")]

    def append(self, df: DataFrame, properties: dict | None = None) -> dict:
        parts = self._write_buckets(df)
        return self.commit(lambda m: [*m["parts"], *parts], {"buckets": self.buckets} | (properties or {}))

    def replace(self, df: DataFrame, buckets: Iterable[int], properties: dict | None = None, *, since: int | None = None) -> dict:
        """Puts the rows of df in the place of all rows in these buckets.

        since is the version that df was made of, by default the present one; another version after it is a Conflict.
        """
        gone, seen = set(buckets), self.manifest()["version"] if since is None else since
        parts = self._write_buckets(df)

        def change(m: dict) -> list[str]:
            if m["version"] != seen:
                raise Conflict(f"{self.root} has been written by another")
            return [p for p in m["parts"] if self._in(p) not in gone] + parts

        return self.commit(change, {"buckets": self.buckets} | (properties or {}))


class VectorStore(Table):
    """key and embedding; the dimension is learned from the first rows and then enforced, keys are unique."""

    def add(self, vectors: DataFrame, *, key: str = "pmid", properties: dict | None = None, absent_from: Iterable[str] = ()) -> dict:
        """Appends vectors of keys that aren't there yet. Other dimensions and keys given twice raise and add nothing.

        vectors is computed once: it is written, what is written is checked, and only then does a version name it. Keys
        that another writer has added in the meantime are taken out again. absent_from: parts that are known not to hold
        any of the keys, which then aren't read. Besides the manifest it tells how many were added and the part that they
        are in; neither is there if nothing was new.
        """
        compared = set(absent_from)

        def unseen(m: dict) -> list[str]:
            return [p for p in m["parts"] if p not in compared]

        def without(df: DataFrame, parts: list[str]) -> DataFrame:
            return df.join(self._parts(parts).select(key), key, "left_anti") if parts else df

        present = unseen(self.manifest())
        part = self._write(without(vectors.select(key, "embedding"), present))
        compared.update(present)
        try:
            while True:
                written = self._parts([part])
                sizes = written.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).limit(3).collect()
                n, dims = sum(r["n"] for r in sizes), sorted(r["d"] for r in sizes)
                m = self.manifest()
                known = m["properties"].get("dim")
                if len(dims) > 1 or (dims and known and str(dims[0]) != known):
                    raise ValueError(f"vectors have dimensions {dims}, the store has {known}")
                if written.groupBy(key).count().filter("count > 1").limit(1).count():
                    raise ValueError("a key occurs twice")
                later = unseen(m)
                if later and written.join(self._parts(later).select(key), key, "left_semi").limit(1).count():
                    smaller = self._write(without(written, later))
                    self.folder.delete(part)
                    part = smaller
                elif not n:
                    self.folder.delete(part)
                    return m
                else:
                    try:
                        return self._name(m, part, n, dims[0], properties)
                    except Conflict:
                        pass
                compared.update(later)
        except ValueError:
            self.folder.delete(part)
            raise

    def _name(self, m: dict, part: str, n: int, dim: int, properties: dict | None) -> dict:
        def change(now: dict) -> list[str]:
            if now["version"] != m["version"]:
                raise Conflict(self.root)
            return [*now["parts"], part]

        # the index is behind as soon as the vectors change
        done = self.commit(change, {"dim": dim, "ntotal": int(m["properties"].get("ntotal", 0)) + n, "query_index_type": "flat"} | (properties or {}))
        return done | {"added": n, "named": [part]}

    def ids(self, key: str = "pmid") -> DataFrame:
        """The keys, from the vectors themselves: there is no second copy to fall behind."""
        return self.read().select(key)


def shards(spark: SparkSession, root: str) -> list[VectorStore]:
    """The stores in the numbered folders below root, by number; other folders and stores without vectors are left out."""
    numbers = sorted(int(n) for n in Folder(spark, root).names() if n.isdigit())
    found = [VectorStore(spark, f"{root}/{n}") for n in numbers]
    return [s for s in found if s.manifest()["parts"]]


def merge_shards(store: VectorStore, shards: list[DataFrame], *, key: str = "pmid", properties: dict | None = None) -> dict:
    """All shards into the store in one version. A key in two shards, no vector at all or mixed dimensions raise before."""
    shards = [s for s in shards if s.limit(1).count()]
    if not shards:
        raise ValueError("no shard has vectors")
    whole = shards[0].select(key, "embedding")
    for s in shards[1:]:
        whole = whole.unionByName(s.select(key, "embedding"))
    return store.add(whole, key=key, properties=properties)
