"""Tables in buckets of their keys whose versions are switched by a manifest that is put in place last.

Rows lie in ``v=<n>/bucket=<k>``; manifest n names for each bucket the versions that make it up. A write puts its files into
a folder that no manifest names, then renames its manifest into place, so a write that dies half-way leaves readers with
what they had, and what a write doesn't touch stays as files that nobody writes again. One writer at a time.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgrain.sources.sinks import upsert

MANIFESTS = "_manifests"


class VersionedTable:
    """The table in folder ``path``, in buckets of ``key``; the number of buckets is that of its first version."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 64):
        self.spark, self.path, self.key, self._buckets = spark, path, key, buckets

    # --- the manifest
    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._at(folder)
        return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []

    def versions(self) -> list[int]:
        return [int(x.removesuffix(".json")) for x in self._names(MANIFESTS) if x.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """The newest manifest, or that of a version; before the first write an empty one."""
        known = self.versions()
        if not known:
            return {"version": 0, "buckets": {}, "number": self._buckets, "schema": None, "marks": {}}
        text = self.spark.read.text(f"{self.path}/{MANIFESTS}/{version or known[-1]:010d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def mark(self, name: str, otherwise: int = -1) -> int:
        """What the last write noted under ``name``, such as the batch that it came from."""
        return self.manifest()["marks"].get(name, otherwise)

    def _switch(self, manifest: dict) -> None:
        fs, final = self._at(f"{MANIFESTS}/{manifest['version']:010d}.json")
        _, new = self._at(f"{MANIFESTS}/{manifest['version']:010d}.new")
        if fs.exists(final):
            raise RuntimeError(f"version {manifest['version']} has been written by someone else")
        out = fs.create(new, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        if not fs.rename(new, final):
            raise RuntimeError(f"the manifest of version {manifest['version']} could not be put in place")

    # --- reading
    def bucket(self, number: int | None = None) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(number or self.manifest()["number"])).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that hold the keys of ``rows``: as many numbers at most as there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def read(self, buckets: list[int] | None = None, version: int | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The rows of the newest version, or of an earlier one; of some buckets only, where these are named: no other files
        are listed or read. Before the first write there are none, of the given schema."""
        manifest = self.manifest(version)
        held = T.StructType.fromJson(manifest["schema"]) if manifest["schema"] else schema
        if held is None:
            raise ValueError(f"nothing has been written to {self.path}")
        paths = [f"{self.path}/v={v}/bucket={k}" for k, vs in manifest["buckets"].items() if buckets is None or int(k) in buckets for v in vs]
        return self.spark.read.schema(held).parquet(*paths) if paths else self.spark.createDataFrame([], held)

    # --- writing
    def _write(self, rows: DataFrame, kept: dict, marks: dict | None) -> int:
        manifest = self.manifest()
        version = manifest["version"] + 1
        dealt = rows.withColumn("bucket", self.bucket(manifest["number"]))
        # rows of a bucket come together, large buckets in several files
        dealt.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/v={version}")
        new = {x.removeprefix("bucket="): [version] for x in self._names(f"v={version}") if x.startswith("bucket=")}
        merged = {k: [*kept.get(k, []), *new.get(k, [])] for k in sorted({*kept, *new}, key=int)}
        schema = json.loads(rows.schema.json()) if manifest["schema"] is None else manifest["schema"]
        self._switch(manifest | {"version": version, "buckets": merged, "schema": schema, "marks": manifest["marks"] | (marks or {})})
        return version

    def append(self, rows: DataFrame, marks: dict | None = None) -> int:
        """Rows beside those that are there; no old file is read or written."""
        return self._write(rows, self.manifest()["buckets"], marks)

    def replace(self, rows: DataFrame, buckets: list[int] | None = None, marks: dict | None = None) -> int:
        """``rows`` instead of what the buckets hold (all, if none are named); rows must be of these buckets. They may be made
        from this table, as no version is written over."""
        kept = {k: v for k, v in self.manifest()["buckets"].items() if buckets is not None and int(k) not in buckets}
        return self._write(rows, kept, marks)

    def upsert(self, rows: DataFrame, order: str, marks: dict | None = None) -> int:
        """The newest row of each key by ``order``; only the buckets of the keys of ``rows`` are read and written."""
        touched = self.buckets_of(rows)
        old = self.read(touched, schema=rows.schema)
        key = self.key[0] if len(self.key) == 1 else self.key
        return self.replace(upsert(old, rows.select(*old.columns), key, order), touched, marks)

    def compact(self, most: int = 16) -> None:
        """Buckets of more than ``most`` appended versions are written as one."""
        many = [int(k) for k, v in self.manifest()["buckets"].items() if len(v) > most]
        if many:
            self.replace(self.read(many), many)

    def vacuum(self, keep: int = 2) -> None:
        """Folders go that none of the last ``keep`` manifests names, with the manifests before."""
        last = self.versions()[-keep:]
        named = {v for n in last for vs in self.manifest(n)["buckets"].values() for v in vs}
        for name in [x for x in self._names("") if x.startswith("v=") and int(x[2:]) not in named]:
            fs, path = self._at(name)
            fs.delete(path, True)
        for n in self.versions()[:-keep]:
            fs, path = self._at(f"{MANIFESTS}/{n:010d}.json")
            fs.delete(path, False)
