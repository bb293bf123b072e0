"""Tables with versions: files by id bucket, copy-on-write of touched buckets, one atomic rename a commit.

A version is a manifest: the schema and, for each bucket, the folder that holds it.  A change writes the rows of the
buckets that it touches to a new folder, then publishes the next manifest by renaming a finished file onto a name that
must not exist yet.  Before the rename nobody sees the new files; after it everybody who asks for the latest version does;
a second writer of the same version fails and changes nothing.  Readers name the folders of the version they pinned, so no
write ever disturbs a running plan.  A job that dies between data and manifest leaves only unreferenced folders, which
``expire`` removes together with versions that are no longer kept.

Buckets are the key's hash modulo ``buckets`` (fixed when the table is made).  Keys must be unique for ``update`` and
``upsert``; null keys have a bucket of their own hash.  What the driver holds is a manifest: a line a bucket.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.operators.load import restore_range, update_by_key, upsert

_BUCKET = "_bucket"


class CommitConflict(RuntimeError):
    """Another writer published the same version first."""


class VersionedTable:
    """A versioned table under ``path``, in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    # ---- manifests

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        fs, p = self._fs(f"{self.path}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no version of {self.path}")
        v = known[-1] if version is None else version
        if v not in known:
            raise FileNotFoundError(f"version {v} of {self.path} is unknown or expired")
        fs, p = self._fs(f"{self.path}/versions/v{v:010d}.json")
        stream = fs.open(p)
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if found["key"] != self.key:
            raise ValueError(f"{self.path} is keyed by {found['key']}")
        self.buckets = found["buckets"]
        return found

    def _publish(self, manifest: dict) -> int:
        """The commit: a finished file gets the version's name, which must be free."""
        fs, tmp = self._fs(f"{self.path}/versions/.{uuid.uuid4().hex}.tmp")
        fs.mkdirs(tmp.getParent())
        out = fs.create(tmp, False)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        _, final = self._fs(f"{self.path}/versions/v{manifest['version']:010d}.json")
        if fs.exists(final) or not fs.rename(tmp, final):
            fs.delete(tmp, False)
            raise CommitConflict(f"version {manifest['version']} of {self.path} exists")
        return manifest["version"]

    # ---- reading

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the latest unless given; only files of that version are ever read."""
        return self._read_buckets(self.manifest(version))

    def _read_buckets(self, manifest: dict, only: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.path}/{d}" for b, d in manifest["folders"].items() if only is None or int(b) in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def bucket_of(self, key) -> F.Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    # ---- writing

    def _write(self, df: DataFrame, version: int) -> dict[str, str]:
        """Write rows by bucket; the folder of every bucket that has rows."""
        folder = f"data/v{version:010d}-{uuid.uuid4().hex}"
        rows = df.withColumn(_BUCKET, self.bucket_of(F.col(f"`{self.key}`"))).hint("rebalance", _BUCKET)
        rows.write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        fs, p = self._fs(f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return {n.split("=")[1]: f"{folder}/{n}" for n in names if n.startswith(f"{_BUCKET}=")}

    def _commit(self, base: dict | None, rows: DataFrame, touched: list[int] | None) -> int:
        """Publish ``rows`` as the whole content of the touched buckets (of all, if None)."""
        version = base["version"] + 1 if base else 0
        kept = {} if touched is None else {b: d for b, d in base["folders"].items() if int(b) not in touched}
        written = self._write(rows, version)
        return self._publish({"version": version, "key": self.key, "buckets": self.buckets, "schema": rows.schema.jsonValue(), "folders": kept | written})

    def _latest(self) -> dict | None:
        return self.manifest() if self.versions() else None

    def overwrite(self, rows: DataFrame) -> int:
        """Replace everything; the number of the new version.  ``rows`` may read this table."""
        return self._commit(self._latest(), rows, None)

    def _touched(self, rows: DataFrame) -> list[int]:
        found = rows.select(self.bucket_of(F.col(f"`{self.key}`")).alias("b")).distinct().collect()  # at most ``buckets`` numbers
        return sorted(r.b for r in found)

    def update(self, updates: DataFrame, columns: list[str]) -> int:
        """Overwrite ``columns`` of the rows whose keys are in ``updates``; only their buckets are read and written."""
        base = self.manifest()
        touched = self._touched(updates)
        return self._commit(base, update_by_key(self._read_buckets(base, touched), updates, self.key, columns), touched)

    def upsert(self, updates: DataFrame) -> int:
        """Update matched rows, insert the others; columns that updates lack stay, or are null in new rows."""
        base = self.manifest()
        touched = self._touched(updates)
        return self._commit(base, upsert(self._read_buckets(base, touched), updates, self.key), touched)

    def append(self, rows: DataFrame) -> int:
        """Add rows with new keys: like an upsert without a join."""
        base = self.manifest()
        touched = self._touched(rows)
        return self._commit(base, self._read_buckets(base, touched).unionByName(rows, allowMissingColumns=True), touched)

    def restore(self, backup: DataFrame, column: str, boundary) -> int:
        """Rows under the boundary go and come back from ``backup``; buckets without any such row stay as they are."""
        base = self.manifest()
        current, b = self._read_buckets(base), F.lit(boundary)
        old = [x.where(F.col(column) < b).select(self.key) for x in (current, backup)]
        touched = self._touched(old[0].unionByName(old[1]))
        mine = backup.where(self.bucket_of(F.col(f"`{self.key}`")).isin(touched))
        return self._commit(base, restore_range(self._read_buckets(base, touched), mine, column, boundary), touched)

    def expire(self, keep: int = 2) -> int:
        """Forget all but the latest ``keep`` versions and remove folders that none of them names; their number.

        Run it when no writer is at work: a writer's folder has no manifest yet.
        """
        known = self.versions()
        for v in known[:-keep]:
            fs, p = self._fs(f"{self.path}/versions/v{v:010d}.json")
            fs.delete(p, False)
        named = {d.split("/")[1] for v in known[-keep:] for d in self.manifest(v)["folders"].values()}
        fs, p = self._fs(f"{self.path}/data")
        gone = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName() not in named] if fs.exists(p) else []
        for g in gone:
            fs.delete(g, True)
        return len(gone)
