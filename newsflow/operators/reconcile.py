"""Reconciliation of two versioned tables by digests of their buckets: what agrees is never read again.

A digest is order-free: the number of a bucket's rows and sums over the two halves of the rows' 64-bit hashes, so digests
of disjoint sets of rows add up and repeated rows count.  ``DigestedTable`` keeps the digests of every version beside its
table; a new version's are taken from the buckets whose folders changed, the others are copied.  Two tables are compared
level by level: the sums of all buckets, then of groups of ``FAN_OUT`` buckets, then the buckets of the groups that differ,
and only those buckets are read and joined.  Both tables must have the same key, buckets and columns.

What the driver holds is the numbers of the buckets that differ.  Equal digests of different buckets would take a collision
of both 32-bit sums and of the count.  Defined results: null keys compare as equal to each other, nulls hash as a value of
their own; a repeated key counts as missing only if the other side has none of it; empty tables have no digests.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.operators.versioned import VersionedTable
from newsflow.sources.readers import path_exists

FAN_OUT = 32
DIGEST = "bucket INT, n BIGINT, low DECIMAL(38,0), high DECIMAL(38,0)"
_SUMS = ["n", "low", "high"]


def row_hash(columns: list[str]) -> Column:
    """One 64-bit hash of all columns; a null is hashed as a flag, so that it can't pass for a skipped column."""
    return F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def bucket_digests(rows: DataFrame, bucket: Column, columns: list[str] | None = None) -> DataFrame:
    """(bucket, n, low, high): one row a bucket, combined map-side."""
    h = rows.select(bucket.alias("bucket"), row_hash(sorted(columns or rows.columns)).alias("h"))
    low, high = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("h", 32)
    sums = [F.sum(x.cast("decimal(20,0)")).cast("decimal(38,0)").alias(a) for x, a in ((low, "low"), (high, "high"))]
    return h.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *sums)


def merge_digests(digests: DataFrame, group: Column) -> DataFrame:
    """Digests of unions of buckets."""
    return digests.groupBy(group.alias("bucket")).agg(F.sum("n").alias("n"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("low", "high")])


def _unequal(left: DataFrame, right: DataFrame) -> DataFrame:
    """Buckets of either side whose digests differ; a bucket without rows has no digest."""
    r = right.select(F.col("bucket").alias("_b"), *[F.col(c).alias(f"_{c}") for c in _SUMS])
    same = F.lit(True)
    for c in _SUMS:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(r, F.col("bucket") == F.col("_b"), "full_outer").where(~same).select(F.coalesce("bucket", "_b").alias("bucket"))


def differing_buckets(left: DataFrame, right: DataFrame, fan_out: int = FAN_OUT) -> list[int]:
    """The buckets that differ, found from the root down; equal tables end at the root."""
    if not _unequal(merge_digests(left, F.lit(0)), merge_digests(right, F.lit(0))).count():
        return []
    group = F.expr(f"bucket div {fan_out}").cast("int")
    groups = [r.bucket for r in _unequal(merge_digests(left, group), merge_digests(right, group)).collect()]
    mine = [side.where(group.isin(groups)) for side in (left, right)]
    return sorted(r.bucket for r in _unequal(*mine).collect())


class DigestedTable:
    """A versioned table with the digests of its versions under ``<path>/digests``."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 1024):
        self.spark, self.table = spark, VersionedTable(spark, path, key, buckets)

    def _path(self, version: int) -> str:
        return f"{self.table.path}/digests/v{version:010d}"

    def _bucket(self) -> Column:
        return self.table.bucket_of(F.col(f"`{self.table.key}`"))

    def digests(self, version: int | None = None) -> DataFrame:
        """The digests of a version; taken now if its writer didn't, or died before it could.

        From the nearest earlier version with digests only the changed buckets are read.
        """
        manifest = self.table.manifest(version)
        v = manifest["version"]
        if not path_exists(self.spark, f"{self._path(v)}/_SUCCESS"):
            self._take(manifest)
        return self.spark.read.schema(DIGEST).parquet(self._path(v))

    def _take(self, manifest: dict) -> None:
        columns = [f["name"] for f in manifest["schema"]["fields"]]
        changed, kept = None, None
        for v in reversed([v for v in self.table.versions() if v < manifest["version"]]):
            if path_exists(self.spark, f"{self._path(v)}/_SUCCESS"):
                base = self.table.manifest(v)
                if sorted(f["name"] for f in base["schema"]["fields"]) == sorted(columns):
                    same = [int(b) for b, d in manifest["folders"].items() if base["folders"].get(b) == d]
                    changed = sorted({int(b) for b in manifest["folders"]} - set(same))
                    kept = self.spark.read.schema(DIGEST).parquet(self._path(v)).where(F.col("bucket").isin(same))
                break
        found = bucket_digests(self.table._read_buckets(manifest, changed), self._bucket(), columns)
        found = found if kept is None else found.unionByName(kept)
        found.write.mode("overwrite").parquet(self._path(manifest["version"]))

    def read_buckets(self, buckets: list[int], version: int | None = None) -> DataFrame:
        return self.table._read_buckets(self.table.manifest(version), buckets)


@dataclass
class Reconciliation:
    """What two tables differ in; ``buckets`` of ``of`` are read, ``rows_read`` of ``rows`` rows of both sides."""

    buckets: list[int]
    of: int
    rows_read: int
    rows: int
    missing: DataFrame  # rows of the current table whose key the backup lacks
    extra: DataFrame  # rows of the backup whose key the current table lacks
    changed: DataFrame  # keys on both sides whose rows differ


def reconcile(current: DigestedTable, backup: DigestedTable) -> Reconciliation:
    """Compare the latest versions; only the buckets whose digests differ are read.

    Versions are pinned when this is called, so later commits don't disturb the frames.
    """
    mine, theirs = current.table.manifest(), backup.table.manifest()
    if (mine["key"], mine["buckets"]) != (theirs["key"], theirs["buckets"]):
        raise ValueError("tables of different keys or buckets can't be compared by their buckets")
    columns = sorted(f["name"] for f in mine["schema"]["fields"])
    if columns != sorted(f["name"] for f in theirs["schema"]["fields"]):
        raise ValueError("tables of different columns can't be compared by their digests")
    digests = [current.digests(mine["version"]), backup.digests(theirs["version"])]
    buckets = differing_buckets(*digests)
    read = F.col("bucket").isin(buckets) if buckets else F.lit(False)
    counts = digests[0].unionByName(digests[1]).agg(F.coalesce(F.sum(F.when(read, F.col("n"))), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    c, b = current.read_buckets(buckets, mine["version"]), backup.read_buckets(buckets, theirs["version"])
    key = mine["key"]

    def without(left: DataFrame, right: DataFrame) -> DataFrame:
        r = right.select(F.col(f"`{key}`").alias("_other"))
        return left.join(r, F.col(f"`{key}`").eqNullSafe(F.col("_other")), "left_anti")

    def hashed(df: DataFrame, name: str) -> DataFrame:
        # sums, so that a key's rows compare as a bag; a hot key is combined map-side
        low = F.sum(row_hash(columns).cast("decimal(20,0)")).alias(f"_{name}_sum")
        return df.groupBy(F.col(f"`{key}`").alias(f"_{name}")).agg(low, F.count(F.lit(1)).alias(f"_{name}_n"))

    x, y = hashed(c, "c"), hashed(b, "b")
    both = x.join(y, F.col("_c").eqNullSafe(F.col("_b")))
    differ = ~(F.col("_c_sum") == F.col("_b_sum")) | (F.col("_c_n") != F.col("_b_n"))
    return Reconciliation(buckets, mine["buckets"], *counts, without(c, b), without(b, c), both.where(differ).select(F.col("_c").alias(key)))


def missing_from_backup(found: Reconciliation, key: str, column: str, boundary) -> DataFrame:
    """Ids of current rows in the restored range that the backup doesn't have, from the differing buckets alone."""
    return found.missing.where(F.col(column) < F.lit(boundary)).select(key)
