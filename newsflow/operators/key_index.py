"""Keys of what is stored, as a bucketed table beside the content, so that daily loads don't shuffle the stored side.

One row a stored key: its canonical text and the epoch that stored it.  The table is bucketed and sorted by the key, so an
anti join with it exchanges only the day's rows; a run appends its own keys.  Keys of several columns become one text in
which nulls and lengths are marked, so no two keys collide.

``new_rows`` has the rows of the shuffle join: a key with a null part is never stored unless ``null_safe``, and
``case_insensitive`` compares lower case.  Rows of the epoch itself and later ones don't count, so a retried epoch
finds what it found before although its keys may be in the index already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What was stored before the first epoch.
BEFORE = -1


class KeyIndex:
    """The keys ``on`` of a table, in ``table`` of the session's catalog, its files under ``path``."""

    def __init__(self, spark: SparkSession, table: str, path: str, on: list[str], case_insensitive: bool = False, null_safe: bool = False, buckets: int | None = None):
        self.spark, self.table, self.path, self.on = spark, table, path, on
        self.case_insensitive, self.null_safe = case_insensitive, null_safe
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def key(self) -> Column:
        parts, known = [], F.lit(True)
        for c in self.on:
            v = F.col(f"`{c}`").cast("string")
            v = F.lower(v) if self.case_insensitive else v
            known = known & v.isNotNull()
            parts.append(F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")))
        text = F.concat(*parts)
        return text if self.null_safe else F.when(known, text)

    def attach(self) -> None:
        """Name files that an earlier application wrote to the session's catalog."""
        if not self.spark.catalog.tableExists(self.table):
            self.spark.sql(f"CREATE TABLE {self.table} (key STRING, epoch BIGINT) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def append(self, rows: DataFrame, epoch: int = BEFORE) -> None:
        """Store the keys of rows that were loaded."""
        keys = rows.select(self.key().alias("key"), F.lit(epoch).cast("long").alias("epoch")).where("key IS NOT NULL")
        writer = keys.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key")
        writer.mode("append").option("path", self.path).format("parquet").saveAsTable(self.table)

    def stored(self, before_epoch: int | None = None) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)  # another session, as a stream's, may have appended
        found = self.spark.table(self.table)
        return found if before_epoch is None else found.where(F.col("epoch") < before_epoch)

    def new_rows(self, incoming: DataFrame, before_epoch: int | None = None) -> DataFrame:
        """Rows of ``incoming`` whose key isn't stored yet; the index isn't shuffled."""
        stored = self.stored(before_epoch).select(F.col("key").alias("_stored"))
        keyed = incoming.withColumn("_key", self.key())
        return keyed.join(stored, keyed["_key"] == stored["_stored"], "left_anti").drop("_key")
