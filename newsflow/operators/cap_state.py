"""The tagger's text cap as a mergeable state: per epoch and source a count and a sum of description lengths.

The cap is a mean over sources of mean lengths.  Counts and sums of disjoint epochs add up, so the cap of everything that
ever landed needs one small row a source and epoch and no text.  An epoch's rows are a folder of their own, replaced when
the epoch is retried, so nothing counts twice.  ``compact`` folds old epochs into one.

Lengths are those the tagger sees (the description, or the title where it is null).  Rows without a source don't count;
a source without any text has a mean of its own, null, which the mean over sources skips; no rows give a null cap.
Sums are exact (long), so the cap doesn't depend on how rows were dealt to epochs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.operators.tagging import with_description_fallback
from newsflow.sources.readers import path_exists

STATE = "source STRING, n BIGINT, chars BIGINT"


def length_sums(articles: DataFrame) -> DataFrame:
    """(source, n, chars) of articles: one row a source, combined map-side."""
    size = F.length("description")
    a = with_description_fallback(articles).where(F.col("source").isNotNull())
    return a.groupBy("source").agg(F.count(size).alias("n"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("chars"))


def merge_sums(sums: DataFrame) -> DataFrame:
    return sums.groupBy("source").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"))


def cap_frame(sums: DataFrame) -> DataFrame:
    """One row: the text cap and the number of sources, as ``char_limit_frame`` has them from the articles."""
    mean = F.when(F.col("n") > 0, F.col("chars") / F.col("n"))
    return merge_sums(sums).agg(F.bround(F.avg(mean), 0).cast("int").alias("char_limit"), F.count("*").alias("n_sources"))


class CapState:
    """The state under ``path``: a folder an epoch; it survives the jobs that add to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, articles: DataFrame, epoch: int) -> None:
        """Put the lengths of an epoch in place of what an earlier try left."""
        length_sums(articles).write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")

    def sums(self, up_to: int | None = None) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], STATE)
        found = self.spark.read.schema(f"{STATE}, epoch BIGINT").parquet(self.path)
        return (found if up_to is None else found.where(F.col("epoch") <= up_to)).select("source", "n", "chars")

    def frame(self, up_to: int | None = None) -> DataFrame:
        return cap_frame(self.sums(up_to))

    def cap(self, up_to: int | None = None) -> Column:
        """The cap as a lazy scalar subquery over the state."""
        return self.frame(up_to).select("char_limit").scalar()

    def fixed(self) -> int | None:
        """The cap as a number, to hold it while a job runs; one row reaches the driver."""
        return self.frame().first()["char_limit"]

    def compact(self, path: str) -> CapState:
        """The same sums as one epoch of a new state; the caller switches to it when it is written."""
        merge_sums(self.sums()).write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch=0")
        return CapState(self.spark, path)
