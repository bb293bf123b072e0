"""Run metrics and previews.

Counts that the reference prints after each stage are collected with
``DataFrame.observe`` – computed in the same pass that writes the result, no
second job over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach named aggregate metrics; read ``obs.get`` after the action on the returned frame."""
    obs = Observation(name)
    exprs = [e.alias(k) for k, e in metrics.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *exprs), obs


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows for eyeballing (a limit is the feature here)."""
    return df.limit(n)


def sample_rows(df: DataFrame, key: str, n: int = 5, seed: int = 42) -> DataFrame:
    """A random sample of ``n`` rows: the smallest hashes of (seed, key), so it doesn't depend on partitions."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return df.orderBy(order, key).limit(n)
