"""Parallelism guards for CPU-bound narrow operators."""

from __future__ import annotations

from pyspark.sql import DataFrame


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread ``df`` over at least ``min_partitions`` tasks (default: the cluster's cores).

    CPU-heavy per-row work (phrase matching, regex extraction over HTML) on
    an input with fewer partitions than cores – a small file, one row group –
    would run on a few threads.  Only then is the input redistributed
    round-robin; a large scan (one split per 128 MB) already has enough
    partitions and is returned unchanged, so no shuffle is added at scale.

    Only scan-level inputs are inspected: when the plan already contains an
    exchange its partitioning comes from the shuffle (sized by
    ``spark.sql.shuffle.partitions`` and AQE) and asking for its partition
    count would make AQE run the upstream stages eagerly, so it is returned
    as is.
    """
    try:
        if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
            return df
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        n = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: keep the plan as is
        return df
    return df if n >= target else df.repartition(target)


def bound_task_rows(df: DataFrame, max_rows: int) -> DataFrame:
    """Deal a scan over as many tasks as keep each at about ``max_rows`` rows, at least one a core.

    A scan is split by file bytes, but a packed columnar file holds millions of
    rows in one split: an operator that widens each row (builds and parses a
    payload) and then sorts would hold memory in proportion to the split.  The
    row count comes from the file footers.  Rows are dealt by hash of a row
    number, so repeated or null values do not gather in one task and, unlike
    round-robin, nothing is sorted on the way.  A scan that has enough
    partitions is returned unchanged.
    """
    from pyspark.sql import functions as F

    needed = -(-df.count() // max_rows)
    try:
        n = df.rdd.getNumPartitions()
        needed = max(needed, df.sparkSession.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: the row count alone decides
        n = 0
    if n >= needed:
        return df
    return df.withColumn("_row", F.monotonically_increasing_id()).repartition(needed, "_row").drop("_row")


def posexplode_rows(df: DataFrame, array_col, keep: list, pos: str = "pos", value: str = "value") -> DataFrame:
    """``select(*keep, posexplode(array_col))`` without an inferred pre-filter.

    For ``posexplode`` Catalyst infers ``size(array) > 0`` and pushes it down
    (even below a redistribution), evaluating an expensive array expression –
    a JSON parse, a regex scan – twice, once before the work is spread.  The
    ``_outer`` variant followed by a filter on the generated position gives
    exactly the same rows and leaves nothing to push.
    """
    from pyspark.sql import functions as F

    out = df.select(*keep, F.posexplode_outer(array_col).alias(pos, value))
    return out.where(F.col(pos).isNotNull())
