"""Incremental loads and table maintenance as snapshot transformations.

Every function returns the *next* snapshot (or the rows to append) as a lazy
DataFrame; writing it is the caller's single action (``write_snapshot``).

Join strategy: the large side is always the current table; keys from it are
projected to the key columns only before the join, so the scan prunes every
other column.  No broadcast hint is given: AQE converts a join to a broadcast
at runtime only when the measured side is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``, otherwise it stays a
sort-merge join with skew splitting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.dates import day_series


def _key(df: DataFrame, k: str | Column) -> Column:
    return df[k] if isinstance(k, str) else k


def new_rows(
    incoming: DataFrame,
    existing: DataFrame,
    on: list[str],
    case_insensitive: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """Rows of ``incoming`` whose key is not yet in ``existing`` (left anti join).

    The stored side isn't made distinct: an anti join doesn't need it, and AQE can then split a hot key.
    ``case_insensitive`` compares ``lower()`` of every key on both sides;
    ``null_safe`` lets null keys match null keys (pandas ``isin`` on strings).
    """
    norm = (lambda c: F.lower(c)) if case_insensitive else (lambda c: c)
    ex = existing.select(*[norm(F.col(c)).alias(f"_x{i}") for i, c in enumerate(on)])
    cond = None
    for i, c in enumerate(on):
        left, right = norm(incoming[c]), ex[f"_x{i}"]
        term = left.eqNullSafe(right) if null_safe else left == right
        cond = term if cond is None else cond & term
    return incoming.join(ex, cond, "left_anti")


def update_by_key(target: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``UPDATE target SET cols = u.cols FROM updates u WHERE target.key = u.key``.

    A matched null overwrites (SQL semantics); unmatched rows are unchanged and
    update rows without a target are ignored.  ``updates`` must be unique on
    ``key`` (dedup with ``keep_first`` first); the join is on that unique key,
    so a hot key cannot occur.  When the updates come from the same snapshot,
    prefer a conditional projection (see ``operators.maintenance``): no join.
    """
    u = updates.select(F.col(key).alias("_uk"), F.lit(True).alias("_matched"), *[F.col(c).alias(f"_u_{c}") for c in columns])
    joined = target.join(u, target[key] == u["_uk"], "left")
    out = joined.select(
        *[
            (F.when(F.col("_matched"), F.col(f"_u_{c}")).otherwise(target[c]).cast(target.schema[c].dataType).alias(c))
            if c in columns
            else target[c]
            for c in target.columns
        ]
    )
    return out


def upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """MERGE: update matched rows (all columns of ``updates``), insert the rest."""
    cols = [c for c in updates.columns if c != key]
    updated = update_by_key(target, updates, key, cols)
    inserts = updates.join(target.select(key), key, "left_anti")
    return updated.unionByName(inserts, allowMissingColumns=True)


def restore_range(current: DataFrame, backup: DataFrame, column: str, boundary) -> DataFrame:
    """Delete ``column < boundary`` from the table and reload those rows from a backup."""
    b = F.lit(boundary)
    kept = current.where(~(F.col(column) < b) | F.col(column).isNull())
    return kept.unionByName(backup.where(F.col(column) < b), allowMissingColumns=True)


def missing_from_backup(current: DataFrame, backup: DataFrame, key: str, column: str, boundary) -> DataFrame:
    """Ids of current rows in the restored range that the backup does not have."""
    old = current.where(F.col(column) < F.lit(boundary)).select(key)
    return old.join(backup.select(key), key, "left_anti")


def range_counts(current: DataFrame, restored: DataFrame, column: str, boundary) -> DataFrame:
    """Before/after counts of a recovery in one pass per table."""
    b = F.lit(boundary)
    before = current.agg(
        F.count_if(F.col(column) < b).alias("n_before_range"),
        F.count("*").alias("n_before_total"),
        F.count_if(~(F.col(column) < b) | F.col(column).isNull()).alias("n_after_delete"),
    )
    after = restored.agg(
        F.count_if(F.col(column) < b).alias("n_after_range"),
        F.count("*").alias("n_after_total"),
    )
    # two one-row aggregates folded into one row
    return before.unionByName(after, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ["n_before_range", "n_before_total", "n_after_delete", "n_after_range", "n_after_total"]]
    )


def landing_gaps(landed: DataFrame) -> DataFrame:
    """(section, day) pairs inside each section's own day range that have not landed.

    The expected keys are generated per section from its min/max day, so no
    cross product of days × sections is ever built.
    """
    ranges = landed.groupBy("section").agg(F.min("day").alias("d0"), F.max("day").alias("d1"))
    expected = ranges.select("section", F.explode(day_series("d0", "d1")).alias("day"))
    return expected.join(landed, ["section", "day"], "left_anti")


def window_landing_gaps(landed: DataFrame, sections: DataFrame, as_of: str, days: int) -> DataFrame:
    """(section, day) keys of a fixed look-back window not landed yet – what a poll must fetch.

    ``sections`` is the (small) list of sections to poll; each section row
    generates its own ``days + 1`` window days (a generator, not a join).
    """
    end = F.lit(as_of).cast("date")
    expected = sections.select("section", F.explode(day_series(F.date_sub(end, days), end)).alias("day"))
    return expected.join(landed.select("section", "day").distinct(), ["section", "day"], "left_anti")


def write_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write a table snapshot; callers write to a new path and switch readers after."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
