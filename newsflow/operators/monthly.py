"""Content by month: windows, restores and reports that read only the files of their months.

``write_monthly`` partitions by the month of a date column (rows without a date have a partition of their own).  A
predicate on the date becomes one on the month as well, which prunes files when the plan is made.  Selected ids find their
months in a narrow map (id, month) written beside the content; the distinct ones, a row a month at most, become a predicate
on the partitions.  A restore replaces the months that it touches and leaves the others' files as they are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.operators.cooccurrence import REPORT_COLUMNS, report
from newsflow.operators.load import restore_range
from newsflow.sources.readers import path_exists

MONTH = "_month"


def month_of(column: Column) -> Column:
    """The first day of the month; null for null."""
    return F.trunc(column.cast("date"), "month")


def write_monthly(rows: DataFrame, path: str, column: str) -> None:
    """Replace the table; one rebalanced set of files a month, so that a hot month is split."""
    rows.withColumn(MONTH, month_of(F.col(column))).hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(path)


def write_months(content: DataFrame, path: str, key: str = "id") -> None:
    """The map from ids to months of a monthly table: two narrow columns."""
    content.select(key, MONTH).write.mode("overwrite").parquet(path)


def read_monthly(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The table with its month column."""
    if schema is None:
        return spark.read.parquet(path).withColumn(MONTH, F.col(MONTH).cast("date"))
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.DateType())])).parquet(path)


def _day(value) -> dt.date:
    """A day given as a date or as ISO text; a time of day would need more than whole months and days."""
    return value if type(value) is dt.date else dt.date.fromisoformat(value)


def since(content: DataFrame, column: str, after) -> DataFrame:
    """Rows dated later than the day ``after``; only its month and later ones are read."""
    day = F.lit(_day(after))
    return content.where((F.col(MONTH) >= month_of(day)) & (F.col(column) > day))


def before(content: DataFrame, column: str, boundary) -> DataFrame:
    """Rows dated before the day ``boundary``; only months up to its own are read."""
    day = F.lit(_day(boundary))
    return content.where((F.col(MONTH) <= month_of(day)) & (F.col(column) < day))


def recent_report(content: DataFrame, ids: DataFrame, as_of: str, days: int = 90, min_score: int = 1) -> DataFrame:
    """``cooccurrence.recent_report`` from the files of the window's months."""
    recent = since(content, "pubDate", _day(as_of) - dt.timedelta(days=days)).where(F.col("tag_score") > min_score)
    return report(recent, ids, REPORT_COLUMNS + ["tag_score"])


def with_months(ids: DataFrame, months: DataFrame, key: str = "id") -> DataFrame:
    """(content_id, month) of selected ids; ids that the map lacks aren't in the content."""
    return ids.select("content_id").distinct().join(months, F.col("content_id") == F.col(f"`{key}`")).select("content_id", MONTH)


def report_by_months(content: DataFrame, ids: DataFrame, months: DataFrame, key: str = "id", columns: list[str] | None = None) -> DataFrame:
    """``cooccurrence.report`` that reads only months holding a selected id.

    The months of the selection are at most the partitions of the content, a bound of a row a month; they are collected
    for the pruning predicate, the ids themselves stay distributed.
    """
    found = with_months(ids, months, key)
    held = [r[0] for r in found.select(MONTH).distinct().collect()]
    known = [m for m in held if m is not None]
    inside = F.col(MONTH).isin(known) if known else F.lit(False)
    inside = inside | F.col(MONTH).isNull() if None in held else inside
    return report(content.where(inside), found, columns)


def restore_months(spark: SparkSession, path: str, backup: DataFrame, column: str, boundary, staging: str) -> list:
    """``load.restore_range`` on a monthly table, in place: months up to the boundary's are replaced, later files stay.

    The new rows of those months are written to ``staging`` first, so no file is read while it is replaced.  A finished
    staging folder that is still there belongs to a run that stopped while it replaced months: its rows are published
    again before anything is read from them.  Rows without a date stay: their partition isn't touched.  The months that
    the table holds are a bounded list of partitions; returned are those that were replaced.
    """
    day = F.lit(_day(boundary))
    content = read_monthly(spark, path)
    old = content.where(F.col(MONTH) <= month_of(day))
    if not path_exists(spark, f"{staging}/_SUCCESS"):
        mine = before(backup.withColumn(MONTH, month_of(F.col(column))), column, boundary)
        fresh = restore_range(old, mine, column, day).withColumn(MONTH, month_of(F.col(column)))
        fresh.write.mode("overwrite").parquet(staging)
    return _publish_months(spark, path, staging, old)


def _publish_months(spark: SparkSession, path: str, staging: str, old: DataFrame) -> list:
    staged = spark.read.parquet(staging)
    held = {r[0] for r in old.select(MONTH).distinct().collect()}
    filled = {r[0] for r in staged.select(MONTH).distinct().collect()}
    staged.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    emptied = [f"{path}/{MONTH}={month}" for month in held - filled]  # nothing overwrites these
    for folder in (*emptied, staging):
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return sorted(held | filled)
