"""Landing by partition: each poll replaces the (section, day) partitions that it brings, and gaps come from the listing.

``land`` overwrites only the partitions present in its rows (dynamic partition overwrite), so a repeated poll replaces its
own days and nothing else.  ``landed_partitions`` lists folders and reads no data: what has landed is known from names.
The listing is a line a partition on the driver: sections × days, not rows.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from newsflow.operators.load import window_landing_gaps

_NULL = "__HIVE_DEFAULT_PARTITION__"


def land(rows: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions of ``rows`` under ``path``; partitions without rows stay."""
    rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def landed_partitions(spark: SparkSession, path: str, by: str) -> DataFrame:
    """One row a partition that holds a file; ``by`` is the DDL of the partition columns in the order of ``land``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.split()[0] for x in by.split(",")]
    level = [((), root)] if fs.exists(root) else []
    for name in names:
        level = [((*values, _value(s.getPath().getName(), name)), s.getPath()) for values, p in level for s in fs.listStatus(p)
                 if s.isDirectory() and s.getPath().getName().startswith(f"{name}=")]
    found = [v for v, p in level if any(s.getLen() and not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))]
    text = ", ".join(f"{n} string" for n in names)
    casts = [f"CAST({n} AS {x.split()[1]}) AS {n}" for n, x in zip(names, by.split(","), strict=True)]
    return spark.createDataFrame(found, text).selectExpr(*casts)


def _value(folder: str, name: str) -> str | None:
    raw = unquote(folder[len(name) + 1 :])
    return None if raw == _NULL else raw


def to_poll(spark: SparkSession, path: str, sections: DataFrame, as_of: str, days: int) -> DataFrame:
    """(section, day) keys of the look-back window that haven't landed, without reading what has."""
    return window_landing_gaps(landed_partitions(spark, path, "section string, day date"), sections, as_of, days)
