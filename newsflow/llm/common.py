"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of anything but ASCII white space.
WORDS = r"[^\x20\x09-\x0D]+"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use ``spark.checkpoint.dir``; only a purely local session without it gets a temporary folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="llm-checkpoints-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(path)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that lost executors don't repeat what made it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it again: columns may be read alone later."""
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_newsflow_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    if top.is_dir():  # otherwise it came from an archive already
        archive = os.path.join(tempfile.mkdtemp(prefix="newsflow-py-"), "newsflow_modules.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        sc.addPyFile(archive)
    sc._newsflow_shipped = True


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
