"""Session helpers: one place that knows how tests and the bench configure Spark."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "newsflow", shuffle_partitions: int = 8) -> SparkSession:
    """Return the active session or build a local one (tests, bench).

    On a cluster the session already exists and its configuration wins; the
    settings below only apply to a freshly created local session.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = (
        SparkSession.builder.master(master or os.environ.get("SPARK_MASTER", "local[8]"))
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", os.environ.get("SPARK_TZ", "UTC"))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session without one gets a scratch folder; a cluster must name it.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="newsflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors' Python, once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_newsflow_shipped", False):
        return
    top = Path(__file__).resolve().parent
    if top.is_dir():  # otherwise it came from an archive already
        archive = os.path.join(tempfile.mkdtemp(prefix="newsflow-py-"), "newsflow_modules.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        sc.addPyFile(archive)
    sc._newsflow_shipped = True
