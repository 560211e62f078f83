"""Session settings the library relies on."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan assumes.

    All event times are UTC instants; zone-less Parquet timestamps are read as
    such, so filters on them still reach the scan.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
    _ship_package(spark)
    return spark


def _ship_package(spark: SparkSession) -> None:
    """Give the workers this package once per application.

    Column functions in Python refer to it by name, and a worker need not share
    the driver's folder or search path.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="siltwatch-package-")) / "siltwatch.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset
    (tests, single machine) a fresh temporary folder is used. Elsewhere an unset
    folder is an error, since executors would write to their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="siltwatch-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def local_session(cores: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    os.environ.setdefault("TZ", "UTC")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siltwatch")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Small test data: do not merge costly steps into one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
