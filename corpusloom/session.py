"""Session helpers: test sessions, lineage cuts, table access."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="corpusloom-package-")
        ignored = shutil.ignore_patterns("__pycache__", "*.pyc")
        shutil.copytree(root, Path(folder, "package", root.name), ignore=ignored)
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/corpusloom", "zip", f"{folder}/package"))
        _shipped.add(application)


def arrow_function(spark: SparkSession, f: Callable, returns: str) -> Callable:
    """An Arrow function over columns whose workers can import this package."""
    ship_package(spark)
    return F.arrow_udf(f, returns)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Checkpoint into the shared folder of ``spark.checkpoint.dir``.

    A temporary folder of this machine is set only where the session names none,
    as in tests with a local master.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="corpusloom-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
