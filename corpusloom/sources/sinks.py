"""Sinks on the shared file system: guarded folders, staged publication, CSV tables, manifests."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Mapping
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def refuse_filled(folder: str) -> None:
    """Fail if the folder exists and is not empty."""
    if os.path.isdir(folder) and os.listdir(folder):
        raise FileExistsError(f"{folder} is not empty")


@contextmanager
def staged(folder: str):
    """A folder beside ``folder`` that takes its place when the block ends well, and vanishes otherwise."""
    refuse_filled(folder)
    aside = f"{folder.rstrip('/')}.staging"
    shutil.rmtree(aside, ignore_errors=True)
    os.makedirs(aside)
    try:
        yield aside
        if os.path.isdir(folder):
            os.rmdir(folder)
        os.rename(aside, folder)
    finally:
        shutil.rmtree(aside, ignore_errors=True)


def write_json(path: str, value: object) -> None:
    """A JSON document, put in place at once."""
    part = f"{path}.part"
    Path(part).write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    os.replace(part, path)


def write_statistics_csv(stats: DataFrame, path: str, keys: list[str]) -> None:
    """Statistics by group as one sorted CSV file with sizes in GB to six places; rows are as many as groups."""
    table = stats.select(*keys, "documents", F.format_string("%.6f", F.col("text_bytes") / 1e9).alias("text_gb"), "words", "estimated_tokens")
    rows = table.orderBy(*keys).toPandas()
    rows.to_csv(f"{path}.part", index=False)
    os.replace(f"{path}.part", path)


def staged_table(spark: SparkSession, folder: str, fingerprint: str) -> DataFrame | None:
    """The table that a run with equal settings has completed in ``folder``, if any."""
    mark = os.path.join(folder, "_settings")
    if os.path.exists(os.path.join(folder, "_SUCCESS")) and os.path.exists(mark) and Path(mark).read_text() == fingerprint:
        return spark.read.parquet(folder)
    return None


def stage(df: DataFrame, folder: str, fingerprint: str, partition_by: list[str] | None = None, rows_per_file: int | None = None) -> DataFrame:
    """The table from ``folder`` if a run with equal settings has completed it, else written there (in files of at most ``rows_per_file``) and read again."""
    if (known := staged_table(df.sparkSession, folder, fingerprint)) is not None:
        return known
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    Path(folder, "_settings").write_text(fingerprint)
    return df.sparkSession.read.parquet(folder)


def check_gates(df: DataFrame, gates: Mapping[str, Column]) -> DataFrame:
    """The table if every row keeps every gate; else fails with the number of rows that break each, before anything is published."""
    broken = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in gates.items()]).first().asDict() if gates else {}
    if found := {name: n for name, n in broken.items() if n}:
        raise ValueError(f"rows that break a gate: {found}")
    return df
